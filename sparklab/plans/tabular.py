"""Loading audits, cleaning, projections, predicates and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.functions.core import band, bool_sum, safe_divide, safe_double
from sparklab.operators import clean
from sparklab.operators import layout
from sparklab.plans.fixtures import SCORES_SQL, churn_scores, with_sql
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables


@query("load_audit", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows_loaded,
       CAST(count_if(text IS NULL OR trim(text) = '') AS BIGINT) AS blank_text,
       CAST(count_if(n_chars IS NOT NULL AND try_cast(trim(CAST(n_chars AS VARCHAR)) AS DOUBLE) IS NULL) AS BIGINT)
         AS uncastable_n_chars
FROM documents""")
def q_load_audit(spark, sf):
    d = Tables(spark, sf).documents.withColumn("n_chars", F.col("n_chars").cast("string"))
    return clean.load_audit(d, "text", ["n_chars"])


@query("text_summary", sql="""
SELECT CAST(count(*) AS BIGINT) AS n_rows, CAST(min(length(text)) AS INTEGER) AS min_len,
       CAST(max(length(text)) AS INTEGER) AS max_len, round(avg(length(text)), 1) AS avg_len
FROM documents""")
def q_text_summary(spark, sf):
    return clean.text_summary(Tables(spark, sf).documents, "text")


@query("clean_text_table", sql="""
SELECT printf('R%05d', d.doc_id) AS review_id,
       nullif(trim(split_part(d.text, chr(10), 1)), '') AS title,
       trim(d.text) AS text,
       l.quality = 1 AS recommended,
       d.lang, d.source
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE d.text IS NOT NULL AND trim(d.text) != ''""")
def q_clean_text_table(spark, sf):
    t = Tables(spark, sf)
    d = t.documents.join(t.labels, "doc_id", "left").withColumn(
        "title", F.substring_index(F.col("text"), "\n", 1))
    return clean.clean_text_table(d, "doc_id", "text", nullable_text=["title"],
                                  flag_cols={"recommended": ("quality", 1)}, keep=["lang", "source"])


@query("safe_cast_fill", sql="""
SELECT event_id,
       coalesce(try_cast(trim(regexp_extract(props, ':(.*)\\}', 1)) AS DOUBLE), 0.0) AS k_value,
       coalesce(try_cast(trim(event_type) AS DOUBLE), 0.0) AS type_as_number
FROM events""")
def q_safe_cast_fill(spark, sf):
    e = Tables(spark, sf).events
    return e.select("event_id",
                    safe_double(F.regexp_extract("props", r":(.*)\}", 1)).alias("k_value"),
                    safe_double("event_type").alias("type_as_number"))


@query("safe_divide", sql="""
SELECT o_custkey,
       sum(o_totalprice) / nullif(count_if(o_orderstatus = 'F'), 0) AS avg_finished_value,
       count_if(o_orderstatus = 'P') / nullif(count_if(o_orderstatus = 'O'), 0) AS pending_per_open
FROM orders GROUP BY o_custkey""")
def q_safe_divide(spark, sf):
    o = Tables(spark, sf).orders
    g = o.groupBy("o_custkey").agg(F.sum("o_totalprice").alias("s"),
                                   F.count_if(F.col("o_orderstatus") == "F").alias("f"),
                                   F.count_if(F.col("o_orderstatus") == "P").alias("p"),
                                   F.count_if(F.col("o_orderstatus") == "O").alias("op"))
    return g.select("o_custkey", safe_divide("s", "f").alias("avg_finished_value"),
                    safe_divide(F.col("p").cast("double"), "op").alias("pending_per_open"))


@query("case_band", sql="""
SELECT o_orderkey,
       CASE WHEN o_totalprice <= 50000 THEN 'low' WHEN o_totalprice <= 150000 THEN 'mid' ELSE 'high' END AS price_band,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'rush' WHEN '2-HIGH' THEN 'rush' ELSE 'normal' END AS handling
FROM orders""")
def q_case_band(spark, sf):
    o = Tables(spark, sf).orders
    handling = (F.when(F.col("o_orderpriority") == "1-URGENT", "rush")
                 .when(F.col("o_orderpriority") == "2-HIGH", "rush").otherwise("normal"))
    return o.select("o_orderkey", band("o_totalprice", [(50000, "low"), (150000, "mid")], "high").alias("price_band"),
                    handling.alias("handling"))


@query("bool_sum", sql="""
SELECT flag_count, CAST(count(*) AS BIGINT) AS n
FROM (SELECT CAST(l_returnflag = 'R' AS INTEGER) + CAST(l_linestatus = 'O' AS INTEGER)
             + CAST(l_discount > 0.05 AS INTEGER) + CAST(l_tax > 0.04 AS INTEGER) AS flag_count
      FROM lineitem)
GROUP BY flag_count""")
def q_bool_sum(spark, sf):
    li = Tables(spark, sf).lineitem
    fc = bool_sum(F.col("l_returnflag") == "R", F.col("l_linestatus") == "O",
                  F.col("l_discount") > 0.05, F.col("l_tax") > 0.04)
    return li.select(fc.alias("flag_count")).groupBy("flag_count").agg(F.count(F.lit(1)).alias("n"))


@query("select_except", sql="SELECT * EXCLUDE (c_name, c_acctbal) FROM customer")
def q_select_except(spark, sf):
    return clean.select_except(Tables(spark, sf).customer, "c_name", "c_acctbal")


@query("struct_star", sql="SELECT p_partkey, p_name, p_size FROM part")
def q_struct_star(spark, sf):
    p = Tables(spark, sf).part.select("p_partkey", F.struct("p_name", "p_brand", "p_size").alias("s"))
    return clean.struct_star(p, "s", except_fields=["p_brand"])


@query("between_filter", sql="""
SELECT l_orderkey, l_partkey, l_quantity, l_shipdate FROM lineitem
WHERE l_quantity BETWEEN 10 AND 20 AND l_shipdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1996-12-31'""")
def q_between_filter(spark, sf):
    li = Tables(spark, sf).lineitem
    r = clean.between_filter(li, "l_quantity", 10, 20)
    r = r.where(F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                            F.lit("1996-12-31").cast("timestamp_ntz")))
    return r.select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")


@query("null_filter", sql="""
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL""")
def q_null_filter(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.join(t.labels.select("doc_id", F.lit(1).alias("_lab")), "doc_id", "left")
    return j.where(F.col("_lab").isNull()).select("doc_id", "lang")


@query("or_of_ands", sql="""
SELECT d.lang, CAST(count(*) AS BIGINT) AS labelled,
       CAST(count_if((l.quality = 1 AND l.toxic = 0) OR (l.quality = 0 AND l.toxic = 1)) AS BIGINT) AS consistent
FROM documents d JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NOT NULL
GROUP BY d.lang""")
def q_or_of_ands(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.join(t.labels, "doc_id").where(F.col("quality").isNotNull())
    cond = ((F.col("quality") == 1) & (F.col("toxic") == 0)) | ((F.col("quality") == 0) & (F.col("toxic") == 1))
    return j.groupBy("lang").agg(F.count(F.lit(1)).alias("labelled"), F.count_if(cond).alias("consistent"))


@query("today_filter", sql="""
SELECT event_id, user_id, event_type FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-15'""")
def q_today_filter(spark, sf):
    e = Tables(spark, sf).events
    return layout.on_day(e, "ts", "2024-01-15").select("event_id", "user_id", "event_type")


@query("feature_flags", sql=with_sql(SCORES_SQL, """
SELECT c_custkey, monthly_charges > 500 AS is_high_value, tenure_months <= 3 AS is_new_customer,
       n_orders >= 10 AS is_frequent FROM scores"""))
def q_feature_flags(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return s.select("c_custkey", (F.col("monthly_charges") > 500).alias("is_high_value"),
                    (F.col("tenure_months") <= 3).alias("is_new_customer"),
                    (F.col("n_orders") >= 10).alias("is_frequent"))


@query("feature_interaction", sql="""
SELECT c.c_custkey, concat(c.c_mktsegment, ' | ', n.n_name) AS segment_nation
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""")
def q_feature_interaction(spark, sf):
    t = Tables(spark, sf)
    j = t.customer.join(F.broadcast(t.nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return j.select("c_custkey", F.concat_ws(" | ", "c_mktsegment", "n_name").alias("segment_nation"))


@query("feature_ratios", sql=with_sql(SCORES_SQL, """
SELECT c_custkey,
       monthly_charges / nullif(n_orders + 1, 0) AS charge_per_order,
       n_orders / nullif(tenure_months, 0) AS orders_per_month,
       monthly_charges / nullif(n_orders / nullif(tenure_months, 0), 0) AS charge_drift
FROM scores"""))
def q_feature_ratios(spark, sf):
    s = churn_scores(Tables(spark, sf))
    opm = safe_divide(F.col("n_orders").cast("double"), "tenure_months")
    return s.select("c_custkey", safe_divide("monthly_charges", F.col("n_orders") + 1).alias("charge_per_order"),
                    opm.alias("orders_per_month"), safe_divide("monthly_charges", opm).alias("charge_drift"))


@query("filename_from_uri", sql="""
SELECT page_id, nullif(regexp_extract(url, '([^/]+)$', 1), '') AS file_name FROM pages""")
def q_filename_from_uri(spark, sf):
    p = Tables(spark, sf).pages
    return p.select("page_id", clean.filename_from_uri("url").alias("file_name"))


@query("json_array_explode", sql="""
SELECT doc_id, w.word FROM (
  SELECT doc_id, to_json(list_slice(string_split(lower(trim(regexp_replace(text, '[^A-Za-z ]', ' ', 'g'))), ' '), 1, 3)) AS j
  FROM documents) d,
  UNNEST(from_json(json_extract(d.j, '$'), '["VARCHAR"]')) AS w(word)""")
def q_json_array_explode(spark, sf):
    d = Tables(spark, sf).documents
    words = F.slice(F.split(F.lower(F.trim(F.regexp_replace("text", "[^A-Za-z ]", " "))), " "), 1, 3)
    j = d.select("doc_id", F.to_json(words).alias("j"))
    return clean.json_array_explode(j, "j", "$", "word")


@query("normalize_title", sql="""
SELECT p_partkey, trim(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9 ]', ' ', 'g'), ' +', ' ', 'g')) AS title
FROM part""")
def q_normalize_title(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", clean.normalize_title("p_name").alias("title"))


@query("prob_for_label", sql=with_sql(SCORES_SQL, """
SELECT c_custkey, p_churn AS p_yes FROM scores"""))
def q_prob_for_label(spark, sf):
    s = churn_scores(Tables(spark, sf))
    probs = F.array(F.struct(F.lit("No").alias("label"), (1 - F.col("p_churn")).alias("prob")),
                    F.struct(F.lit("Yes").alias("label"), F.col("p_churn").alias("prob")))
    return s.select("c_custkey", probs.alias("probs")).select("c_custkey", clean.prob_for_label("probs", "Yes").alias("p_yes"))


@query("year_extract", sql="""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, CAST(count(*) AS BIGINT) AS orders,
       round(sum(o_totalprice), 2) AS revenue
FROM orders GROUP BY 1""")
def q_year_extract(spark, sf):
    o = Tables(spark, sf).orders
    return (o.groupBy(F.year("o_orderdate").alias("order_year"))
             .agg(F.count(F.lit(1)).alias("orders"), F.round(F.sum("o_totalprice"), 2).alias("revenue")))
