"""Join, window, set-operation and DML queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import features as feat
from sparklab.operators import joins, ranking, windows
from sparklab.plans.fixtures import SCORES_SQL, churn_scores, md5num_sql, with_sql
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables

ORDER_FEATS_SQL = """ofeat AS (
  SELECT o_custkey, count(*) AS n_orders, max(CAST(o_orderdate AS DATE)) AS last_order,
         avg(o_totalprice) AS avg_price
  FROM orders WHERE CAST(o_orderdate AS DATE) <= DATE '1996-12-31' GROUP BY o_custkey)"""


def order_features(t, as_of="1996-12-31"):
    o = t.orders.where(F.col("o_orderdate") < F.date_add(F.to_date(F.lit(as_of)), 1).cast("timestamp_ntz"))
    return o.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_orders"),
                                      F.max(F.to_date("o_orderdate")).alias("last_order"),
                                      F.avg("o_totalprice").alias("avg_price"))


@query("left_join_defaults", sql=with_sql(ORDER_FEATS_SQL, """
SELECT c.c_custkey, CAST(coalesce(f.n_orders, 0) AS BIGINT) AS n_orders,
       CAST(coalesce(date_diff('day', f.last_order, DATE '1996-12-31'), 999) AS INTEGER) AS days_since_order,
       coalesce(f.avg_price, 0.0) AS avg_price
FROM customer c LEFT JOIN ofeat f ON c.c_custkey = f.o_custkey"""))
def q_left_join_defaults(spark, sf):
    t = Tables(spark, sf)
    f = order_features(t).select(F.col("o_custkey").alias("c_custkey"), "n_orders",
                                 F.datediff(F.to_date(F.lit("1996-12-31")), "last_order").alias("days_since_order"),
                                 "avg_price")
    return feat.left_join_defaults(t.customer.select("c_custkey"), f, "c_custkey",
                                   {"n_orders": 0, "days_since_order": 999, "avg_price": 0.0})


@query("inner_join_using", sql="""
SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN (SELECT c_custkey AS o_custkey, c_name, c_mktsegment FROM customer)
USING (o_custkey)""")
def q_inner_join_using(spark, sf):
    t = Tables(spark, sf)
    c = t.customer.select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return t.orders.join(c, on=["o_custkey"]).select("o_orderkey", "c_name", "c_mktsegment")


RANKS_SQL = """sold AS (SELECT l_partkey AS p_partkey, sum(l_quantity) AS qty FROM lineitem GROUP BY l_partkey),
ra AS (SELECT p_partkey, CAST(rank() OVER (ORDER BY qty DESC) AS INTEGER) AS sold_rank FROM sold),
rb AS (SELECT p_partkey, CAST(rank() OVER (ORDER BY p_retailprice DESC) AS INTEGER) AS price_rank FROM part WHERE p_size > 25)"""


@query("full_outer_rank_compare", sql=with_sql(RANKS_SQL, """
SELECT coalesce(ra.p_partkey, rb.p_partkey) AS p_partkey, ra.sold_rank, rb.price_rank,
       ra.sold_rank - rb.price_rank AS rank_gap
FROM ra FULL OUTER JOIN rb ON ra.p_partkey = rb.p_partkey"""))
def q_full_outer_rank_compare(spark, sf):
    t = Tables(spark, sf)
    sold = t.lineitem.groupBy(F.col("l_partkey").alias("p_partkey")).agg(F.sum("l_quantity").alias("qty"))
    a = joins.rank_by(sold, "p_partkey", "qty", "sold_rank")
    b = joins.rank_by(t.part.where(F.col("p_size") > 25), "p_partkey", "p_retailprice", "price_rank")
    return joins.full_outer_rank_compare(a, b, "p_partkey", "sold_rank", "price_rank")


@query("rank_desc", sql="""
SELECT p_partkey, CAST(rank() OVER (ORDER BY p_retailprice DESC) AS INTEGER) AS price_rank FROM part""")
def q_rank_desc(spark, sf):
    return joins.rank_by(Tables(spark, sf).part, "p_partkey", "p_retailprice", "price_rank").select("p_partkey", "price_rank")


@query("cross_join_cutoff", sql="""
SELECT event_id, CAST(date_diff('day', CAST(ts AS DATE), c.as_of) AS INTEGER) AS days_to_cutoff
FROM events CROSS JOIN (SELECT DATE '2024-01-31' AS as_of) c WHERE CAST(ts AS DATE) <= c.as_of""")
def q_cross_join_cutoff(spark, sf):
    e = joins.with_cutoff(Tables(spark, sf).events, "2024-01-31")
    return e.where(F.to_date("ts") <= F.col("as_of")).select(
        "event_id", F.datediff("as_of", F.to_date("ts")).alias("days_to_cutoff"))


@query("lateral_unnest", sql=r"""
SELECT doc_id, CAST(count(*) AS BIGINT) AS n_words, CAST(count(DISTINCT w) AS BIGINT) AS n_distinct
FROM documents, UNNEST(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS t(w) WHERE w != '' GROUP BY doc_id""")
def q_lateral_unnest(spark, sf):
    from sparklab.plans.aggregations import words_of
    w = words_of(Tables(spark, sf).documents)
    return w.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n_words"), F.count_distinct("word").alias("n_distinct"))


@query("range_expand", sql=f"""
SELECT c_custkey, CAST(n AS INTEGER) AS n FROM (
  SELECT c_custkey, greatest(1, CAST(round((({md5num_sql('c_custkey')}) % 1000) / 1000.0 * 12) AS INTEGER)) AS k
  FROM customer) b, UNNEST(generate_series(1, k)) AS t(n)""")
def q_range_expand(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey")
    k = F.greatest(F.lit(1), F.round(F.pmod(md5num("c_custkey"), F.lit(1000)) / 1000.0 * 12).cast("int"))
    return joins.range_expand(c, k, "n")


@query("scalar_subquery", sql="""
SELECT (SELECT count(*) FROM customer) AS customers, (SELECT count(*) FROM orders) AS orders,
       (SELECT count(*) FROM lineitem) AS lineitems, (SELECT count(*) FROM part) AS parts""")
def q_scalar_subquery(spark, sf):
    t = Tables(spark, sf)
    return joins.scalar_counts({"customers": t.customer, "orders": t.orders, "lineitems": t.lineitem, "parts": t.part})


@query("fanout_check", sql=with_sql(ORDER_FEATS_SQL, """
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT c.c_custkey) AS BIGINT) AS distinct_keys,
       (SELECT count(*) FROM customer) AS base_rows,
       count(*) = count(DISTINCT c.c_custkey) AND count(*) = (SELECT count(*) FROM customer) AS ok
FROM customer c LEFT JOIN ofeat f ON c.c_custkey = f.o_custkey"""))
def q_fanout_check(spark, sf):
    t = Tables(spark, sf)
    j = t.customer.select("c_custkey").join(order_features(t).withColumnRenamed("o_custkey", "c_custkey"),
                                            "c_custkey", "left")
    return joins.fanout_check(j, "c_custkey", t.customer)


@query("enrich_join", sql=with_sql(SCORES_SQL, """
SELECT s.c_custkey, s.p_churn, d.doc_id, d.lang
FROM scores s JOIN documents d ON d.doc_id = s.c_custkey JOIN labels l ON l.doc_id = d.doc_id
WHERE s.p_churn >= 0.6 AND l.quality = 0"""))
def q_enrich_join(spark, sf):
    t = Tables(spark, sf)
    s = churn_scores(t).where(F.col("p_churn") >= 0.6).select("c_custkey", "p_churn")
    neg = t.documents.select("doc_id", "lang").join(t.labels.where(F.col("quality") == 0).select("doc_id"), "doc_id")
    return s.join(neg, s["c_custkey"] == neg["doc_id"]).select("c_custkey", "p_churn", "doc_id", "lang")


@query("asof_feature_join", sql="""
WITH lab AS (SELECT o_orderkey, o_custkey, o_orderdate FROM orders),
prev AS (SELECT o_custkey AS pk, o_orderdate AS pts, o_orderkey AS prev_orderkey, o_totalprice AS prev_totalprice FROM orders),
j AS (SELECT lab.*, prev.pts, prev.prev_orderkey, prev.prev_totalprice,
             row_number() OVER (PARTITION BY lab.o_orderkey ORDER BY prev.pts DESC, prev.prev_orderkey DESC,
                                prev.prev_totalprice DESC) AS rn
      FROM lab LEFT JOIN prev ON prev.pk = lab.o_custkey AND prev.pts < lab.o_orderdate)
SELECT o_orderkey, o_custkey, o_orderdate, pts AS feature_ts, prev_orderkey, prev_totalprice FROM j WHERE rn = 1""")
def q_asof_feature_join(spark, sf):
    o = Tables(spark, sf).orders
    lab = o.select("o_orderkey", "o_custkey", "o_orderdate")
    f = o.select("o_custkey", F.col("o_orderdate").alias("pts"), F.col("o_orderkey").alias("prev_orderkey"),
                 F.col("o_totalprice").alias("prev_totalprice"))
    return feat.asof_join(lab, f, "o_custkey", "o_orderdate", "pts", ["prev_orderkey", "prev_totalprice"], strict=True)


# ---- windows, set operations, DML -------------------------------------------------------------

@query("stratified_sample", sql=f"""
SELECT doc_id, lang, CAST(rn AS INTEGER) AS rn FROM (
  SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY {md5num_sql('doc_id')}, doc_id) AS rn FROM documents)
WHERE rn <= 50""")
def q_stratified_sample(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", "lang")
    return windows.stratified_sample(d, ["lang"], "doc_id", 50)


@query("ntile_deciles", sql=with_sql(SCORES_SQL, """
SELECT c_custkey, CAST(ntile(10) OVER (ORDER BY p_churn, c_custkey) AS INTEGER) AS decile FROM scores"""))
def q_ntile_deciles(spark, sf):
    s = churn_scores(Tables(spark, sf)).select("c_custkey", "p_churn")
    return ranking.ntile(s, 10, [], [F.col("p_churn"), F.col("c_custkey")], "decile").select("c_custkey", "decile")


@query("percent_rank_in_group", sql="""
SELECT c_custkey, c_mktsegment, percent_rank() OVER (PARTITION BY c_mktsegment ORDER BY c_acctbal) AS balance_pctile
FROM customer""")
def q_percent_rank_in_group(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_mktsegment", "c_acctbal")
    return ranking.percent_rank(c, ["c_mktsegment"], "c_acctbal", "balance_pctile").drop("c_acctbal")


@query("order_limit", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY abs(o_totalprice - 200000) DESC, o_orderkey LIMIT 20""")
def q_order_limit(spark, sf):
    o = Tables(spark, sf).orders
    return o.orderBy(F.abs(F.col("o_totalprice") - 200000).desc(), "o_orderkey").limit(20).select("o_orderkey", "o_totalprice")


@query("union_all_labeled", sql="""
SELECT 'customers' AS label, CAST(count(*) AS BIGINT) AS n FROM customer
UNION ALL SELECT 'orders', count(*) FROM orders
UNION ALL SELECT 'suppliers', count(*) FROM supplier""")
def q_union_all_labeled(spark, sf):
    t = Tables(spark, sf)
    parts = [(n, df) for n, df in (("customers", t.customer), ("orders", t.orders), ("suppliers", t.supplier))]
    out = None
    for name, df in parts:
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("label"), "n")
        out = one if out is None else out.unionByName(one)
    return out


@query("hash_sample", sql=f"""
SELECT o_orderkey, o_custkey FROM orders WHERE ({md5num_sql('o_orderkey')}) % 100 < 1""")
def q_hash_sample(spark, sf):
    return windows.hash_sample(Tables(spark, sf).orders, "o_orderkey", 1).select("o_orderkey", "o_custkey")


@query("block_sample")
def q_block_sample(spark, sf):
    return windows.block_sample(Tables(spark, sf).lineitem, 0.5)


MERGE_SQL = with_sql(SCORES_SQL, """,
tgt AS (SELECT DATE '2000-08-01' AS score_date, c_custkey, p_churn, 'v1' AS model_version FROM scores),
src AS (SELECT DATE '2000-08-01' AS score_date, c_custkey, round(p_churn * 0.9, 6) AS p_churn, 'v2' AS model_version
        FROM scores WHERE c_nationkey < 10
        UNION ALL
        SELECT DATE '2000-08-01', c_custkey, 0.5, 'v2' FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM scores))
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.score_date = tgt.score_date AND src.c_custkey = tgt.c_custkey)
UNION ALL SELECT * FROM src""")


def merge_inputs(t):
    s = churn_scores(t)
    day = F.to_date(F.lit("2000-08-01"))
    tgt = s.select(day.alias("score_date"), "c_custkey", "p_churn", F.lit("v1").alias("model_version"))
    upd = s.where(F.col("c_nationkey") < 10).select(day.alias("score_date"), "c_custkey",
                                                    F.round(F.col("p_churn") * 0.9, 6).alias("p_churn"),
                                                    F.lit("v2").alias("model_version"))
    new = t.customer.select("c_custkey").join(s.select("c_custkey"), "c_custkey", "left_anti").select(
        day.alias("score_date"), "c_custkey", F.lit(0.5).alias("p_churn"), F.lit("v2").alias("model_version"))
    return tgt, upd.unionByName(new)


@query("merge_upsert", sql=MERGE_SQL)
def q_merge_upsert(spark, sf):
    tgt, src = merge_inputs(Tables(spark, sf))
    return windows.merge_upsert(tgt, src, ["score_date", "c_custkey"])


@query("dedupe_exact", sql="""
SELECT min(doc_id) AS doc_id, CAST(count(*) AS BIGINT) AS copies FROM documents GROUP BY md5(text)""")
def q_dedupe_exact(spark, sf):
    d = Tables(spark, sf).documents.select("doc_id", F.md5("text").alias("_h"))
    return windows.dedupe_exact(d, ["_h"], "doc_id", copies="copies").drop("_h")
