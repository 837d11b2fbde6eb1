"""Aggregation queries (conditional counts, rates, distinct counts, curves)."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.operators import aggs
from sparklab.plans.fixtures import SCORES_SQL, churn_scores, with_sql
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables

WORD_SPLIT = r"[^\p{L}]+"


def words_of(docs, text_col="text"):
    """Lower-cased letter runs of each text (whole texts, no prefix)."""
    w = F.explode(F.split(F.lower(F.col(text_col)), WORD_SPLIT)).alias("word")
    return docs.select("doc_id", w).where(F.col("word") != "")


WORDS_SQL = r"""words AS (
  SELECT doc_id, w AS word FROM documents, UNNEST(regexp_split_to_array(lower(text), '[^\p{L}]+')) AS t(w)
  WHERE w != '')"""


@query("countif_pivot", sql="""
SELECT d.lang,
       CAST(count_if(l.quality = 1 AND l.toxic = 0) AS BIGINT) AS good_clean,
       CAST(count_if(l.quality = 1 AND l.toxic = 1) AS BIGINT) AS good_toxic,
       CAST(count_if(l.quality = 0 AND l.toxic = 0) AS BIGINT) AS poor_clean,
       CAST(count_if(l.quality = 0 AND l.toxic = 1) AS BIGINT) AS poor_toxic,
       CAST(count(*) AS BIGINT) AS total
FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def q_countif_pivot(spark, sf):
    t = Tables(spark, sf)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id")
    q, x = F.col("quality"), F.col("toxic")
    return aggs.countif_pivot(j, ["lang"], {"good_clean": (q == 1) & (x == 0), "good_toxic": (q == 1) & (x == 1),
                                            "poor_clean": (q == 0) & (x == 0), "poor_toxic": (q == 0) & (x == 1)})


@query("rate_by_group", sql=with_sql(SCORES_SQL, """
SELECT contract, CAST(count(*) AS BIGINT) AS customers, CAST(count_if(actual_churn = 'Yes') AS BIGINT) AS churners,
       round(100 * count_if(actual_churn = 'Yes') / count(*), 1) AS churn_rate_pct
FROM scores GROUP BY contract"""))
def q_rate_by_group(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return aggs.rate_by_group(s, ["contract"], F.col("actual_churn") == "Yes", "customers", "churners", "churn_rate_pct")


@query("rule_precision_recall", sql=with_sql(SCORES_SQL, """
SELECT CAST(count_if(tenure_months <= 24) AS BIGINT) AS flagged,
       CAST(count_if(tenure_months <= 24 AND actual_churn = 'Yes') AS BIGINT) AS caught,
       round(count_if(tenure_months <= 24 AND actual_churn = 'Yes') / nullif(count_if(actual_churn = 'Yes'), 0), 3) AS recall,
       round(count_if(tenure_months <= 24 AND actual_churn = 'Yes') / nullif(count_if(tenure_months <= 24), 0), 3) AS precision
FROM scores"""))
def q_rule_precision_recall(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return aggs.rule_precision_recall(s, F.col("tenure_months") <= 24, F.col("actual_churn") == "Yes")


@query("agreement_pct", sql="""
SELECT CAST(count(*) AS BIGINT) AS scored,
       round(100 * count_if((l.quality = 1 AND d.n_chars >= 1000) OR (l.quality = 0 AND d.n_chars < 1000)) / count(*), 1)
         AS agreement_pct
FROM labels l JOIN documents d ON d.doc_id = l.doc_id WHERE l.quality IS NOT NULL""")
def q_agreement_pct(spark, sf):
    t = Tables(spark, sf)
    j = t.labels.join(t.documents.select("doc_id", "n_chars"), "doc_id")
    agree = ((F.col("quality") == 1) & (F.col("n_chars") >= 1000)) | ((F.col("quality") == 0) & (F.col("n_chars") < 1000))
    return aggs.agreement_pct(j, agree, F.col("quality").isNotNull())


@query("distinct_counts", sql="""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT c_custkey) AS BIGINT) AS distinct_c_custkey,
       CAST(count(DISTINCT c_nationkey) AS BIGINT) AS distinct_c_nationkey,
       CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS distinct_c_mktsegment,
       CAST(count_if(c_acctbal IS NULL) AS BIGINT) AS null_c_acctbal
FROM customer""")
def q_distinct_counts(spark, sf):
    return aggs.distinct_counts(Tables(spark, sf).customer, ["c_custkey", "c_nationkey", "c_mktsegment"], ["c_acctbal"])


@query("string_agg_distinct", sql="""
SELECT user_id, string_agg(DISTINCT event_type, ',' ORDER BY event_type) AS event_type_list
FROM events GROUP BY user_id""")
def q_string_agg_distinct(spark, sf):
    return aggs.string_agg_distinct(Tables(spark, sf).events, ["user_id"], "event_type", ",")


@query("having_topk", sql=with_sql(WORDS_SQL, """
SELECT word, CAST(count(*) AS BIGINT) AS mentions, CAST(count(DISTINCT w.doc_id) AS BIGINT) AS docs,
       CAST(count(DISTINCT d.lang) AS BIGINT) AS langs
FROM words w JOIN documents d ON d.doc_id = w.doc_id
GROUP BY word HAVING count(*) >= 25 ORDER BY mentions DESC, word LIMIT 25"""))
def q_having_topk(spark, sf):
    t = Tables(spark, sf)
    w = t.documents.select("doc_id", "lang", F.explode(F.split(F.lower("text"), WORD_SPLIT)).alias("word"))
    # per (word, document) first: the distinct counts then run over that much
    # smaller table instead of expanding every exploded word
    per_doc = w.where(F.col("word") != "").groupBy("word", "doc_id", "lang").agg(F.count(F.lit(1)).alias("_c"))
    g = per_doc.groupBy("word").agg(F.sum("_c").alias("mentions"), F.count(F.lit(1)).alias("docs"),
                                     F.count_distinct("lang").alias("langs"))
    return g.where(F.col("mentions") >= 25).orderBy(F.desc("mentions"), "word").limit(25)


@query("approx_quantiles")
def q_approx_quantiles(spark, sf):
    return aggs.approx_quantiles(Tables(spark, sf).lineitem, "l_extendedprice", 100)


@query("approx_distinct")
def q_approx_distinct(spark, sf):
    li = Tables(spark, sf).lineitem
    return aggs.distinct_counts(li, ["l_partkey", "l_suppkey", "l_orderkey"], approx=True)


@query("histogram_fixed", sql="""
SELECT floor(l_quantity / 5) * 5 AS bin, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY 1""")
def q_histogram_fixed(spark, sf):
    return aggs.histogram_fixed(Tables(spark, sf).lineitem, "l_quantity", 5).withColumn("bin", F.col("bin").cast("double"))


CORR_FEATURES = ["tenure_months", "monthly_charges", "n_orders", "c_nationkey"]


@query("corr_label", sql=with_sql(SCORES_SQL, "\n" + " UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(corr(CAST({c} AS DOUBLE), CASE WHEN actual_churn = 'Yes' THEN 1.0 ELSE 0.0 END), 4)"
    f" AS corr_with_label FROM scores" for c in CORR_FEATURES)))
def q_corr_label(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return aggs.corr_with_label(s, CORR_FEATURES, F.col("actual_churn") == "Yes")


REDUNDANCY_FEATURES = CORR_FEATURES + ["tenure_days"]


def _redundancy_sql():
    pairs = [(a, b) for i, a in enumerate(REDUNDANCY_FEATURES) for b in REDUNDANCY_FEATURES[i + 1:]]
    body = " UNION ALL ".join(f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"
                              f" AS corr FROM f" for a, b in pairs)
    return with_sql(SCORES_SQL, f""",
f AS (SELECT *, tenure_months * 30 + 1 AS tenure_days FROM scores)
SELECT feature_a, feature_b, round(corr, 6) AS corr FROM ({body}) WHERE abs(corr) >= 0.95""")


@query("corr_redundancy", sql=_redundancy_sql())
def q_corr_redundancy(spark, sf):
    s = churn_scores(Tables(spark, sf)).withColumn("tenure_days", F.col("tenure_months") * 30 + 1)
    return aggs.corr_redundancy(s, REDUNDANCY_FEATURES, 0.95).withColumn("corr", F.round("corr", 6))


@query("describe_events", sql="""
SELECT CAST(count(*) AS BIGINT) AS events, CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_keys,
       min(CAST(ts AS DATE)) AS earliest, max(CAST(ts AS DATE)) AS latest,
       CAST(count(DISTINCT event_type) AS BIGINT) AS event_types FROM events""")
def q_describe_events(spark, sf):
    return aggs.describe_events(Tables(spark, sf).events, "user_id", "ts", "event_type")


@query("daily_rollup", sql="""
SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, round(avg(value), 4) AS avg_value,
       CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_user_id,
       CAST(count_if(event_type = 'error') AS BIGINT) AS errors
FROM events GROUP BY 1""")
def q_daily_rollup(spark, sf):
    return aggs.daily_rollup(Tables(spark, sf).events, "ts", "value", "user_id",
                             {"errors": F.count_if(F.col("event_type") == "error")})


@query("group_mean_median", sql="""
SELECT l_returnflag, CAST(count(*) AS BIGINT) AS n, round(avg(l_extendedprice), 4) AS mean,
       round(quantile_cont(l_extendedprice, 0.5), 4) AS median
FROM lineitem GROUP BY l_returnflag""")
def q_group_mean_median(spark, sf):
    return aggs.group_mean_median(Tables(spark, sf).lineitem, ["l_returnflag"], "l_extendedprice")


@query("top_categories", sql="""
SELECT l_partkey, CAST(count(*) AS BIGINT) AS n FROM lineitem GROUP BY l_partkey ORDER BY n DESC, l_partkey LIMIT 15""")
def q_top_categories(spark, sf):
    return aggs.top_categories(Tables(spark, sf).lineitem, "l_partkey", 15)


#: Groups by position: with n rows and k groups the first n % k groups have one row more.
DECILE_SQL = with_sql(SCORES_SQL, """,
placed AS (SELECT p_churn, actual_churn = 'Yes' AS y, monthly_charges AS m, row_number() OVER (ORDER BY p_churn, c_custkey) - 1 AS i, count(*) OVER () AS n FROM scores),
cut AS (SELECT *, n // 10 AS low, n % 10 AS more FROM placed),
grouped AS (SELECT *, CASE WHEN i < more * (low + 1) THEN i // (low + 1) ELSE more + (i - more * (low + 1)) // low END + 1 AS g FROM cut)
SELECT CAST(g AS INTEGER) AS decile, count(*) AS n, round(avg(p_churn), 4) AS mean_score, round(avg(CAST(y AS INTEGER)), 4) AS true_share,
       round(avg(p_churn) - avg(CAST(y AS INTEGER)), 4) AS gap, round(sum(m), 2) AS revenue
FROM grouped GROUP BY g""")


@query("decile_calibration", sql=DECILE_SQL)
def q_decile_calibration(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return aggs.decile_calibration(s, "p_churn", F.col("actual_churn") == "Yes", "monthly_charges", "c_custkey")


EV_SQL = with_sql(SCORES_SQL, """,
grid AS (SELECT CAST(g AS DOUBLE) / 100 AS th FROM range(10, 95, 5) t(g)),
rows_at AS (SELECT th, actual_churn = 'Yes' AS y, monthly_charges AS m FROM grid LEFT JOIN scores ON p_churn >= th),
sums AS (SELECT th, count(m) AS n, coalesce(sum(CAST(y AS INTEGER)), 0) AS hits, coalesce(sum(m) FILTER (y), 0) * (12.0 * 0.45 * 0.30) AS kept FROM rows_at GROUP BY th),
whole AS (SELECT sum(CAST(actual_churn = 'Yes' AS INTEGER)) AS positives FROM scores)
SELECT round(th, 2) AS threshold, CAST(n AS BIGINT) AS contacted, CAST(hits AS BIGINT) AS churners_reached,
       round(hits / nullif(n, 0), 3) AS precision, round(hits / nullif(positives, 0), 3) AS recall, round(kept - 12 * n, 0) AS net_value
FROM sums, whole""")


@query("expected_value_curve", sql=EV_SQL)
def q_expected_value_curve(spark, sf):
    s = churn_scores(Tables(spark, sf))
    return aggs.expected_value_curve(s, "p_churn", F.col("actual_churn") == "Yes", "monthly_charges",
                                     aggs.threshold_grid(spark, 10, 90, 5))


@query("threshold_sweep_cross", sql=with_sql(SCORES_SQL, """
SELECT round(th, 2) AS threshold, CAST(count_if(p_churn >= th) AS BIGINT) AS above
FROM scores, (SELECT generate_series / 100.0 AS th FROM generate_series(10, 90, 5)) g GROUP BY th"""))
def q_threshold_sweep_cross(spark, sf):
    s = churn_scores(Tables(spark, sf)).select("p_churn")
    j = s.crossJoin(F.broadcast(aggs.threshold_grid(spark, 10, 90, 5)))
    return j.groupBy(F.round("th", 2).alias("threshold")).agg(F.count_if(F.col("p_churn") >= F.col("th")).alias("above"))


@query("baseline_vs_model", sql=with_sql(SCORES_SQL, """
SELECT 'contract rule' AS approach, CAST(count_if(contract = 'AUTOMOBILE') AS BIGINT) AS contacted,
       CAST(count_if(contract = 'AUTOMOBILE' AND actual_churn = 'Yes') AS BIGINT) AS caught,
       round(count_if(contract = 'AUTOMOBILE' AND actual_churn = 'Yes') / count_if(contract = 'AUTOMOBILE'), 3) AS precision
FROM scores
UNION ALL
SELECT 'model @ 0.35', CAST(count_if(p_churn >= 0.35) AS BIGINT), CAST(count_if(p_churn >= 0.35 AND actual_churn = 'Yes') AS BIGINT),
       round(count_if(p_churn >= 0.35 AND actual_churn = 'Yes') / count_if(p_churn >= 0.35), 3)
FROM scores"""))
def q_baseline_vs_model(spark, sf):
    s = churn_scores(Tables(spark, sf))
    y = F.col("actual_churn") == "Yes"

    def part(name, rule):
        return s.agg(F.count_if(rule).alias("contacted"), F.count_if(rule & y).alias("caught")).select(
            F.lit(name).alias("approach"), "contacted", "caught",
            F.round(F.col("caught") / F.col("contacted"), 3).alias("precision"))
    return part("contract rule", F.col("contract") == "AUTOMOBILE").unionByName(
        part("model @ 0.35", F.col("p_churn") >= 0.35))


@query("contribution_analysis", sql="""
WITH d AS (SELECT l_returnflag, l_linestatus, l_extendedprice AS m, year(l_shipdate) = 1997 AS t
           FROM lineitem WHERE year(l_shipdate) IN (1996, 1997)),
g AS (SELECT l_returnflag, l_linestatus, CAST(grouping(l_returnflag, l_linestatus) AS BIGINT) AS gid,
             sum(CASE WHEN NOT t THEN m ELSE 0.0 END) AS control, sum(CASE WHEN t THEN m ELSE 0.0 END) AS test
      FROM d GROUP BY CUBE (l_returnflag, l_linestatus))
SELECT l_returnflag, l_linestatus, gid, round(control, 2) AS control, round(test, 2) AS test,
       round(test - control, 2) AS delta, round((test - control) / nullif(control, 0), 6) AS rel_change
FROM g""")
def q_contribution_analysis(spark, sf):
    li = Tables(spark, sf).lineitem
    y = F.year("l_shipdate")
    d = li.where(F.col("l_shipdate").between(F.lit("1996-01-01").cast("timestamp_ntz"),
                                             F.lit("1997-12-31 23:59:59.999999").cast("timestamp_ntz")))
    r = aggs.contribution_analysis(d, ["l_returnflag", "l_linestatus"], F.col("l_extendedprice"), y == 1997)
    return r.withColumn("gid", F.col("gid").cast("bigint"))
