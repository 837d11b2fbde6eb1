"""Validation, drift, rule-scan and profiling queries."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import quality as qa
from sparklab.plans.fixtures import SCORES_SQL, churn_scores, md5num_sql, with_sql
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables

SPLIT_TS = "2024-01-16"


def event_halves(t):
    e = t.events
    cut = F.lit(SPLIT_TS).cast("timestamp_ntz")
    return e.where(F.col("ts") < cut), e.where(F.col("ts") >= cut)


def lineitem_years(t):
    li = t.lineitem
    return li.where(F.year("l_shipdate") == 1996), li.where(F.year("l_shipdate") == 1997)


def _jsd_sql(base: str, test: str, x: str, name: str, bins: int = 20) -> str:
    binexpr = (f"CASE WHEN x IS NULL THEN -1 WHEN e.lo IS NULL OR x > e.hi THEN {bins} WHEN x < e.lo THEN -2 "
               f"WHEN e.hi = e.lo THEN 0 ELSE least(floor((x - e.lo) / ((e.hi - e.lo) / {bins})), {bins - 1}) END")
    return f"""(WITH b AS (SELECT CAST({x} AS DOUBLE) AS x FROM {base}), t AS (SELECT CAST({x} AS DOUBLE) AS x FROM {test}),
  e AS (SELECT min(x) AS lo, max(x) AS hi FROM b),
  hb AS (SELECT {binexpr} AS bin, count(*) AS n FROM b, e GROUP BY 1),
  ht AS (SELECT {binexpr} AS bin, count(*) AS n FROM t, e GROUP BY 1),
  pb AS (SELECT bin, n / sum(n) OVER () AS p FROM hb), pt AS (SELECT bin, n / sum(n) OVER () AS q FROM ht),
  j AS (SELECT coalesce(p, 0.0) AS p, coalesce(q, 0.0) AS q FROM pb FULL OUTER JOIN pt USING (bin))
  SELECT '{name}' AS input, 'JENSEN_SHANNON_DIVERGENCE' AS metric,
         sum(0.5 * CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0.0 END
           + 0.5 * CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0.0 END) AS value FROM j)"""


def _linf_sql(base: str, test: str, c: str, name: str) -> str:
    return f"""(WITH cb AS (SELECT coalesce(CAST({c} AS VARCHAR), '__NULL__') AS k, count(*) / sum(count(*)) OVER () AS p FROM {base} GROUP BY 1),
  ct AS (SELECT coalesce(CAST({c} AS VARCHAR), '__NULL__') AS k, count(*) / sum(count(*)) OVER () AS q FROM {test} GROUP BY 1)
  SELECT '{name}' AS input, 'L_INFTY' AS metric, max(abs(coalesce(p, 0.0) - coalesce(q, 0.0))) AS value
  FROM cb FULL OUTER JOIN ct USING (k))"""


HALVES_SQL = f"""eb AS (SELECT * FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}'),
et AS (SELECT * FROM events WHERE ts >= TIMESTAMP '{SPLIT_TS}')"""
YEARS_SQL = """lb AS (SELECT * FROM lineitem WHERE year(l_shipdate) = 1996),
lt AS (SELECT * FROM lineitem WHERE year(l_shipdate) = 1997)"""


def _r6(df, c="value"):
    return df.withColumn(c, F.round(c, 6))


@query("linf_distance", sql=with_sql(HALVES_SQL, f"""
SELECT input, round(value, 6) AS linf FROM {_linf_sql('eb', 'et', 'event_type', 'event_type')}"""))
def q_linf_distance(spark, sf):
    b, t = event_halves(Tables(spark, sf))
    return _r6(qa.linf_distance(b, t, "event_type"), "linf")


@query("js_divergence", sql=with_sql(YEARS_SQL, f"""
SELECT input, round(value, 6) AS jsd FROM {_jsd_sql('lb', 'lt', 'l_extendedprice', 'l_extendedprice')}"""))
def q_js_divergence(spark, sf):
    b, t = lineitem_years(Tables(spark, sf))
    return _r6(qa.js_divergence(b, t, "l_extendedprice"), "jsd")


def _drift_sql(overrides: dict) -> str:
    th = lambda c: overrides.get(c, 0.3)
    return with_sql(HALVES_SQL, f""",
d AS (SELECT * FROM {_linf_sql('eb', 'et', 'event_type', 'event_type')}
      UNION ALL SELECT * FROM {_linf_sql('eb', 'et', 'user_id', 'user_id')}
      UNION ALL SELECT * FROM {_jsd_sql('eb', 'et', 'value', 'value')})
SELECT input, metric, CAST(CASE input WHEN 'event_type' THEN {th('event_type')} WHEN 'user_id' THEN {th('user_id')}
                                 ELSE {th('value')} END AS DOUBLE) AS threshold,
       round(value, 6) AS value,
       value > CASE input WHEN 'event_type' THEN {th('event_type')} WHEN 'user_id' THEN {th('user_id')}
                          ELSE {th('value')} END AS is_anomaly
FROM d""")


@query("validate_drift", sql=_drift_sql({}))
def q_validate_drift(spark, sf):
    b, t = event_halves(Tables(spark, sf))
    b, t = (x.withColumn("user_id", F.col("user_id").cast("string")) for x in (b, t))
    return _r6(qa.validate_drift(b, t, ["value"], ["event_type", "user_id"]))


OVERRIDES = {"value": 0.001, "user_id": 0.05}


@query("per_column_thresholds", sql=_drift_sql(OVERRIDES))
def q_per_column_thresholds(spark, sf):
    b, t = event_halves(Tables(spark, sf))
    b, t = (x.withColumn("user_id", F.col("user_id").cast("string")) for x in (b, t))
    return _r6(qa.validate_drift(b, t, ["value"], ["event_type", "user_id"], overrides=OVERRIDES))


SKEW_SQL = """ot AS (SELECT * FROM orders WHERE year(o_orderdate) = 1995),
os AS (SELECT * FROM orders WHERE year(o_orderdate) = 1997)"""


@query("validate_skew", sql=with_sql(SKEW_SQL, f""",
d AS (SELECT * FROM {_jsd_sql('ot', 'os', 'o_totalprice', 'o_totalprice')}
      UNION ALL SELECT * FROM {_linf_sql('ot', 'os', 'o_orderstatus', 'o_orderstatus')}
      UNION ALL SELECT * FROM {_linf_sql('ot', 'os', 'o_orderpriority', 'o_orderpriority')})
SELECT input, metric, CAST(0.3 AS DOUBLE) AS threshold, round(value, 6) AS value, value > 0.3 AS is_anomaly FROM d"""))
def q_validate_skew(spark, sf):
    """Orders of 1995 as the training statistics, 1997 as serving data (an
    extra serving column is ignored)."""
    o = Tables(spark, sf).orders
    train, serve = o.where(F.year("o_orderdate") == 1995), o.where(F.year("o_orderdate") == 1997)
    stats = qa.fit_statistics(train, ["o_totalprice"], ["o_orderstatus", "o_orderpriority"])
    return _r6(qa.validate_skew(stats, serve.withColumn("extra_col", F.lit(1)), ["o_totalprice"],
                                ["o_orderstatus", "o_orderpriority"]))


@query("stats_blob")
def q_stats_blob(spark, sf):
    o = Tables(spark, sf).orders
    return qa.stats_blob(qa.fit_statistics(o, ["o_totalprice"], ["o_orderstatus"]))


@query("stats_validate", sql=with_sql(HALVES_SQL, f""",
d AS (SELECT * FROM {_linf_sql('eb', 'et', 'event_type', 'event_type')}
      UNION ALL SELECT * FROM {_jsd_sql('eb', 'et', 'value', 'value')})
SELECT input, metric, CAST(0.3 AS DOUBLE) AS threshold, round(value, 6) AS value, value > 0.3 AS is_anomaly FROM d"""))
def q_stats_validate(spark, sf):
    """Two statistics blobs (JSON values), the second binned on the first's edges,
    compared without the raw data."""
    b, t = event_halves(Tables(spark, sf))
    base = qa.fit_statistics(b, ["value"], ["event_type"])
    sb = qa.stats_blob(base)
    st = qa.stats_blob(qa.fit_statistics(t, ["value"], ["event_type"], edges_from=base))
    return _r6(qa.stats_validate(sb, st))


@query("describe_data")
def q_describe_data(spark, sf):
    return qa.describe_data(Tables(spark, sf).lineitem, num_quantiles=4, top_k=3)


@query("profile_scan")
def q_profile_scan(spark, sf):
    return qa.profile_scan(Tables(spark, sf).documents, exclude=["text"], top_k=10)


@query("null_cardinality_profile", sql="""
SELECT * FROM (
  SELECT 'l_orderkey' AS column_name, CAST(count_if(l_orderkey IS NULL) AS BIGINT) AS nulls, count(DISTINCT l_orderkey) AS distinct_values FROM lineitem
  UNION ALL SELECT 'l_partkey', count_if(l_partkey IS NULL), count(DISTINCT l_partkey) FROM lineitem
  UNION ALL SELECT 'l_returnflag', count_if(l_returnflag IS NULL), count(DISTINCT l_returnflag) FROM lineitem
  UNION ALL SELECT 'l_shipdate', count_if(l_shipdate IS NULL), count(DISTINCT l_shipdate) FROM lineitem)""")
def q_null_cardinality_profile(spark, sf):
    return qa.null_cardinality_profile(Tables(spark, sf).lineitem,
                                       ["l_orderkey", "l_partkey", "l_returnflag", "l_shipdate"])


DQ_RULES = [
    {"name": "custkey_not_null", "type": "nonNull", "column": "c_custkey", "dimension": "COMPLETENESS"},
    {"name": "balance_range", "type": "range", "column": "c_acctbal", "min": 0, "max": 10000, "threshold": 0.8},
    {"name": "segment_set", "type": "set", "column": "c_mktsegment",
     "values": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]},
    {"name": "name_pattern", "type": "regex", "column": "c_name", "pattern": "^Customer#[0-9]{9}$"},
    {"name": "balance_or_building", "type": "rowCondition", "expr": "c_acctbal > 0 OR c_mktsegment = 'BUILDING'",
     "dimension": "CONSISTENCY", "threshold": 0.95},
    {"name": "custkey_unique", "type": "uniqueness", "column": "c_custkey", "dimension": "UNIQUENESS"},
    {"name": "nation_unique", "type": "uniqueness", "column": "c_nationkey", "dimension": "UNIQUENESS"},
    {"name": "balance_mean", "type": "statisticRange", "column": "c_acctbal", "statistic": "mean",
     "min": 0, "max": 5000, "dimension": "ACCURACY"},
    {"name": "volume", "type": "tableCondition", "expr": "count(*) > 100", "dimension": "VOLUME"},
]

DQ_SQL = """
WITH r AS (
  SELECT 'custkey_not_null' AS rule, 'c_custkey' AS "column", 'COMPLETENESS' AS dimension, count(*) AS rows_evaluated,
         count_if(c_custkey IS NOT NULL) AS rows_passed, 1.0 AS threshold FROM customer
  UNION ALL SELECT 'balance_range', 'c_acctbal', 'VALIDITY', count(*), count_if(c_acctbal >= 0 AND c_acctbal <= 10000), 0.8 FROM customer
  UNION ALL SELECT 'segment_set', 'c_mktsegment', 'VALIDITY', count(*),
         count_if(c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY')), 1.0 FROM customer
  UNION ALL SELECT 'name_pattern', 'c_name', 'VALIDITY', count(*), count_if(regexp_matches(c_name, '^Customer#[0-9]{9}$')), 1.0 FROM customer
  UNION ALL SELECT 'balance_or_building', NULL, 'CONSISTENCY', count(*), count_if(c_acctbal > 0 OR c_mktsegment = 'BUILDING'), 0.95 FROM customer
  UNION ALL SELECT 'custkey_unique', 'c_custkey', 'UNIQUENESS', sum(k), sum(CASE WHEN k = 1 THEN 1 ELSE 0 END), 1.0
         FROM (SELECT count(*) AS k FROM customer GROUP BY c_custkey)
  UNION ALL SELECT 'nation_unique', 'c_nationkey', 'UNIQUENESS', sum(k), sum(CASE WHEN k = 1 THEN 1 ELSE 0 END), 1.0
         FROM (SELECT count(*) AS k FROM customer GROUP BY c_nationkey)
  UNION ALL SELECT 'balance_mean', 'c_acctbal', 'ACCURACY', 1, CAST(avg(c_acctbal) BETWEEN 0 AND 5000 AS BIGINT), 1.0 FROM customer
  UNION ALL SELECT 'volume', NULL, 'VOLUME', 1, CAST(count(*) > 100 AS BIGINT), 1.0 FROM customer)
SELECT rule, "column", dimension, CAST(rows_evaluated AS BIGINT) AS rows_evaluated, CAST(rows_passed AS BIGINT) AS rows_passed,
       CAST(threshold AS DOUBLE) AS threshold, rows_passed / rows_evaluated AS pass_ratio,
       rows_passed / rows_evaluated >= threshold AS passed
FROM r"""


@query("dq_scan", sql=DQ_SQL)
def q_dq_scan(spark, sf):
    return qa.dq_scan(Tables(spark, sf).customer, DQ_RULES)


@query("dq_scores", sql=f"""
WITH r AS ({DQ_SQL})
SELECT 'job' AS level, 'all' AS name, round(100 * avg(CAST(passed AS INTEGER)), 1) AS score FROM r
UNION ALL SELECT 'column', "column", round(100 * avg(CAST(passed AS INTEGER)), 1) FROM r WHERE "column" IS NOT NULL GROUP BY "column"
UNION ALL SELECT 'dimension', dimension, round(100 * avg(CAST(passed AS INTEGER)), 1) FROM r GROUP BY dimension""")
def q_dq_scores(spark, sf):
    return qa.dq_scores(qa.dq_scan(Tables(spark, sf).customer, DQ_RULES))


@query("dq_failed_rows", sql="""
SELECT c_custkey, c_acctbal, 'balance_range' AS failed_rule FROM customer
WHERE NOT coalesce(c_acctbal >= 0 AND c_acctbal <= 10000, false)""")
def q_dq_failed_rows(spark, sf):
    c = Tables(spark, sf).customer.select("c_custkey", "c_acctbal")
    return qa.dq_failed_rows(c, DQ_RULES[1])


LEAK_SQL = with_sql(SCORES_SQL, f""",
f AS (SELECT *, CASE WHEN actual_churn = 'Yes' THEN 'r' || CAST(({md5num_sql('c_custkey')}) % 3 AS VARCHAR) END AS reason,
             CASE WHEN ({md5num_sql('c_custkey')}) % 10 = 0 THEN NULL ELSE monthly_charges END AS charges_gappy
      FROM scores)
SELECT * FROM (
  SELECT 'reason' AS column_name, avg(CASE WHEN actual_churn = 'Yes' THEN CAST(reason IS NULL AS INTEGER) END) AS null_rate_pos,
         avg(CASE WHEN actual_churn <> 'Yes' THEN CAST(reason IS NULL AS INTEGER) END) AS null_rate_neg FROM f
  UNION ALL
  SELECT 'charges_gappy', avg(CASE WHEN actual_churn = 'Yes' THEN CAST(charges_gappy IS NULL AS INTEGER) END),
         avg(CASE WHEN actual_churn <> 'Yes' THEN CAST(charges_gappy IS NULL AS INTEGER) END) FROM f
  UNION ALL
  SELECT 'contract', avg(CASE WHEN actual_churn = 'Yes' THEN CAST(contract IS NULL AS INTEGER) END),
         avg(CASE WHEN actual_churn <> 'Yes' THEN CAST(contract IS NULL AS INTEGER) END) FROM f)
  , LATERAL (SELECT abs(null_rate_pos - null_rate_neg) AS gap, abs(null_rate_pos - null_rate_neg) >= 0.2 AS suspected_leak)""")


def leaky_scores(t):
    s = churn_scores(t)
    y = F.col("actual_churn") == "Yes"
    return (s.withColumn("reason", F.when(y, F.concat(F.lit("r"), F.pmod(md5num("c_custkey"), F.lit(3)).cast("string"))))
             .withColumn("charges_gappy", F.when(F.pmod(md5num("c_custkey"), F.lit(10)) == 0, F.lit(None))
                         .otherwise(F.col("monthly_charges"))))


@query("leakage_null_label", sql=LEAK_SQL)
def q_leakage_null_label(spark, sf):
    s = leaky_scores(Tables(spark, sf))
    return qa.leakage_null_label(s, F.col("actual_churn") == "Yes", ["reason", "charges_gappy", "contract"], 0.2)


@query("point_in_time_contract", sql="""
SELECT *, max_feature_date <= as_of AND min_label_date > as_of AND max_label_date <= label_end AS ok FROM (SELECT DATE '2024-01-15' AS as_of, DATE '2024-01-15' + 14 AS label_end,
       (SELECT max(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) <= DATE '2024-01-15') AS max_feature_date,
       (SELECT min(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15' AND CAST(ts AS DATE) <= DATE '2024-01-29') AS min_label_date,
       (SELECT max(CAST(ts AS DATE)) FROM events WHERE CAST(ts AS DATE) > DATE '2024-01-15' AND CAST(ts AS DATE) <= DATE '2024-01-29') AS max_label_date)""")
def q_point_in_time_contract(spark, sf):
    e = Tables(spark, sf).events
    d = F.to_date("ts")
    feats = e.where(d <= F.lit("2024-01-15").cast("date"))
    labs = e.where((d > F.lit("2024-01-15").cast("date")) & (d <= F.lit("2024-01-29").cast("date")))
    return qa.point_in_time_contract(feats, "ts", labs, "ts", "2024-01-15", 14)


#: Weeks that the events of the given tables span (the statements below are written out per week).
WEEKS = 5


def _weeks_sql(prefix: str, select: str = "*") -> str:
    return ",\n".join(f"{prefix}{w} AS (SELECT {select} FROM events WHERE "
                      f"floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / 7) = {w})" for w in range(WEEKS))


def _last_week(e) -> int:
    """The last week that the events reach (one number)."""
    return int(e.agg(F.max("wk")).first()[0])


CALIB_SQL = with_sql(_weeks_sql("ew"), ",\nd AS (" + " UNION ALL ".join(
    f"SELECT * FROM {_jsd_sql(f'ew{w}', f'ew{w + 1}', 'value', 'value')} UNION ALL "
    f"SELECT * FROM {_linf_sql(f'ew{w}', f'ew{w + 1}', 'event_type', 'event_type')}" for w in range(WEEKS - 1)) + """)
SELECT input, metric, round(max(value), 6) AS max_healthy, round(least(max(value) * 1.5, 0.99), 6) AS threshold
FROM d GROUP BY input, metric""")


@query("threshold_calibration", sql=CALIB_SQL)
def q_threshold_calibration(spark, sf):
    """Distances between consecutive healthy weekly windows of ``events``; the
    threshold is set above the observed band (max x 1.5, capped below 1)."""
    e = Tables(spark, sf).events.withColumn("wk", F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7))
    parts = []
    for w in range(_last_week(e)):
        a, b = e.where(F.col("wk") == w), e.where(F.col("wk") == w + 1)
        parts.append(qa.distances(qa.fit_statistics(a, ["value"], ["event_type"]), b, ["value"], ["event_type"])
                     .withColumn("window_pair", F.lit(w)))
    d = functools.reduce(DataFrame.unionByName, parts)
    return d.groupBy("input", "metric").agg(F.round(F.max("value"), 6).alias("max_healthy"),
                                            F.round(F.least(F.max("value") * 1.5, F.lit(0.99)), 6).alias("threshold"))


PRED_DRIFT_SQL = with_sql(_weeks_sql("pw", "value / 100.0 AS p"), "\n" + " UNION ALL ".join(
    f"SELECT input, metric, round(value, 6) AS value, {w} AS week FROM {_jsd_sql('pw0', f'pw{w}', 'p', 'p')}"
    for w in range(1, WEEKS)))


@query("prediction_drift", sql=PRED_DRIFT_SQL)
def q_prediction_drift(spark, sf):
    """Score distribution per week vs the first week (JSD of ``p``-like values)."""
    e = Tables(spark, sf).events.withColumn("p", F.col("value") / 100.0).withColumn(
        "wk", F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 7))
    base = e.where(F.col("wk") == 0)
    stats = qa.fit_statistics(base, ["p"], [])
    parts = [qa.distances(stats, e.where(F.col("wk") == w), ["p"], []).withColumn("week", F.lit(w)) for w in range(1, _last_week(e) + 1)]
    return _r6(functools.reduce(DataFrame.unionByName, parts))


def _structural_sql():
    feats = ["c_custkey", "tenure_months", "monthly_charges", "n_orders", "const_col", "tenure_days"]
    cand = ["tenure_months", "monthly_charges", "n_orders", "tenure_days"]
    prof = " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS d FROM f" for c in feats)
    pairs = " UNION ALL ".join(f"SELECT '{b}' AS column_name, corr(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE)) AS c FROM f"
                               for i, a in enumerate(cand) for b in cand[i + 1:])
    return with_sql(SCORES_SQL, f""",
f AS (SELECT *, 1.0 AS const_col, tenure_months * 30 + 1 AS tenure_days FROM scores),
p AS ({prof}), red AS (SELECT DISTINCT column_name FROM ({pairs}) WHERE abs(c) >= 0.95),
r AS (SELECT p.column_name, CASE WHEN d = (SELECT count(*) FROM f) THEN 'identifier' WHEN d <= 1 THEN 'constant'
                                 WHEN red.column_name IS NOT NULL THEN 'near_duplicate' END AS drop_reason
      FROM p LEFT JOIN red ON red.column_name = p.column_name)
SELECT column_name, drop_reason, drop_reason IS NULL AS keep FROM r""")


@query("structural_feature_filter", sql=_structural_sql())
def q_structural_feature_filter(spark, sf):
    """Keep list: drop identifiers (distinct = rows), constants and near-duplicate
    features; never on low correlation with the label alone."""
    s = churn_scores(Tables(spark, sf)).withColumn("const_col", F.lit(1.0)).withColumn(
        "tenure_days", F.col("tenure_months") * 30 + 1)
    feats = ["c_custkey", "tenure_months", "monthly_charges", "n_orders", "const_col", "tenure_days"]
    prof = qa.null_cardinality_profile(s, feats)
    n = s.agg(F.count(F.lit(1)).alias("_rows"))
    from sparklab.operators.aggs import corr_redundancy
    red = corr_redundancy(s, [f for f in feats if f not in ("c_custkey", "const_col")], 0.95).select(
        F.col("feature_b").alias("column_name")).distinct().withColumn("near_duplicate", F.lit(True))
    r = prof.crossJoin(n).join(red, "column_name", "left")
    reason = (F.when(F.col("distinct_values") == F.col("_rows"), F.lit("identifier"))
               .when(F.col("distinct_values") <= 1, F.lit("constant"))
               .when(F.col("near_duplicate"), F.lit("near_duplicate")))
    return r.select("column_name", reason.alias("drop_reason"), reason.isNull().alias("keep"))
