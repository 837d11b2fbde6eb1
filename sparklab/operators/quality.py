"""Data validation: profiles, drift/skew distances, rule scans, gates, leakage checks.

All multi-column statistics are computed in *long* form — the columns are
unpivoted to ``(feature, value)`` rows once — so N columns cost one scan and one
shuffle of (feature, bin) partial counts, never N scans.  The statistics tables
(features x bins, features x categories) are small and bounded by the number
of columns times the bin count / category cardinality.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_THRESHOLD = 0.3
DEFAULT_BINS = 20


# ---------------------------------------------------------------- long form ----

def _long(df: DataFrame, cols: list[str], as_type: str) -> DataFrame:
    """Unpivot ``cols`` to (feature, value) with ``value`` cast to ``as_type``."""
    arr = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(as_type).alias("value")) for c in cols])
    return df.select(F.inline(arr))


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def categorical_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BooleanType))]


# ------------------------------------------------------------ statistics -------

def fit_statistics(df: DataFrame, numeric: list[str], categorical: list[str], bins: int = DEFAULT_BINS,
                   edges_from: DataFrame | None = None) -> DataFrame:
    """Statistics stored beside a model (or computed for a baseline table):
    one row per (feature, bucket) with the bucket's count.

    numeric: equal-width bins between the baseline min and max (``lo``/``hi``
    kept, so the serving side reuses the same edges; pass ``edges_from`` = the
    baseline statistics to bin a second table on the same edges); categorical:
    one row per category (NULL as its own category)."""
    parts = []
    if numeric:
        edges = (edges_from.where(F.col("kind") == "numeric").select("feature", "lo", "hi").distinct()
                 if edges_from is not None else _numeric_edges(df, numeric))
        parts.append(_numeric_hist(df, numeric, edges, bins).withColumn("kind", F.lit("numeric")))
    if categorical:
        c = (_long(df, categorical, "string")
             .groupBy("feature", F.coalesce("value", F.lit("__NULL__")).alias("bucket"))
             .agg(F.count(F.lit(1)).alias("n"))
             .select("feature", "bucket", F.lit(None).cast("double").alias("lo"),
                     F.lit(None).cast("double").alias("hi"), "n", F.lit("categorical").alias("kind")))
        parts.append(c)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _numeric_edges(df: DataFrame, numeric: list[str]) -> DataFrame:
    """(feature, lo, hi) from one aggregate over all numeric columns (one row per feature)."""
    wide = df.agg(*[F.min(F.col(c).cast("double")).alias(f"{c}__lo") for c in numeric],
                  *[F.max(F.col(c).cast("double")).alias(f"{c}__hi") for c in numeric])
    stack = ", ".join([f"'{c}', `{c}__lo`, `{c}__hi`" for c in numeric])
    return wide.selectExpr(f"stack({len(numeric)}, {stack}) as (feature, lo, hi)")


def _bin_expr(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    width = (hi - lo) / F.lit(bins)
    raw = F.floor((x - lo) / width)
    b = (F.when(x.isNull(), F.lit(-1)).when(lo.isNull() | (x > hi), F.lit(bins)).when(x < lo, F.lit(-2))
          .when(hi == lo, F.lit(0)).otherwise(F.least(raw, F.lit(bins - 1))))
    return b.cast("int")


def _numeric_hist(df: DataFrame, numeric: list[str], edges: DataFrame, bins: int) -> DataFrame:
    """Counts per (feature, bin) with shared edges; values below the edges go to
    bin -2, above them (or when the baseline has no value) to bin ``bins``, NULL to bin -1.  ``edges`` has one row per feature: broadcast is
    bounded by the column count."""
    lg = _long(df, numeric, "double").join(F.broadcast(edges), "feature")
    b = _bin_expr(F.col("value"), F.col("lo"), F.col("hi"), bins)
    return (lg.groupBy("feature", b.cast("string").alias("bucket"), "lo", "hi")
              .agg(F.count(F.lit(1)).alias("n")))


def _serving_counts(stats: DataFrame, serving: DataFrame, numeric: list[str], categorical: list[str],
                    bins: int) -> DataFrame:
    parts = []
    if numeric:
        edges = stats.where(F.col("kind") == "numeric").select("feature", "lo", "hi").distinct()
        parts.append(_numeric_hist(serving, numeric, edges, bins).drop("lo", "hi"))
    if categorical:
        parts.append(_long(serving, categorical, "string")
                     .groupBy("feature", F.coalesce("value", F.lit("__NULL__")).alias("bucket"))
                     .agg(F.count(F.lit(1)).alias("n")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _shares(counts: DataFrame, name: str) -> DataFrame:
    tot = counts.groupBy("feature").agg(F.sum("n").alias("_tot"))
    return counts.join(tot, "feature").select("feature", "bucket", (F.col("n") / F.col("_tot")).alias(name))


def distances(stats: DataFrame, serving: DataFrame, numeric: list[str], categorical: list[str],
              bins: int = DEFAULT_BINS, js_for_categorical: bool = False) -> DataFrame:
    """(feature, metric, value): L-infinity for categoricals, Jensen-Shannon
    divergence (base 2, in [0, 1]) for numerics (and, opt-in, categoricals)."""
    base = _shares(stats.select("feature", "bucket", "n"), "p")
    test = _shares(_serving_counts(stats, serving, numeric, categorical, bins), "q")
    j = base.join(test, ["feature", "bucket"], "full_outer").select(
        "feature", "bucket", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    kinds = stats.select("feature", "kind").distinct()
    j = j.join(F.broadcast(kinds), "feature")
    m = (F.col("p") + F.col("q")) / 2

    def kl(a):  # zero mass contributes 0
        return F.when(F.col(a) > 0, F.col(a) * F.log2(F.col(a) / m)).otherwise(F.lit(0.0))
    g = j.groupBy("feature", "kind").agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("linf"),
                                         F.sum(0.5 * kl("p") + 0.5 * kl("q")).alias("jsd"))
    use_js = (F.col("kind") == "numeric") | F.lit(js_for_categorical)
    return g.select(F.col("feature").alias("input"),
                    F.when(use_js, F.lit("JENSEN_SHANNON_DIVERGENCE")).otherwise(F.lit("L_INFTY")).alias("metric"),
                    F.when(use_js, F.col("jsd")).otherwise(F.col("linf")).alias("value"))


def threshold_table(spark, features: list[str], default: float = DEFAULT_THRESHOLD,
                    overrides: dict | None = None) -> DataFrame:
    """Per-column thresholds: a default in [0, 1) and an override list (one row per feature)."""
    if not 0 <= default < 1:
        raise ValueError("threshold must be in [0, 1)")
    rows = [(f, float((overrides or {}).get(f, default))) for f in features]
    return spark.createDataFrame(rows, "input string, threshold double")


def apply_thresholds(dist: DataFrame, thresholds: DataFrame) -> DataFrame:
    """Columns ``input, metric, threshold, value, is_anomaly`` (value > threshold)."""
    j = dist.join(F.broadcast(thresholds), "input", "left")
    return j.select("input", "metric", "threshold", "value", (F.col("value") > F.col("threshold")).alias("is_anomaly"))


def validate_skew(stats: DataFrame, serving: DataFrame, numeric: list[str], categorical: list[str],
                  default: float = DEFAULT_THRESHOLD, overrides: dict | None = None,
                  bins: int = DEFAULT_BINS) -> DataFrame:
    """Serving data vs statistics stored with the model.  Columns not in the
    statistics are ignored; statistics are of raw (pre-transform) inputs."""
    spark = serving.sparkSession
    keep_num = [c for c in numeric if c in serving.columns]
    keep_cat = [c for c in categorical if c in serving.columns]
    d = distances(stats, serving, keep_num, keep_cat, bins)
    return apply_thresholds(d, threshold_table(spark, keep_num + keep_cat, default, overrides))


def validate_drift(base: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str],
                   default: float = DEFAULT_THRESHOLD, overrides: dict | None = None,
                   bins: int = DEFAULT_BINS) -> DataFrame:
    """Two tables, no model: statistics of ``base`` computed on the fly."""
    return validate_skew(fit_statistics(base, numeric, categorical, bins), test, numeric, categorical,
                         default, overrides, bins)


def linf_distance(base: DataFrame, test: DataFrame, c: str) -> DataFrame:
    d = distances(fit_statistics(base, [], [c]), test, [], [c])
    return d.select("input", F.col("value").alias("linf"))


def js_divergence(base: DataFrame, test: DataFrame, c: str, bins: int = DEFAULT_BINS) -> DataFrame:
    d = distances(fit_statistics(base, [c], [], bins), test, [c], [], bins)
    return d.select("input", F.col("value").alias("jsd"))


def stats_blob(stats: DataFrame) -> DataFrame:
    """Statistics as one JSON value (one row).  The stats table is bounded by
    features x buckets, so collecting it into one value is bounded too."""
    return stats.agg(F.to_json(F.sort_array(F.collect_list(
        F.struct("feature", "kind", "bucket", "lo", "hi", "n")))).alias("statistics"))


def stats_from_blob(blob: DataFrame) -> DataFrame:
    schema = "array<struct<feature:string,kind:string,bucket:string,lo:double,hi:double,n:bigint>>"
    return blob.select(F.inline(F.from_json("statistics", schema)))


def stats_validate(base_blob: DataFrame, test_blob: DataFrame, bins: int = DEFAULT_BINS,
                   default: float = DEFAULT_THRESHOLD) -> DataFrame:
    """Compare two statistics blobs (SKEW/DRIFT only).  A kind mismatch for a
    feature (numeric on one side, categorical on the other) is a row with
    metric ``TYPE_MISMATCH`` and ``is_anomaly`` true — never silently dropped."""
    a, b = stats_from_blob(base_blob), stats_from_blob(test_blob)
    ka = a.select("feature", F.col("kind").alias("ka")).distinct()
    kb = b.select("feature", F.col("kind").alias("kb")).distinct()
    kinds = ka.join(kb, "feature", "full_outer")
    mism = kinds.where(~F.col("ka").eqNullSafe(F.col("kb"))).select(
        F.col("feature").alias("input"), F.lit("TYPE_MISMATCH").alias("metric"),
        F.lit(0.0).alias("threshold"), F.lit(1.0).alias("value"), F.lit(True).alias("is_anomaly"))
    # numeric histograms are comparable only on the same bin edges
    ea = a.where(F.col("kind") == "numeric").select("feature", F.col("lo").alias("la"), F.col("hi").alias("ha")).distinct()
    eb = b.where(F.col("kind") == "numeric").select("feature", F.col("lo").alias("lb"), F.col("hi").alias("hb")).distinct()
    edge_bad = (ea.join(eb, "feature").where(~F.col("la").eqNullSafe(F.col("lb")) | ~F.col("ha").eqNullSafe(F.col("hb")))
                  .select("feature").distinct())
    mism = mism.unionByName(edge_bad.select(
        F.col("feature").alias("input"), F.lit("BIN_EDGE_MISMATCH").alias("metric"),
        F.lit(0.0).alias("threshold"), F.lit(1.0).alias("value"), F.lit(True).alias("is_anomaly")))
    ok = kinds.where(F.col("ka") == F.col("kb")).select("feature").join(edge_bad, "feature", "left_anti")
    pa = _shares(a.join(ok, "feature", "left_semi").select("feature", "bucket", "n"), "p")
    pb = _shares(b.join(ok, "feature", "left_semi").select("feature", "bucket", "n"), "q")
    j = pa.join(pb, ["feature", "bucket"], "full_outer").select(
        "feature", "bucket", F.coalesce("p", F.lit(0.0)).alias("p"), F.coalesce("q", F.lit(0.0)).alias("q"))
    j = j.join(ka, "feature")
    m = (F.col("p") + F.col("q")) / 2

    def kl(x):
        return F.when(F.col(x) > 0, F.col(x) * F.log2(F.col(x) / m)).otherwise(F.lit(0.0))
    g = j.groupBy("feature", "ka").agg(F.max(F.abs(F.col("p") - F.col("q"))).alias("linf"),
                                       F.sum(0.5 * kl("p") + 0.5 * kl("q")).alias("jsd"))
    num = F.col("ka") == "numeric"
    res = g.select(F.col("feature").alias("input"),
                   F.when(num, F.lit("JENSEN_SHANNON_DIVERGENCE")).otherwise(F.lit("L_INFTY")).alias("metric"),
                   F.lit(default).alias("threshold"),
                   F.when(num, F.col("jsd")).otherwise(F.col("linf")).alias("value"))
    res = res.withColumn("is_anomaly", F.col("value") > F.col("threshold"))
    return res.unionByName(mism)


def assert_gate(report: DataFrame, message: str = "data validation failed") -> None:
    """Fail the job before scoring when any row of a report is anomalous.
    The check itself is a distributed aggregate; only one number reaches the driver."""
    bad = report.agg(F.count_if(F.col("is_anomaly")).alias("bad")).collect()[0]["bad"]
    if bad:
        raise AssertionError(f"{message}: {bad} anomalous input(s)")


def assert_gate_lazy(report: DataFrame, message: str = "data validation failed") -> DataFrame:
    """SQL-style ``ASSERT``: a one-row frame that raises when evaluated."""
    return report.agg(F.count_if(F.col("is_anomaly")).alias("bad")).select(
        F.assert_true(F.col("bad") == 0, F.lit(message)).alias("ok"))


# ------------------------------------------------------------ profiles ---------

def describe_data(df: DataFrame, num_quantiles: int = 2, top_k: int = 1, accuracy: int = 10_000,
                  exact_unique: bool = False) -> DataFrame:
    """One row per column: rows, nulls, zeros, min, max, mean, stddev, median,
    quantiles, unique, avg string length, top values.  Numeric-only fields are
    NULL for categoricals; nested/array columns get only the null count.

    One wide aggregate (all algebraic or sketch-based) + one grouped pass for
    top values over the unpivoted table (per-feature top-k with a row-number
    filter, which Catalyst limits per partition)."""
    fields = df.schema.fields
    num = [f.name for f in fields if isinstance(f.dataType, T.NumericType)]
    cat = [f.name for f in fields if isinstance(f.dataType, (T.StringType, T.BooleanType, T.DateType,
                                                             T.TimestampType, T.TimestampNTZType))]
    probs = [i / num_quantiles for i in range(num_quantiles + 1)]
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for f in fields:
        c = f.name
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}__nulls"))
    for c in num:
        x = F.col(c).cast("double")
        aggs += [F.count_if(x == 0).alias(f"{c}__zeros"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max"),
                 F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.percentile_approx(x, probs, accuracy).alias(f"{c}__q")]
    for c in num + cat:
        u = F.count_distinct(F.col(c)) if exact_unique else F.approx_count_distinct(F.col(c))
        aggs.append(u.alias(f"{c}__uniq"))
    for c in cat:
        aggs.append(F.avg(F.length(F.col(c).cast("string"))).alias(f"{c}__avglen"))
    wide = df.agg(*aggs)
    rows = []
    for f in fields:
        c = f.name
        is_num, is_cat = c in num, c in cat

        def g(suffix, ok, typ="double"):
            return F.col(f"`{c}__{suffix}`").cast(typ) if ok else F.lit(None).cast(typ)
        rows.append(F.struct(
            F.lit(c).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"),
            F.col("__rows").alias("num_rows"), F.col(f"`{c}__nulls`").alias("num_nulls"),
            g("zeros", is_num, "bigint").alias("num_zeros"), g("min", is_num).alias("min"),
            g("max", is_num).alias("max"), g("mean", is_num).alias("mean"), g("std", is_num).alias("stddev"),
            (F.col(f"`{c}__q`").cast("array<double>") if is_num else F.lit(None).cast("array<double>")).alias("quantiles"),
            g("uniq", is_num or is_cat, "bigint").alias("num_unique"),
            g("avglen", is_cat).alias("avg_string_length")))
    long = wide.select(F.inline(F.array(*rows)))
    long = long.withColumn("median", F.when(F.col("quantiles").isNotNull() & (F.lit(num_quantiles) % 2 == 0),
                                            F.col("quantiles")[num_quantiles // 2]))
    if top_k and (num or cat):
        tv = top_values(df, num + cat, top_k)
        tops = tv.groupBy("column_name").agg(F.sort_array(F.collect_list(
            F.struct(F.col("rank"), F.col("value"), F.col("count")))).alias("top_values"))
        long = long.join(tops, "column_name", "left")
    return long


def top_values(df: DataFrame, cols: list[str], k: int = 10) -> DataFrame:
    """The ``k`` most frequent values of each column (as strings) with exact counts, ratios and rank; equally frequent
    ones by value.

    Strings are counted by two 64-bit hashes, so whole texts are neither group keys nor shuffled, and the values behind
    the ``k`` hashes kept per column are looked up in a second pass (which of equally frequent strings are kept goes by
    hash where there are more than fit).  Values of other types are short and counted as they are, in one pass."""
    texts = [c for c in cols if isinstance(df.schema[c].dataType, T.StringType)]
    short = [c for c in cols if c not in texts]
    parts = []
    if short:
        counts = _long(df, short, "string").withColumnRenamed("feature", "column_name").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("count"))
        w = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
        top = counts.where(F.col("value").isNotNull()).withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= k)
        parts.append(top.select("column_name", "value", "count"))
    if texts:
        hashes = lambda c: [F.lit(c).alias("column_name"), F.xxhash64(F.lit(1), F.col(c)).alias("h1"), F.xxhash64(F.lit(2), F.col(c)).alias("h2")]
        listed = df.select(F.inline(F.array(*[F.when(F.col(c).isNotNull(), F.struct(*hashes(c))) for c in texts])))
        counts = listed.where(F.col("h1").isNotNull()).groupBy("column_name", "h1", "h2").agg(F.count(F.lit(1)).alias("count"))
        w = Window.partitionBy("column_name").orderBy(F.desc("count"), "h1", "h2")
        kept = counts.withColumn("_place", F.row_number().over(w)).where(F.col("_place") <= k).drop("_place")
        named = df.select(F.inline(F.array(*[F.struct(*hashes(c), F.col(c).alias("value")) for c in texts]))).where(F.col("value").isNotNull())
        # k rows per column: a proven size bound
        parts.append(named.join(F.broadcast(kept), ["column_name", "h1", "h2"]).groupBy("column_name", "h1", "h2", "count")
                          .agg(F.first("value").alias("value")).select("column_name", "value", "count"))
    top = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    order = Window.partitionBy("column_name").orderBy(F.desc("count"), F.asc("value"))
    rows = df.agg(F.count(F.lit(1)).alias("_n"))  # one row
    top = top.select("column_name", "value", "count", F.row_number().over(order).alias("rank"))
    return top.crossJoin(F.broadcast(rows)).withColumn("ratio", F.col("count") / F.col("_n")).drop("_n")


def profile_scan(df: DataFrame, include: list[str] | None = None, exclude: list[str] = (),
                 row_filter: str | None = None, sampling_percent: float = 100.0, seed: int = 11,
                 incremental_col: str | None = None, last_watermark=None, top_k: int = 10) -> DataFrame:
    """Profile: nullRatio, distinctRatio, top-k, string lengths, numeric mean/std/
    min/max and quartiles; complex types get nullRatio only.  Options: row
    filter, sampling (at least 100 rows are expected), include/exclude (exclude
    wins) and incremental scan above a stored watermark of a time column."""
    d = df
    if incremental_col and last_watermark is not None:
        d = d.where(F.col(incremental_col) > F.lit(last_watermark))
    if row_filter:
        d = d.where(F.expr(row_filter))
    if sampling_percent < 100:
        d = d.sample(fraction=sampling_percent / 100.0, seed=seed)
    cols = [c for c in (include or df.columns) if c not in set(exclude)]
    d = d.select(*cols)
    desc = describe_data(d, num_quantiles=4, top_k=top_k)
    return desc.select("column_name", "data_type", "num_rows",
                       (F.col("num_nulls") / F.col("num_rows")).alias("null_ratio"),
                       (F.col("num_unique") / F.col("num_rows")).alias("distinct_ratio"),
                       "mean", "stddev", "min", "max",
                       F.col("quantiles")[1].alias("q1"), F.col("quantiles")[2].alias("median"),
                       F.col("quantiles")[3].alias("q3"), "avg_string_length", "top_values")


def null_cardinality_profile(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Per column: nulls and distinct values (one aggregate, unpivoted)."""
    cols = cols or df.columns
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(F.col(c)))
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}__n") for c in cols], *[cd(c).alias(f"{c}__d") for c in cols])
    stack = ", ".join([f"'{c}', `{c}__n`, `{c}__d`" for c in cols])
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, nulls, distinct_values)")


# ------------------------------------------------------------ leakage ----------

def leakage_null_label(df: DataFrame, label: Column, cols: list[str], tau: float = 0.2) -> DataFrame:
    """Does a column's null-ness predict the label?  Null rate per label value for
    all columns in one pass; flag when the gap is at least ``tau``."""
    y = label.cast("boolean")
    aggs = []
    for c in cols:
        aggs += [F.avg(F.when(y, F.col(c).isNull().cast("int"))).alias(f"{c}__y"),
                 F.avg(F.when(~y, F.col(c).isNull().cast("int"))).alias(f"{c}__n")]
    wide = df.agg(*aggs)
    stack = ", ".join([f"'{c}', `{c}__y`, `{c}__n`" for c in cols])
    r = wide.selectExpr(f"stack({len(cols)}, {stack}) as (column_name, null_rate_pos, null_rate_neg)")
    gap = F.abs(F.col("null_rate_pos") - F.col("null_rate_neg"))
    return r.withColumn("gap", gap).withColumn("suspected_leak", F.col("gap") >= tau)


def point_in_time_contract(features: DataFrame, feature_ts: str, labels: DataFrame, label_ts: str,
                           as_of, label_days: int) -> DataFrame:
    """Features must be on or before ``as_of``; labels in (as_of, as_of + days].
    Returns both dates, the observed extremes and an ``ok`` flag."""
    a = F.to_date(F.lit(str(as_of)))
    f = features.agg(F.max(F.to_date(feature_ts)).alias("max_feature_date"))
    lab = labels.agg(F.min(F.to_date(label_ts)).alias("min_label_date"),
                     F.max(F.to_date(label_ts)).alias("max_label_date"))
    r = f.crossJoin(lab).select(a.alias("as_of"), F.date_add(a, label_days).alias("label_end"), "*")
    ok = ((F.col("max_feature_date") <= F.col("as_of")) & (F.col("min_label_date") > F.col("as_of"))
          & (F.col("max_label_date") <= F.col("label_end")))
    return r.withColumn("ok", ok)


# ------------------------------------------------------------ DQ rules ---------

DIMENSIONS = ("FRESHNESS", "VOLUME", "COMPLETENESS", "VALIDITY", "CONSISTENCY", "ACCURACY", "UNIQUENESS")


def _rule_condition(rule: dict) -> Column | None:
    if rule["type"] == "template":  # a named, parameterised row condition
        return F.expr(rule["template"].format(column=rule.get("column"), **rule.get("params", {})))
    t, c = rule["type"], rule.get("column")
    x = F.col(c) if c else None
    if t == "nonNull":
        return x.isNotNull()
    if t == "range":
        cond = F.lit(True)
        if rule.get("min") is not None:
            cond = cond & ((x >= rule["min"]) if rule.get("strict_min") is not True else (x > rule["min"]))
        if rule.get("max") is not None:
            cond = cond & ((x <= rule["max"]) if rule.get("strict_max") is not True else (x < rule["max"]))
        return cond
    if t == "set":
        return x.isin(list(rule["values"]))
    if t == "regex":
        return x.cast("string").rlike(rule["pattern"])
    if t == "rowCondition":
        return F.expr(rule["expr"])
    return None


def dq_scan(df: DataFrame, rules: list[dict]) -> DataFrame:
    """Evaluate rules; one row per rule: ``rule, column, dimension, rows_evaluated,
    rows_passed, pass_ratio, threshold, passed``.

    Row rules (nonNull, range, set, regex, rowCondition) compile into ONE
    aggregate pass; NULL fails a row rule unless ``ignoreNull``.  Table-level
    rules (uniqueness, statisticRange, tableCondition, sqlAssertion) are
    aggregates of their own, each one distributed pass."""
    spark = df.sparkSession
    row_rules = [r for r in rules if r["type"] in ("nonNull", "range", "set", "regex", "rowCondition", "template")]
    aggs, outs = [], []
    for i, r in enumerate(row_rules):
        cond = _rule_condition(r)
        c = r.get("column")
        evaluated = F.col(c).isNotNull() if (r.get("ignoreNull") and c and r["type"] != "nonNull") else F.lit(True)
        ok = F.coalesce(cond, F.lit(False))
        aggs += [F.count_if(evaluated).alias(f"e{i}"), F.count_if(evaluated & ok).alias(f"p{i}")]
    parts = []
    if row_rules:
        wide = df.agg(*aggs)
        for i, r in enumerate(row_rules):
            parts.append(wide.select(F.lit(r["name"]).alias("rule"), F.lit(r.get("column")).alias("column"),
                                     F.lit(r.get("dimension", "VALIDITY")).alias("dimension"),
                                     F.col(f"e{i}").alias("rows_evaluated"), F.col(f"p{i}").alias("rows_passed"),
                                     F.lit(float(r.get("threshold", 1.0))).alias("threshold")))
    for r in rules:
        t, c = r["type"], r.get("column")
        meta = [F.lit(r["name"]).alias("rule"), F.lit(c).alias("column"),
                F.lit(r.get("dimension", "VALIDITY")).alias("dimension")]
        thr = F.lit(float(r.get("threshold", 1.0))).alias("threshold")
        if t == "uniqueness":
            d = df.where(F.col(c).isNotNull()) if r.get("ignoreNull") else df
            g = d.groupBy(c).agg(F.count(F.lit(1)).alias("_dq_k"))
            parts.append(g.agg(F.sum("_dq_k").alias("rows_evaluated"),
                               F.sum(F.when(F.col("_dq_k") == 1, 1).otherwise(0)).alias("rows_passed")).select(
                *meta, F.coalesce("rows_evaluated", F.lit(0)).cast("bigint").alias("rows_evaluated"),
                F.coalesce("rows_passed", F.lit(0)).cast("bigint").alias("rows_passed"), thr))
        elif t == "statisticRange":
            fn = {"mean": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp}[r["statistic"]]
            v = df.agg(fn(F.col(c)).alias("v"))
            ok = (F.col("v") >= r.get("min", float("-inf"))) & (F.col("v") <= r.get("max", float("inf")))
            parts.append(v.select(*meta, F.lit(1).cast("bigint").alias("rows_evaluated"),
                                  F.coalesce(ok, F.lit(False)).cast("bigint").alias("rows_passed"), thr))
        elif t == "tableCondition":
            v = df.agg(F.expr(r["expr"]).alias("v"))
            parts.append(v.select(*meta, F.lit(1).cast("bigint").alias("rows_evaluated"),
                                  F.coalesce(F.col("v"), F.lit(False)).cast("bigint").alias("rows_passed"), thr))
        elif t == "sqlAssertion":
            # the statement returns failing rows; the rule passes when it returns none
            df.createOrReplaceTempView(r.get("view", "data"))
            bad = spark.sql(r["sql"]).agg(F.count(F.lit(1)).alias("b"))
            parts.append(bad.select(*meta, F.lit(1).cast("bigint").alias("rows_evaluated"),
                                    (F.col("b") == 0).cast("bigint").alias("rows_passed"), thr))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    ratio = F.when(F.col("rows_evaluated") > 0, F.col("rows_passed") / F.col("rows_evaluated")).otherwise(F.lit(1.0))
    return out.withColumn("pass_ratio", ratio).withColumn("passed", F.col("pass_ratio") >= F.col("threshold"))


def dq_scores(results: DataFrame) -> DataFrame:
    """Scores 0-100 at job, column and dimension level (share of passed rules)."""
    s = lambda: F.round(100 * F.avg(F.col("passed").cast("int")), 1)
    job = results.agg(s().alias("score")).select(F.lit("job").alias("level"), F.lit("all").alias("name"), "score")
    col = results.where(F.col("column").isNotNull()).groupBy("column").agg(s().alias("score")).select(
        F.lit("column").alias("level"), F.col("column").alias("name"), "score")
    dim = results.groupBy("dimension").agg(s().alias("score")).select(
        F.lit("dimension").alias("level"), F.col("dimension").alias("name"), "score")
    return job.unionByName(col).unionByName(dim)


def dq_failed_rows(df: DataFrame, rule: dict) -> DataFrame:
    """Rows failing one row-level rule (NULL fails unless ``ignoreNull``)."""
    cond = _rule_condition(rule)
    c = rule.get("column")
    bad = ~F.coalesce(cond, F.lit(False))
    if rule.get("ignoreNull") and c:
        bad = bad & F.col(c).isNotNull()
    return df.where(bad).withColumn("failed_rule", F.lit(rule["name"]))


def generate_dq_rules(profile: DataFrame, max_set: int = 10) -> list[dict]:
    """Propose rules from a ``describe_data`` profile (a small table: one row per
    column, so collecting it is bounded by the column count)."""
    rules = []
    for r in profile.collect():
        c = r["column_name"]
        if r["num_nulls"] == 0:
            rules.append({"name": f"{c}_not_null", "type": "nonNull", "column": c, "dimension": "COMPLETENESS"})
        if r["num_unique"] is not None and r["num_unique"] >= r["num_rows"] and r["num_rows"] > 0:
            rules.append({"name": f"{c}_unique", "type": "uniqueness", "column": c, "dimension": "UNIQUENESS"})
        elif r["min"] is not None:
            rules.append({"name": f"{c}_range", "type": "range", "column": c, "min": r["min"], "max": r["max"],
                          "dimension": "VALIDITY", "ignoreNull": True})
        elif r["num_unique"] is not None and r["num_unique"] <= max_set and r["top_values"]:
            vals = [t["value"] for t in r["top_values"]]
            if len(vals) >= r["num_unique"]:
                rules.append({"name": f"{c}_set", "type": "set", "column": c, "values": vals,
                              "dimension": "VALIDITY", "ignoreNull": True})
    return rules


def table_assertions(df: DataFrame, non_null: list[str] = (), row_conditions: list[str] = (),
                     unique_key: list[str] | None = None) -> DataFrame:
    """Build-time assertions; returns the violating rows (a view of failures)
    with the assertion name.  Use ``raise_on_violations`` to block the build."""
    parts = []
    for c in non_null:
        parts.append(df.where(F.col(c).isNull()).select(F.lit(f"nonNull:{c}").alias("assertion"),
                                                        F.to_json(F.struct(*df.columns)).alias("row")))
    for e in row_conditions:
        parts.append(df.where(~F.coalesce(F.expr(e), F.lit(False))).select(
            F.lit(f"rowCondition:{e}").alias("assertion"), F.to_json(F.struct(*df.columns)).alias("row")))
    if unique_key:
        dup = df.groupBy(*unique_key).agg(F.count(F.lit(1)).alias("_k")).where(F.col("_k") > 1)
        parts.append(dup.select(F.lit("uniqueKey:" + ",".join(unique_key)).alias("assertion"),
                                F.to_json(F.struct(*unique_key, "_k")).alias("row")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def raise_on_violations(violations: DataFrame) -> None:
    n = violations.agg(F.count(F.lit(1)).alias("n")).collect()[0]["n"]
    if n:
        raise AssertionError(f"{n} assertion violation(s)")


def report_json(report: DataFrame) -> str:
    """A small report (one row per input column) as JSON text."""
    return json.dumps([r.asDict() for r in report.collect()], default=str)
