"""Aggregations: conditional counts, rates, distinct counts, histograms, correlations,
decision curves and contribution analysis.  Every operator is one grouped pass
with algebraic aggregates (partial aggregation before the shuffle) unless noted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.core import col, safe_divide
from sparklab.operators import ranking


def rate_pct(hits: Column, n: Column, digits: int = 1) -> Column:
    return F.round(100 * hits / n, digits)


def countif_pivot(df: DataFrame, group: list[str], cases: dict[str, Column], total: str = "total") -> DataFrame:
    """Hand pivot: one ``count_if`` column per named condition plus a total."""
    aggs = [F.count_if(c).alias(name) for name, c in cases.items()]
    return df.groupBy(*group).agg(*aggs, F.count(F.lit(1)).alias(total))


def rate_by_group(df: DataFrame, group: list[str], cond: Column, n_name: str = "n", hits_name: str = "hits",
                  rate_name: str = "rate_pct") -> DataFrame:
    g = df.groupBy(*group).agg(F.count(F.lit(1)).alias(n_name), F.count_if(cond).alias(hits_name))
    return g.withColumn(rate_name, rate_pct(F.col(hits_name), F.col(n_name)))


def rule_precision_recall(df: DataFrame, rule: Column, truth: Column, digits: int = 3) -> DataFrame:
    """Precision and recall of a boolean business rule against a truth flag."""
    g = df.agg(F.count_if(rule).alias("flagged"), F.count_if(rule & truth).alias("caught"),
               F.count_if(truth).alias("positives"))
    return g.select("flagged", "caught",
                    F.round(safe_divide(F.col("caught"), F.col("positives")), digits).alias("recall"),
                    F.round(safe_divide(F.col("caught"), F.col("flagged")), digits).alias("precision"))


def agreement_pct(df: DataFrame, agree: Column, where: Column | None = None) -> DataFrame:
    d = df.where(where) if where is not None else df
    return d.agg(F.count(F.lit(1)).alias("scored"),
                 F.round(100 * F.count_if(agree) / F.count(F.lit(1)), 1).alias("agreement_pct"))


def distinct_counts(df: DataFrame, cols: list[str], null_cols: list[str] = (), approx: bool = False) -> DataFrame:
    """Several ``COUNT(DISTINCT)`` in one statement.  Exact mode is rewritten by
    Catalyst into one Expand + two aggregations; ``approx`` uses HLL++ sketches
    (mergeable partial aggregates, fixed memory) for very large inputs."""
    cd = (lambda c: F.approx_count_distinct(c)) if approx else (lambda c: F.count_distinct(F.col(c)))
    aggs = [F.count(F.lit(1)).alias("rows")] + [cd(c).alias(f"distinct_{c}") for c in cols]
    aggs += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in null_cols]
    return df.agg(*aggs)


def string_agg_distinct(df: DataFrame, group: list[str], c: str, sep: str = ",", out: str | None = None) -> DataFrame:
    """``STRING_AGG(DISTINCT c ORDER BY c, sep)``: the distinct set is built by a
    partial aggregate (``collect_set`` merges per partition), so a hot group only
    ever holds its distinct values."""
    out = out or f"{c}_list"
    s = F.array_sort(F.collect_set(F.col(c)))
    return df.groupBy(*group).agg(F.array_join(s, sep).alias(out))


def having_topk(df: DataFrame, key: str, min_count: int, k: int, extra: dict[str, Column] | None = None,
                count_name: str = "mentions") -> DataFrame:
    """GROUP BY key HAVING count >= min ORDER BY count DESC, key LIMIT k."""
    aggs = [F.count(F.lit(1)).alias(count_name)] + [v.alias(n) for n, v in (extra or {}).items()]
    g = df.groupBy(key).agg(*aggs).where(F.col(count_name) >= min_count)
    return g.orderBy(F.desc(count_name), F.asc(key)).limit(k)


def approx_quantiles(df: DataFrame, c: str, n: int = 100, accuracy: int = 10_000) -> DataFrame:
    """``APPROX_QUANTILES(c, n)``: n+1 boundaries as an array (KLL-style sketch
    merged across partitions)."""
    probs = [i / n for i in range(n + 1)]
    return df.agg(F.percentile_approx(F.col(c), probs, accuracy).alias(f"{c}_quantiles"))


def quantile_sketches(df: DataFrame, c: str, by: list[str], k: int = 200) -> DataFrame:
    """Mergeable KLL sketches of ``c`` per group (e.g. per day): store them, then
    ``merged_quantiles`` answers for any union of groups without rescanning."""
    return df.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(k)).alias("sketch"))


def merged_quantiles(sketches: DataFrame, probs: list[float]) -> DataFrame:
    merged = sketches.agg(F.kll_merge_agg_double("sketch").alias("m"))
    return merged.select(*[F.kll_sketch_get_quantile_double("m", F.lit(p)).alias(f"q{int(round(p * 100))}")
                           for p in probs])


def distinct_sketches(df: DataFrame, c: str, by: list[str]) -> DataFrame:
    """Mergeable HLL sketches of distinct ``c`` per group."""
    return df.groupBy(*by).agg(F.hll_sketch_agg(F.col(c)).alias("sketch"))


def merged_distinct(sketches: DataFrame) -> DataFrame:
    return sketches.agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("approx_distinct"))


def histogram_fixed(df: DataFrame, c: str, width: float, out: str = "bin") -> DataFrame:
    b = (F.floor(F.col(c) / F.lit(width)) * F.lit(width))
    return df.groupBy(b.alias(out)).agg(F.count(F.lit(1)).alias("n"))


def corr_with_label(df: DataFrame, features: list[str], label: Column, digits: int = 4) -> DataFrame:
    """``CORR(feature, y)`` for many features in ONE scan, unpivoted to rows
    (the N-way UNION ALL of the SQL would scan N times)."""
    y = label.cast("double")
    wide = df.agg(*[F.corr(F.col(f).cast("double"), y).alias(f) for f in features])
    stack = ", ".join([f"'{f}', `{f}`" for f in features])
    long = wide.selectExpr(f"stack({len(features)}, {stack}) as (feature, corr_raw)")
    return long.select("feature", F.round("corr_raw", digits).alias("corr_with_label"))


def corr_redundancy(df: DataFrame, features: list[str], threshold: float = 0.95) -> DataFrame:
    """Pairwise correlations in one scan; pairs with ``|corr| >= threshold``."""
    pairs = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join([f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs])
    long = wide.selectExpr(f"stack({len(pairs)}, {stack}) as (feature_a, feature_b, corr)")
    return long.where(F.abs("corr") >= threshold)


def describe_events(df: DataFrame, key: str, ts: str, type_col: str) -> DataFrame:
    d = F.to_date(F.col(ts))
    return df.agg(F.count(F.lit(1)).alias("events"), F.count_distinct(key).alias("distinct_keys"),
                  F.min(d).alias("earliest"), F.max(d).alias("latest"),
                  F.count_distinct(type_col).alias("event_types"))


def daily_rollup(df: DataFrame, ts: str, value: str, key: str, extra: dict | None = None) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("n"), F.round(F.avg(value), 4).alias(f"avg_{value}"),
            F.count_distinct(key).alias(f"distinct_{key}")]
    aggs += [v.alias(n) for n, v in (extra or {}).items()]
    return df.groupBy(F.to_date(F.col(ts)).alias("day")).agg(*aggs)


def group_mean_median(df: DataFrame, group: list[str], value: str, digits: int = 4) -> DataFrame:
    """Count, mean and exact median per group.  The median is found by distributed selection (``ranking.exact_quantiles``),
    so a group that holds most rows is not gathered in one task."""
    m = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.round(F.avg(value), digits).alias("mean"))
    med = ranking.exact_quantiles(df, group, value, {"median": 0.5}).select(*[F.col(c).alias(f"_g{k}") for k, c in enumerate(group)], F.round("median", digits).alias("median"))
    same = F.lit(True)
    for k, c in enumerate(group):
        same = same & m[c].eqNullSafe(med[f"_g{k}"])
    return m.join(med, same, "left").select(*group, "n", "mean", "median")


def top_categories(df: DataFrame, c: str, k: int = 15) -> DataFrame:
    g = df.groupBy(c).agg(F.count(F.lit(1)).alias("n"))
    return g.orderBy(F.desc("n"), F.asc(c)).limit(k)


def decile_calibration(scores: DataFrame, p: str, truth: Column, revenue: str, key: str, k: int = 10) -> DataFrame:
    """``k`` equal groups by score (distributed ntile; group ``k`` has the highest scores), and for each: rows, mean score,
    share of true rows, the gap between the two, and the sum of ``revenue``."""
    d = ranking.ntile(scores.withColumn("_y", truth.cast("int")), k, [], [F.col(p), F.col(key)], "decile")
    g = d.groupBy("decile").agg(F.count(F.lit(1)).alias("n"), F.avg(p).alias("s"), F.avg("_y").alias("y"), F.sum(revenue).alias("r"))
    return g.select("decile", "n", F.round("s", 4).alias("mean_score"), F.round("y", 4).alias("true_share"),
                    F.round(F.col("s") - F.col("y"), 4).alias("gap"), F.round("r", 2).alias("revenue"))


def threshold_grid(spark, lo_pct: int, hi_pct: int, step_pct: int, name: str = "th") -> DataFrame:
    """Float thresholds built from integers (no float-step drift): lo/100 .. hi/100."""
    return spark.range(lo_pct, hi_pct + 1, step_pct).select((F.col("id") / 100.0).alias(name))


def expected_value_curve(scores: DataFrame, p: str, truth: Column, charges: str, thresholds: DataFrame,
                         offer_cost: float = 12.0, save_rate: float = 0.30, months_retained: float = 12.0,
                         margin_rate: float = 0.45) -> DataFrame:
    """What acting on all scores from a threshold up would bring, per threshold: contacted rows, churners_reached,
    precision, recall and net_value (the margin of the churners that stay, less the offers).

    A row only matters by the number of thresholds its score reaches, so rows are summed once, per number; each
    threshold's figures are the sums of the cells from its own up."""
    levels = sorted(r[0] for r in thresholds.collect())  # the grid is a parameter
    reached = F.lit(0)
    for t in levels:
        reached = reached + F.when(F.col(p) >= t, 1).otherwise(0)
    kept = F.col(charges) * (months_retained * margin_rate * save_rate)
    cells = scores.select(reached.alias("cell"), truth.alias("y"), kept.alias("kept")).groupBy("cell").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("y").alias("hits"), F.sum(F.when(F.col("y"), F.col("kept")).otherwise(0.0)).alias("kept"))
    grid = scores.sparkSession.createDataFrame([(k + 1, t) for k, t in enumerate(levels)], "cell int, th double")
    # a row per threshold and one for the rows below all: the window holds no more
    up = Window.orderBy(F.desc("cell")).rowsBetween(Window.unboundedPreceding, 0)
    total = [F.coalesce(F.sum(c).over(up), F.lit(0)).alias(c) for c in ("n", "hits", "kept")]
    every = F.sum("hits").over(Window.partitionBy()).alias("positives")
    sums = cells.join(grid, "cell", "full").select("th", every, *total).where("th IS NOT NULL")
    return sums.select(
        F.round("th", 2).alias("threshold"), F.col("n").alias("contacted"), F.col("hits").alias("churners_reached"),
        F.round(safe_divide(F.col("hits"), F.col("n")), 3).alias("precision"), F.round(safe_divide(F.col("hits"), F.col("positives")), 3).alias("recall"),
        F.round(F.col("kept") - F.col("n") * offer_cost, 0).alias("net_value"))


def contribution_analysis(df: DataFrame, dims: list[str], metric: Column, is_test: Column,
                          min_support: float = 0.0) -> DataFrame:
    """Which segments drove a metric change between control and test rows.

    ``cube`` over the dimensions (all segment combinations, NULL = all) with
    conditional sums for both sides in one pass; ``grouping_id`` tells an
    all-values NULL apart from a data NULL.  Segments whose support (share of
    the test total) is below ``min_support`` are dropped."""
    d = df.select(*dims, metric.alias("_m"), is_test.alias("_t"))
    g = d.cube(*dims).agg(F.grouping_id().alias("gid"),
                          F.sum(F.when(~F.col("_t"), F.col("_m")).otherwise(F.lit(0.0))).alias("control"),
                          F.sum(F.when(F.col("_t"), F.col("_m")).otherwise(F.lit(0.0))).alias("test"))
    tot = g.where(F.col("gid") == (1 << len(dims)) - 1).select(F.col("test").alias("_tt"))
    g = g.crossJoin(F.broadcast(tot))
    g = g.withColumn("support", safe_divide(F.col("test"), F.col("_tt")))
    g = g.where(F.col("support") >= min_support) if min_support > 0 else g
    return g.select(*dims, "gid", F.round("control", 2).alias("control"), F.round("test", 2).alias("test"),
                    F.round(F.col("test") - F.col("control"), 2).alias("delta"),
                    F.round(safe_divide(F.col("test") - F.col("control"), F.col("control")), 6).alias("rel_change"))
