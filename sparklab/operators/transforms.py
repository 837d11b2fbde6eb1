"""Feature transforms that are fitted once and then applied row-locally.

Each transform has two faces:

* a *fit* that returns a small statistics DataFrame (one row, or one row per
  category) computed with distributed aggregates, and an *apply* that joins or
  cross-joins that bounded table back — never an ``OVER ()`` window, which
  would pull the whole column into one task;
* the Spark ML stage that does the same inside a ``Pipeline`` so the
  preprocessing is saved with the model (``bound_pipeline``).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import feature as MF
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import ranking


def fit_moments(df: DataFrame, cols: list[str]) -> DataFrame:
    """One row: mean, sample stddev, min, max, max-abs per column."""
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max"), F.max(F.abs(x)).alias(f"{c}__maxabs")]
    return df.agg(*aggs)


def _with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    return df.crossJoin(F.broadcast(stats))  # one row: proven size bound


def standard_scale(df: DataFrame, cols: list[str], stats: DataFrame | None = None, suffix: str = "_std") -> DataFrame:
    """``(x - AVG(x) OVER ()) / STDDEV(x) OVER ()`` with fitted, stored statistics."""
    st = stats if stats is not None else fit_moments(df, cols)
    j = _with_stats(df, st)
    out = j.select(*df.columns, *[((F.col(c) - F.col(f"{c}__mean")) / F.nullif(F.col(f"{c}__std"), F.lit(0.0)))
                                  .alias(c + suffix) for c in cols])
    return out


def min_max_scale(df: DataFrame, cols: list[str], stats: DataFrame | None = None, suffix: str = "_mm") -> DataFrame:
    st = stats if stats is not None else fit_moments(df, cols)
    j = _with_stats(df, st)
    return j.select(*df.columns, *[((F.col(c) - F.col(f"{c}__min")) /
                                    F.nullif(F.col(f"{c}__max") - F.col(f"{c}__min"), F.lit(0.0))).alias(c + suffix)
                                   for c in cols])


def max_abs_scale(df: DataFrame, cols: list[str], stats: DataFrame | None = None, suffix: str = "_ma") -> DataFrame:
    st = stats if stats is not None else fit_moments(df, cols)
    j = _with_stats(df, st)
    return j.select(*df.columns, *[(F.col(c) / F.nullif(F.col(f"{c}__maxabs"), F.lit(0.0))).alias(c + suffix)
                                   for c in cols])


def robust_scale(df: DataFrame, cols: list[str], suffix: str = "_rb", accuracy: int = 10_000) -> DataFrame:
    """``(x - median) / (q3 - q1)`` with approximate quantiles (a mergeable sketch)."""
    st = df.agg(*[F.percentile_approx(F.col(c).cast("double"), [0.25, 0.5, 0.75], accuracy).alias(f"{c}__q") for c in cols])
    j = _with_stats(df, st)
    return j.select(*df.columns, *[((F.col(c) - F.col(f"{c}__q")[1]) /
                                    F.nullif(F.col(f"{c}__q")[2] - F.col(f"{c}__q")[0], F.lit(0.0))).alias(c + suffix)
                                   for c in cols])


def bucketize(x, edges: list[float]) -> Column:
    """Bin index from *given* edges (implicit -inf/+inf ends): the number of
    edges <= x, so values below the first edge get 0."""
    c = F.col(x) if isinstance(x, str) else x
    total = None
    for e in edges:
        t = (c >= F.lit(float(e))).cast("int")
        total = t if total is None else total + t
    return F.when(c.isNull(), F.lit(None)).otherwise(total)


def quantile_bucketize_exact(df: DataFrame, c: str, n: int, key: str, out: str | None = None) -> DataFrame:
    """N equal-population bins (``NTILE(n) OVER (ORDER BY c, key)``) via the
    distributed ntile; ``QuantileDiscretizer`` is the approximate stage."""
    return ranking.ntile(df, n, [], [F.col(c), F.col(key)], out or f"{c}_qbin")


def hash_bucketize(x, n: int) -> Column:
    return F.pmod(md5num(x), F.lit(n)).cast("int")


def feature_cross(*cols: str, sep: str = "_") -> Column:
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def polynomial_expand(df: DataFrame, cols: list[str]) -> DataFrame:
    """Degree-2 expansion: squares and pairwise products."""
    extra = []
    for i, a in enumerate(cols):
        for b in cols[i:]:
            extra.append((F.col(a) * F.col(b)).alias(f"{a}_x_{b}"))
    return df.select(*df.columns, *extra)


def impute(df: DataFrame, cols: list[str], strategy: str = "mean", suffix: str = "") -> DataFrame:
    """Fill NULLs with the mean / median / most frequent value (fitted once)."""
    if strategy == "mean":
        st = df.agg(*[F.avg(c).alias(f"{c}__fill") for c in cols])
    elif strategy == "median":
        st = df.agg(*[F.median(c).alias(f"{c}__fill") for c in cols])
    elif strategy in ("most_frequent", "mode"):
        st = df.agg(*[F.mode(c, deterministic=True).alias(f"{c}__fill") for c in cols])
    else:
        raise ValueError(strategy)
    j = _with_stats(df, st)
    keep = [c for c in df.columns if not (suffix == "" and c in cols)]
    return j.select(*keep, *[F.coalesce(F.col(c), F.col(f"{c}__fill")).alias(c + suffix) for c in cols])


def fit_label_encoder(df: DataFrame, c: str) -> DataFrame:
    """Category -> integer in alphabetical order (distinct values, dense rank - 1)."""
    d = df.select(c).where(F.col(c).isNotNull()).distinct()
    return ranking.rank(d, [], c, "_r", dense=True).select(c, (F.col("_r") - 1).alias(f"{c}_index"))


def label_encode(df: DataFrame, c: str, mapping: DataFrame | None = None) -> DataFrame:
    m = mapping if mapping is not None else fit_label_encoder(df, c)
    return df.join(m, c, "left")


def ngrams(tokens: Column, n: int, sep: str = " ") -> Column:
    """Array of n-grams of a token array (``NGram`` without the ML stage)."""
    k = F.size(tokens) - F.lit(n)
    return F.when(k < 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.sequence(F.lit(0), k), lambda i: F.array_join(F.slice(tokens, i + 1, n), sep)))


def one_hot_stages(cat_cols: list[str]) -> list:
    """StringIndexer(keep unseen) + OneHotEncoder stages for categorical inputs."""
    idx = [MF.StringIndexer(inputCol=c, outputCol=f"{c}_idx", handleInvalid="keep",
                            stringOrderType="alphabetAsc") for c in cat_cols]
    ohe = MF.OneHotEncoder(inputCols=[f"{c}_idx" for c in cat_cols], outputCols=[f"{c}_ohe" for c in cat_cols],
                           handleInvalid="keep")
    return idx + [ohe]


def bound_pipeline(numeric: list[str], categorical: list[str], estimator, scale: bool = True,
                   quantile_cols: dict | None = None) -> Pipeline:
    """Preprocessing bound to the model: raw columns in at predict time.

    numeric -> Imputer(mean) -> (QuantileDiscretizer for ``quantile_cols``) ->
    VectorAssembler -> StandardScaler; categoricals one-hot encoded."""
    stages = []
    imp_out = [f"{c}_imp" for c in numeric]
    if numeric:
        stages.append(MF.Imputer(inputCols=numeric, outputCols=imp_out, strategy="mean"))
    qcols = []
    for c, n in (quantile_cols or {}).items():
        stages.append(MF.QuantileDiscretizer(inputCol=f"{c}_imp", outputCol=f"{c}_qb", numBuckets=n,
                                             handleInvalid="keep"))
        qcols.append(f"{c}_qb")
    stages += one_hot_stages(categorical) if categorical else []
    inputs = imp_out + qcols + [f"{c}_ohe" for c in categorical]
    stages.append(MF.VectorAssembler(inputCols=inputs, outputCol="features_raw", handleInvalid="keep"))
    if scale:
        stages.append(MF.StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True))
    else:
        stages.append(MF.SQLTransformer(statement="SELECT *, features_raw AS features FROM __THIS__"))
    stages.append(estimator)
    return Pipeline(stages=stages)
