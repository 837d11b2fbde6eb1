"""Attributions (exact linear, sampled Shapley), model-agnostic probes, and
fairness measures per slice.

Black-box probes (Shapley paths, permutations, partial dependence) expand the
rows by a *fixed* factor (paths x steps, grid size) and score everything with
one batch ``transform`` of the model — the expansion never grows with the
data beyond that constant, and no row is dropped or sampled away."""

from __future__ import annotations

import random

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.core import md5num, safe_divide
from sparklab.operators import ranking


# ------------------------------------------------------------------ attributions ---

def linear_attributions(df: DataFrame, key: str, features_col: str, weights: list[float], names: list[str],
                        baseline: list[float] | None = None, top_k: int | None = None) -> DataFrame:
    """Exact attributions of a linear model: ``w_j * (x_j - baseline_j)`` (in the
    model's input space; they add up to logit(x) - logit(baseline)).  Long
    output (key, feature, attribution), optionally the top-k by magnitude."""
    base = baseline or [0.0] * len(weights)
    w = F.array(*[F.lit(float(v)) for v in weights])
    b = F.array(*[F.lit(float(v)) for v in base])
    nm = F.array(*[F.lit(n) for n in names])
    x = vector_to_array(features_col)
    contrib = F.transform(F.arrays_zip(nm.alias("f"), x.alias("x"), w.alias("w"), b.alias("b")),
                          lambda z: F.struct(z["f"].alias("feature"), (z["w"] * (z["x"] - z["b"])).alias("attribution")))
    long = df.select(key, F.inline(contrib))
    if top_k:
        rk = Window.partitionBy(key).orderBy(F.desc(F.abs("attribution")), "feature")
        long = long.withColumn("rank", F.row_number().over(rk)).where(F.col("rank") <= top_k)
    return long


def global_explain(attr: DataFrame) -> DataFrame:
    """Mean absolute attribution per feature."""
    return attr.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("attribution"))


def sampled_shapley(model, df: DataFrame, key: str, features_col: str, names: list[str], path_count: int = 10,
                    baseline: list[float] | None = None, positive_index: int = 1, seed: int = 7) -> DataFrame:
    """Sampled Shapley values for any model that scores a feature vector.

    For each row and each of ``path_count`` random feature orders, the d+1
    vectors along the path (baseline -> row, one feature switched per step)
    are scored in one batch; a feature's contribution is the score change at
    its step, averaged over paths.  Efficiency holds per path: contributions
    sum to f(x) - f(baseline)."""
    if not 1 <= path_count <= 50:
        raise ValueError("path_count must be in [1, 50]")
    d = len(names)
    rng = random.Random(seed)
    perms = []
    for pid in range(path_count):
        order = list(range(d))
        rng.shuffle(order)
        # position of each feature in this order
        pos = [0] * d
        for i, f in enumerate(order):
            pos[f] = i
        perms.append((pid, order, pos))
    spark = df.sparkSession
    ptab = spark.createDataFrame(perms, "path int, perm_order array<int>, perm_pos array<int>")  # path_count rows
    base = F.array(*[F.lit(float(v)) for v in (baseline or [0.0] * d)])
    x = df.select(key, vector_to_array(features_col).alias("_x"))
    steps = x.crossJoin(F.broadcast(ptab)).withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(d))))
    vec = F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                      lambda j: F.when(F.col("perm_pos")[j] < F.col("step"), F.col("_x")[j]).otherwise(base[j]))
    scored = model.transform(steps.withColumn(features_col, array_to_vector(vec)))
    p = vector_to_array("probability")[positive_index] if "probability" in scored.columns else F.col("prediction")
    s = scored.select(key, "step", "perm_order", p.alias("_f"))
    # the change at a step is its score less the score before: a score counts for the feature switched at its step and
    # against the next one, so sums per (row, feature) are enough and no path is put in order
    ends = F.array(F.when(F.col("step") > 0, F.struct(F.element_at("perm_order", F.greatest(F.col("step"), F.lit(1))).alias("j"), F.col("_f").alias("v"), F.lit(1).alias("n"))),
                   F.when(F.col("step") < d, F.struct(F.element_at("perm_order", F.least(F.col("step") + 1, F.lit(d))).alias("j"), (-F.col("_f")).alias("v"), F.lit(0).alias("n"))))
    sums = s.select(key, F.inline(F.filter(ends, lambda e: e.isNotNull()))).groupBy(key, "j").agg(F.sum("v").alias("_v"), F.sum("n").alias("_n"))
    # rows that share a key share its paths: every step is there once for each of them, the change comes once
    rows = F.col("_n") / F.lit(float(path_count))
    name = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("j") + 1)
    return sums.select(key, name.alias("feature"), (F.col("_v") / F.col("_n") / rows).alias("attribution"))


def approximation_error(attr: DataFrame, key: str, fx: DataFrame, fbase: float) -> DataFrame:
    """|sum of attributions - (f(x) - f(baseline))| relative to |f(x) - f(baseline)|;
    ``warn`` above 0.05."""
    s = attr.groupBy(key).agg(F.sum("attribution").alias("_sum"))
    j = s.join(fx, key)
    gap = F.col("_f") - F.lit(fbase)
    err = F.abs(F.col("_sum") - gap) / F.greatest(F.abs(gap), F.lit(1e-12))
    return j.select(key, err.alias("approximation_error"), (err > 0.05).alias("warn"))


# ------------------------------------------------------------------ probes --------

def permute_column(df: DataFrame, key: str, col: str, seed: int = 7) -> DataFrame:
    """Seeded shuffle of one column: rows ranked by key and by a seeded hash are
    matched rank-to-rank (distributed row numbers; no collect)."""
    a = ranking.row_number(df.drop(col), [], [F.col(key)], "_r")
    b = ranking.row_number(df.select(key, col).withColumn("_h", md5num(F.col(key).cast("string"), F.lit(str(seed)))),
                           [], [F.col("_h"), F.col(key)], "_r").select("_r", F.col(col))
    return a.join(b, "_r").drop("_r")


def partial_dependence(model, df: DataFrame, feature: str, grid: DataFrame, score: Column, key: str | None = None):
    """Prediction as one feature sweeps a grid (the grid is a small parameter
    table, cross-joined: rows x grid points).  With ``key`` returns the ICE
    curves, else their average."""
    g = grid.select(F.col(grid.columns[0]).alias("_g"))
    x = df.crossJoin(F.broadcast(g)).withColumn(feature, F.col("_g").cast(df.schema[feature].dataType))
    s = model.transform(x).withColumn("_p", score)
    if key:
        return s.select(key, F.col("_g").alias("grid_value"), F.col("_p").alias("prediction"))
    return s.groupBy(F.col("_g").alias("grid_value")).agg(F.avg("_p").alias("avg_prediction"))


# ------------------------------------------------------------------ fairness ------

def sliced_metrics(scores: DataFrame, slice_col: str, p: str, y: Column, threshold: float = 0.5) -> DataFrame:
    hit = F.col(p) >= threshold
    g = scores.groupBy(slice_col).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit & y).alias("tp"),
                                      F.count_if(hit & ~y).alias("fp"), F.count_if(~hit & y).alias("fn"),
                                      F.count_if(~hit & ~y).alias("tn"))
    return g.select(slice_col, "n", ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
                    safe_divide(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
                    safe_divide(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"))


def _vs_rest(g: DataFrame, slice_col: str, cnt: dict) -> DataFrame:
    """Attach totals so every slice can be compared with the rest."""
    tot = g.agg(*[F.sum(c).alias(f"_t_{c}") for c in cnt])
    return g.crossJoin(F.broadcast(tot))


def data_bias(df: DataFrame, slice_col: str, y: Column) -> DataFrame:
    """Per slice: size, share and positive rate in the true labels; the
    difference in positive rate vs the rest of the data."""
    g = df.groupBy(slice_col).agg(F.count(F.lit(1)).alias("n"), F.count_if(y).alias("pos"))
    g = _vs_rest(g, slice_col, {"n": 1, "pos": 1})
    rest_rate = safe_divide(F.col("_t_pos") - F.col("pos"), F.col("_t_n") - F.col("n"))
    return g.select(slice_col, "n", (F.col("n") / F.col("_t_n")).alias("share"),
                    (F.col("pos") / F.col("n")).alias("positive_rate"),
                    ((F.col("pos") / F.col("n")) - rest_rate).alias("label_rate_difference"))


def model_bias(scores: DataFrame, slice_col: str, p: str, y: Column, threshold: float = 0.5,
               max_gap: float = 0.1) -> DataFrame:
    """DPPPL (difference in predicted positive proportion), accuracy difference,
    FPR and FNR gaps of each slice vs the rest; ``passed`` when |DPPPL| <= max_gap."""
    hit = F.col(p) >= threshold
    g = scores.groupBy(slice_col).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("pp"),
                                      F.count_if(hit == y).alias("ok"), F.count_if(hit & ~y).alias("fp"),
                                      F.count_if(~y).alias("neg"), F.count_if(~hit & y).alias("fn"),
                                      F.count_if(y).alias("pos"))
    g = _vs_rest(g, slice_col, {c: 1 for c in ("n", "pp", "ok", "fp", "neg", "fn", "pos")})

    def rest(c):
        return F.col(f"_t_{c}") - F.col(c)
    dpppl = F.col("pp") / F.col("n") - safe_divide(rest("pp"), rest("n"))
    acc = F.col("ok") / F.col("n") - safe_divide(rest("ok"), rest("n"))
    fpr = safe_divide(F.col("fp"), F.col("neg")) - safe_divide(rest("fp"), rest("neg"))
    fnr = safe_divide(F.col("fn"), F.col("pos")) - safe_divide(rest("fn"), rest("pos"))
    return g.select(slice_col, "n", dpppl.alias("dpppl"), acc.alias("accuracy_difference"),
                    fpr.alias("fpr_gap"), fnr.alias("fnr_gap"), (F.abs(dpppl) <= max_gap).alias("passed"))


def _grid_counts(scores: DataFrame, slice_col: str, p: str, y: Column, steps: int) -> DataFrame:
    """Per (slice, threshold t/steps): predicted positives, true positives, and
    slice totals — from counts per (slice, score cell), a partial aggregate."""
    from sparklab.operators.ml import _grid_index
    spark = scores.sparkSession
    cells = (scores.select(slice_col, F.least(F.greatest(_grid_index(F.col(p), steps), F.lit(-1)), F.lit(steps)).alias("k"),
                           y.alias("_y"))
                   .groupBy(slice_col, "k").agg(F.count_if("_y").alias("pos"), F.count_if(~F.col("_y")).alias("neg")))
    grid = spark.range(0, steps + 1).select(F.col("id").cast("int").alias("t"))
    j = cells.crossJoin(F.broadcast(grid))  # (slices x cells) x grid, all bounded
    above = F.col("k") >= F.col("t")
    g = j.groupBy(slice_col, "t").agg(F.sum(F.when(above, F.col("pos") + F.col("neg")).otherwise(0)).alias("pp"),
                                      F.sum(F.when(above, F.col("pos")).otherwise(0)).alias("tp"),
                                      F.sum(F.when(~above, F.col("neg")).otherwise(0)).alias("tn"),
                                      F.sum(F.col("pos") + F.col("neg")).alias("n"), F.sum("pos").alias("npos"))
    return g


def per_slice_thresholds(scores: DataFrame, slice_col: str, p: str, y: Column, criterion: str = "demographic_parity",
                         steps: int = 100, base_threshold: float = 0.5) -> DataFrame:
    """Choose a threshold per slice: ``single`` (everyone at base), or the grid
    threshold bringing each slice closest to the overall rate at the base
    threshold of: positive predictions (``demographic_parity``), true positive
    rate (``equal_opportunity``) or accuracy (``equal_accuracy``).  Ties: the
    threshold nearest the base, then the lower.  Reports the trade-off only."""
    g = _grid_counts(scores, slice_col, p, y, steps).withColumn("threshold", F.col("t") / F.lit(float(steps)))
    metric = {"demographic_parity": F.col("pp") / F.col("n"),
              "equal_opportunity": safe_divide(F.col("tp"), F.col("npos")),
              "equal_accuracy": (F.col("tp") + F.col("tn")) / F.col("n"),
              "single": F.lit(0.0)}[criterion]
    g = g.withColumn("metric", metric)
    hit = F.col(p) >= base_threshold
    overall = {"demographic_parity": scores.agg((F.count_if(hit) / F.count(F.lit(1))).alias("target")),
               "equal_opportunity": scores.agg(safe_divide(F.count_if(hit & y), F.count_if(y)).alias("target")),
               "equal_accuracy": scores.agg((F.count_if(hit == y) / F.count(F.lit(1))).alias("target")),
               "single": scores.agg(F.lit(0.0).alias("target"))}[criterion]
    g = g.crossJoin(F.broadcast(overall))
    if criterion == "single":
        g = g.withColumn("_gap", F.abs(F.col("threshold") - F.lit(base_threshold)))
    else:
        g = g.withColumn("_gap", F.abs(F.col("metric") - F.col("target")))
    w = Window.partitionBy(slice_col).orderBy("_gap", F.abs(F.col("threshold") - F.lit(base_threshold)), "threshold")
    best = g.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)  # slices x grid rows only
    return best.select(slice_col, F.round("threshold", 6).alias("threshold"), "metric", "target",
                       ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"))
