"""Training, splitting, evaluation and decision operators.

Model fitting uses Spark ML estimators (distributed tree aggregation / L-BFGS);
every metric is computed from a scored DataFrame with distributed aggregates
so the same functions evaluate stored scores (exact oracles) and live models.
AUC, ROC and PR curves aggregate to *distinct scores* (or a fixed threshold
grid) first and only then run cumulative sums — through the distributed
prefix sum, never a single-partition window over all rows.
"""

from __future__ import annotations

import math

from pyspark.ml import classification as MC
from pyspark.ml import regression as MR
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import md5num, safe_divide
from sparklab.operators import ranking

EPS = 1e-15


# ---------------------------------------------------------------- splits -------

def data_split(df: DataFrame, method: str = "AUTO", key: str | None = None, eval_fraction: float = 0.2,
               seq_col: str | None = None, custom_col: str | None = None, n_rows: int | None = None) -> DataFrame:
    """Adds ``is_eval`` (and ``split`` for three-way).  AUTO: < 500 rows all train,
    500-50,000 rows 20 % RANDOM, else a smaller fraction; RANDOM is key-hash
    based (reproducible); SEQ puts the last rows by ``seq_col`` in eval; CUSTOM
    reads a boolean column; NO_SPLIT keeps everything for training."""
    m = method.upper()
    if m == "AUTO":
        n = n_rows if n_rows is not None else df.count()
        if n < 500:
            return df.withColumn("is_eval", F.lit(False))
        m, eval_fraction = "RANDOM", (0.2 if n <= 50_000 else min(0.2, 10_000 / n))
    if m == "NO_SPLIT":
        return df.withColumn("is_eval", F.lit(False))
    if m == "CUSTOM":
        return df.withColumn("is_eval", F.col(custom_col).cast("boolean"))
    if m == "RANDOM":
        # thousandths suffice for the usual fractions; a smaller share of a large table needs a finer modulus
        modulus = 1000 if eval_fraction * 1000 == round(eval_fraction * 1000) else 1_000_000_000
        return df.withColumn("is_eval", F.pmod(md5num(key), F.lit(modulus)) < math.ceil(eval_fraction * modulus))
    if m == "SEQ":
        r = ranking.row_number(df, [], [F.col(seq_col), F.col(key)], "_seq")
        r = ranking.group_sizes(r, [], "_n")
        return r.withColumn("is_eval", F.col("_seq") > F.floor(F.col("_n") * (1 - eval_fraction))).drop("_seq", "_n")
    raise ValueError(method)


def three_way_split(df: DataFrame, key: str, eval_fraction: float = 0.15, test_fraction: float = 0.15) -> DataFrame:
    u = F.pmod(md5num(key), F.lit(1000))
    e, t = int(eval_fraction * 1000), int((eval_fraction + test_fraction) * 1000)
    return df.withColumn("split", F.when(u < e, "eval").when(u < t, "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str, key: str, eval_fraction: float = 0.2) -> DataFrame:
    """Per class, the first ``round(fraction * n_class)`` rows by key hash go to
    eval, so class shares are preserved (distributed row numbers per class)."""
    d = df.withColumn("_h", md5num(key))
    r = ranking.row_number(d, [label], [F.col("_h"), F.col(key)], "_rn")
    r = ranking.group_sizes(r, [label], "_n")
    return r.withColumn("is_eval", F.col("_rn") <= F.round(F.col("_n") * eval_fraction)).drop("_h", "_rn", "_n")


def auto_class_weights(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Inverse-frequency weights ``n / (k * n_class)`` (the class table is tiny)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    tot = counts.agg(F.sum("_nc").alias("_n"), F.count(F.lit(1)).alias("_k"))
    w = counts.crossJoin(tot).select(F.col(label).alias("_class"), (F.col("_n") / (F.col("_k") * F.col("_nc"))).alias(out))
    # a NULL class is a class; the engine broadcasts the class table if it is small
    return df.join(w, F.col(label).eqNullSafe(F.col("_class")), "left").drop("_class")


# ---------------------------------------------------------------- training -----

def train_classifier(train: DataFrame, kind: str = "gbt", label: str = "label", features: str = "features",
                     weight: str | None = None, seed: int = 42, **params):
    est = {
        "gbt": lambda: MC.GBTClassifier(labelCol=label, featuresCol=features, seed=seed, **params),
        "logreg": lambda: MC.LogisticRegression(labelCol=label, featuresCol=features, **params),
        "rf": lambda: MC.RandomForestClassifier(labelCol=label, featuresCol=features, seed=seed, **params),
        "mlp": lambda: MC.MultilayerPerceptronClassifier(labelCol=label, featuresCol=features, seed=seed, **params),
        "tree": lambda: MC.DecisionTreeClassifier(labelCol=label, featuresCol=features, seed=seed, **params),
    }[kind]()
    if weight and kind != "mlp":
        est.setWeightCol(weight)
    return est.fit(train)


def train_regressor(train: DataFrame, kind: str = "linreg", label: str = "label", features: str = "features",
                    seed: int = 42, **params):
    est = {
        "gbt": lambda: MR.GBTRegressor(labelCol=label, featuresCol=features, seed=seed, **params),
        "linreg": lambda: MR.LinearRegression(labelCol=label, featuresCol=features, **params),
        "rf": lambda: MR.RandomForestRegressor(labelCol=label, featuresCol=features, seed=seed, **params),
        "tree": lambda: MR.DecisionTreeRegressor(labelCol=label, featuresCol=features, seed=seed, **params),
    }[kind]()
    return est.fit(train)


def predict_scores(model, df: DataFrame, keep: list[str], positive_index: int = 1, out: str = "p") -> DataFrame:
    """Label + per-class probabilities; the positive-class probability extracted."""
    s = model.transform(df)
    probs = vector_to_array("probability")
    return s.select(*keep, F.col("prediction"), probs.alias("probs"), probs[positive_index].alias(out))


def model_weights(model, names: list[str]) -> DataFrame:
    """Coefficients of a linear model as rows — one row per feature plus the intercept."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    coef = model.coefficients.toArray().tolist()
    if len(names) != len(coef):
        raise ValueError(f"{len(names)} names for {len(coef)} weights")
    rows = [(n, float(w)) for n, w in zip(names, coef)] + [("__INTERCEPT__", float(model.intercept))]
    return spark.createDataFrame(rows, "processed_input string, weight double")


def training_info(model) -> DataFrame:
    """Loss per iteration (logistic: objective history; GBT: training log loss
    per tree count is produced by ``gbt_training_info``)."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    hist = list(model.summary.objectiveHistory)
    return spark.createDataFrame([(i, float(v)) for i, v in enumerate(hist)], "iteration int, loss double")


def gbt_training_info(model, train: DataFrame, evaluation: DataFrame | None = None) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    tr = model.evaluateEachIteration(train)
    ev = model.evaluateEachIteration(evaluation) if evaluation is not None else [None] * len(tr)
    rows = [(i + 1, float(a), None if b is None else float(b)) for i, (a, b) in enumerate(zip(tr, ev))]
    return spark.createDataFrame(rows, "iteration int, loss double, eval_loss double")


def feature_importance(model, names: list[str]) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    imp = model.featureImportances.toArray().tolist()
    return spark.createDataFrame([(n, float(v)) for n, v in zip(names, imp)], "feature string, importance_gain double")


# ---------------------------------------------------------------- evaluation ---

def score_groups(scores: DataFrame, p: str, y: Column) -> DataFrame:
    """Distinct scores with positive and negative counts (partial aggregate)."""
    return scores.groupBy(F.col(p).alias("s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))


def roc_auc(scores: DataFrame, p: str, y: Column) -> DataFrame:
    """Exact ROC AUC with ties averaged: sum over distinct scores of
    pos_s * (neg strictly below + neg_s / 2) / (P * N)."""
    g = score_groups(scores, p, y)
    g = ranking.prefix_sum(g, [], ["s"], "neg", "neg_below")
    return g.agg(((F.sum(F.col("pos") * (F.col("neg_below") + F.col("neg") / 2.0))) /
                  (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def evaluate_classifier(scores: DataFrame, p: str, y: Column, threshold: float = 0.5, digits: int | None = 6) -> DataFrame:
    """roc_auc, accuracy, precision, recall, f1 and log loss in one row."""
    yi = y.cast("int")
    pc = F.least(F.greatest(F.col(p), F.lit(EPS)), F.lit(1 - EPS))
    hit = F.col(p) >= threshold
    m = scores.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit & y).alias("tp"), F.count_if(hit & ~y).alias("fp"),
                   F.count_if(~hit & y).alias("fn"), F.count_if(~hit & ~y).alias("tn"),
                   (-F.avg(yi * F.log(pc) + (1 - yi) * F.log(1 - pc))).alias("log_loss"))
    m = m.crossJoin(roc_auc(scores, p, y))
    prec = safe_divide(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = safe_divide(F.col("tp"), F.col("tp") + F.col("fn"))
    out = m.select(F.lit(float(threshold)).alias("threshold"), prec.alias("precision"), rec.alias("recall"),
                   ((F.col("tp") + F.col("tn")) / F.col("n")).alias("accuracy"),
                   safe_divide(2 * prec * rec, prec + rec).alias("f1_score"), "log_loss", "roc_auc")
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) if c != "threshold" else F.col(c) for c in out.columns])
    return out


def evaluate_regressor(df: DataFrame, y: str, yhat: str, digits: int | None = 6) -> DataFrame:
    e = F.col(yhat) - F.col(y)
    m = df.agg(F.avg(F.abs(e)).alias("mean_absolute_error"), F.avg(e * e).alias("mean_squared_error"),
               F.var_pop(y).alias("_vy"))
    out = m.select("mean_absolute_error", "mean_squared_error", F.sqrt("mean_squared_error").alias("rmse"),
                   (1 - F.col("mean_squared_error") / F.col("_vy")).alias("r2_score"))
    if digits is not None:
        out = out.select(*[F.round(c, digits).alias(c) for c in out.columns])
    return out


def confusion_matrix(scores: DataFrame, p: str, actual: str, threshold: float = 0.5,
                     labels: tuple = ("No", "Yes")) -> DataFrame:
    """Rows = actual label, one column per predicted label."""
    pred = F.when(F.col(p) >= threshold, F.lit(labels[1])).otherwise(F.lit(labels[0]))
    return (scores.groupBy(F.col(actual).alias("expected_label"))
                  .agg(*[F.count_if(pred == F.lit(lab)).alias(lab) for lab in labels]))


def _grid_index(p: Column, steps: int) -> Column:
    """Largest k with k/steps <= p, computed exactly (floor then one correction
    step each way, using the same division the thresholds use)."""
    b0 = F.floor(p * steps)
    return (F.when((b0 + 1) / F.lit(float(steps)) <= p, b0 + 1)
             .when(b0 / F.lit(float(steps)) > p, b0 - 1).otherwise(b0)).cast("int")


def roc_curve(scores: DataFrame, p: str, y: Column, steps: int = 100, lo: float = 0.0, hi: float = 1.0) -> DataFrame:
    """tp, fp, fn, tn, recall, precision per threshold k/steps.

    Scores are reduced to counts per grid cell (a partial aggregate: at most
    steps+1 groups), then cumulative sums run over that tiny table."""
    spark = scores.sparkSession
    cells = (scores.select(F.least(F.greatest(_grid_index(F.col(p), steps), F.lit(-1)), F.lit(steps)).alias("k"),
                           y.alias("_y"))
                   .groupBy("k").agg(F.count_if("_y").alias("pos"), F.count_if(~F.col("_y")).alias("neg")))
    grid = spark.range(0, steps + 1).select(F.col("id").cast("int").alias("t"))
    # rows with cell >= t are predicted positive at threshold t/steps
    j = grid.crossJoin(F.broadcast(cells.where(F.col("k") >= 0)))  # (steps+1)^2 rows at most
    tot = cells.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    c = j.groupBy("t").agg(F.sum(F.when(F.col("k") >= F.col("t"), F.col("pos")).otherwise(0)).alias("tp"),
                           F.sum(F.when(F.col("k") >= F.col("t"), F.col("neg")).otherwise(0)).alias("fp"))
    c = c.crossJoin(tot)
    th = (F.col("t") / F.lit(float(steps)))
    out = c.select(F.round(th, 6).alias("threshold"), F.col("tp").cast("bigint").alias("true_positives"),
                   F.col("fp").cast("bigint").alias("false_positives"),
                   (F.col("P") - F.col("tp")).cast("bigint").alias("false_negatives"),
                   (F.col("N") - F.col("fp")).cast("bigint").alias("true_negatives"))
    out = out.withColumn("recall", F.round(safe_divide(F.col("true_positives"),
                                                       F.col("true_positives") + F.col("false_negatives")), 3))
    out = out.withColumn("precision", F.round(safe_divide(F.col("true_positives"),
                                                          F.col("true_positives") + F.col("false_positives")), 3))
    return out.where(F.col("threshold").between(lo, hi))


def pr_auc(scores: DataFrame, p: str, y: Column) -> DataFrame:
    """Average precision: sum over distinct scores (descending) of
    (pos_s / P) * precision at that score."""
    g = score_groups(scores, p, y).withColumn("_neg_s", -F.col("s"))
    g = ranking.prefix_sum(g, [], ["_neg_s"], F.col("pos") + F.col("neg"), "_cnt", inclusive=True)
    g = ranking.prefix_sum(g, [], ["_neg_s"], "pos", "_tp", inclusive=True)
    return g.agg((F.sum(F.col("pos") * (F.col("_tp") / F.col("_cnt"))) / F.sum("pos")).alias("pr_auc"))


def watchlist(scores: DataFrame, key: str, score: str, tiers: list[tuple[float, str]], actions: list[tuple[str, Column | None]],
              exposure: Column, carry: list[str] = ()) -> DataFrame:
    """Rows worth acting on: those that reach the lowest of the ``tiers`` (lowest score, name), each with its tier, the
    first of the ``actions`` (name, condition) whose condition holds (None always does), and ``exposure`` weighted by
    the score."""
    ladder = sorted(tiers, reverse=True)
    s = F.col(score)
    tier = F.coalesce(*[F.when(s >= low, F.lit(name)) for low, name in ladder])
    action = F.coalesce(*[F.lit(name) if rule is None else F.when(rule, F.lit(name)) for name, rule in actions])
    rows = scores.where(s >= ladder[-1][0])
    return rows.select(key, *carry, s.alias("score"), tier.alias("tier"), (s * exposure).alias("expected_loss"), action.alias("action"))


def traffic_split(df: DataFrame, key: str, pct_new: int, new: str = "v2", old: str = "v1",
                  out: str = "deployed_model_id") -> DataFrame:
    return df.withColumn(out, F.when(F.pmod(md5num(key), F.lit(100)) < pct_new, F.lit(new)).otherwise(F.lit(old)))


def continuous_eval(scores: DataFrame, period: Column, p: str, y: Column, threshold: float = 0.5,
                    min_precision: float = 0.85, min_auc: float | None = None) -> DataFrame:
    """Labelled evaluation per period; ``alert`` when precision (or AUC) is below the gate."""
    hit = F.col(p) >= threshold
    d = scores.withColumn("_period", period)
    m = d.groupBy("_period").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit & y).alias("tp"),
                                 F.count_if(hit).alias("predicted_pos"))
    m = m.withColumn("precision", safe_divide(F.col("tp"), F.col("predicted_pos")))
    alert = F.coalesce(F.col("precision") < min_precision, F.lit(False))
    if min_auc is not None:
        aucs = (d.groupBy("_period", F.col(p).alias("s")).agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg")))
        aucs = ranking.prefix_sum(aucs, ["_period"], ["s"], "neg", "nb").groupBy("_period").agg(
            (F.sum(F.col("pos") * (F.col("nb") + F.col("neg") / 2.0)) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))
        aucs = aucs.withColumnRenamed("_period", "_auc_period")  # a NULL period keeps its figures
        m = m.join(aucs, F.col("_period").eqNullSafe(F.col("_auc_period")), "left").drop("_auc_period")
        alert = alert | F.coalesce(F.col("roc_auc") < min_auc, F.lit(False))
    return m.withColumnRenamed("_period", "period").withColumn("alert", alert)
