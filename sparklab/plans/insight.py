"""Explainability, fairness and unsupervised queries."""

from __future__ import annotations

import json
import uuid

from pyspark.ml import Pipeline
from pyspark.ml.stat import Summarizer
from pyspark.sql import functions as F

from sparklab.operators import explain as xp
from sparklab.operators import ml, quality, ranking, trees
from sparklab.operators import unsup as us
from sparklab.plans.fixtures import SCORES_SQL, churn_scores, with_sql
from sparklab.plans.modeling import CATEG, NUMERIC, customer_features, fit_pipeline, kept_features, source_version, training_frame
from sparklab.plans.registry import query
from sparklab.session import ensure_checkpoint_dir
from sparklab.sources.tables import Tables


def _y():
    return F.col("actual_churn") == "Yes"


def sliced_scores(t):
    s = churn_scores(t)
    n = t.nation.select("n_nationkey", "n_regionkey")
    r = t.region.select("r_regionkey", "r_name")
    # nation / region are fixed 25 / 5 row dimension tables: a proven size bound
    j = s.join(F.broadcast(n), s["c_nationkey"] == n["n_nationkey"])
    return j.join(F.broadcast(r), j["n_regionkey"] == r["r_regionkey"])


SLICED_SQL = SCORES_SQL + """,
s AS (SELECT sc.*, r.r_name FROM scores sc JOIN nation n ON n.n_nationkey = sc.c_nationkey
      JOIN region r ON r.r_regionkey = n.n_regionkey)"""


@query("sliced_metrics", sql=with_sql(SLICED_SQL, """
SELECT r_name, CAST(count(*) AS BIGINT) AS n,
       (count_if(p_churn >= 0.5 AND actual_churn = 'Yes') + count_if(p_churn < 0.5 AND actual_churn <> 'Yes')) / count(*) AS accuracy,
       count_if(p_churn >= 0.5 AND actual_churn = 'Yes') / nullif(count_if(p_churn >= 0.5), 0) AS precision,
       count_if(p_churn >= 0.5 AND actual_churn = 'Yes') / nullif(count_if(actual_churn = 'Yes'), 0) AS recall
FROM s GROUP BY r_name"""))
def q_sliced_metrics(spark, sf):
    return xp.sliced_metrics(sliced_scores(Tables(spark, sf)), "r_name", "p_churn", _y(), 0.5)


@query("data_bias", sql=with_sql(SLICED_SQL, """,
g AS (SELECT r_name, count(*) AS n, count_if(actual_churn = 'Yes') AS pos FROM s GROUP BY r_name),
t AS (SELECT sum(n) AS tn, sum(pos) AS tp FROM g)
SELECT r_name, CAST(n AS BIGINT) AS n, n / tn AS share, pos / n AS positive_rate,
       pos / n - (tp - pos) / nullif(tn - n, 0) AS label_rate_difference FROM g, t"""))
def q_data_bias(spark, sf):
    return xp.data_bias(sliced_scores(Tables(spark, sf)), "r_name", _y())


@query("model_bias", sql=with_sql(SLICED_SQL, """,
g AS (SELECT r_name, count(*) AS n, count_if(p_churn >= 0.5) AS pp,
             count_if((p_churn >= 0.5) = (actual_churn = 'Yes')) AS ok,
             count_if(p_churn >= 0.5 AND actual_churn <> 'Yes') AS fp, count_if(actual_churn <> 'Yes') AS neg,
             count_if(p_churn < 0.5 AND actual_churn = 'Yes') AS fn, count_if(actual_churn = 'Yes') AS pos FROM s GROUP BY r_name),
t AS (SELECT sum(n) AS n, sum(pp) AS pp, sum(ok) AS ok, sum(fp) AS fp, sum(neg) AS neg, sum(fn) AS fn, sum(pos) AS pos FROM g)
SELECT g.r_name, CAST(g.n AS BIGINT) AS n,
       g.pp / g.n - (t.pp - g.pp) / nullif(t.n - g.n, 0) AS dpppl,
       g.ok / g.n - (t.ok - g.ok) / nullif(t.n - g.n, 0) AS accuracy_difference,
       g.fp / nullif(g.neg, 0) - (t.fp - g.fp) / nullif(t.neg - g.neg, 0) AS fpr_gap,
       g.fn / nullif(g.pos, 0) - (t.fn - g.fn) / nullif(t.pos - g.pos, 0) AS fnr_gap,
       abs(g.pp / g.n - (t.pp - g.pp) / nullif(t.n - g.n, 0)) <= 0.1 AS passed
FROM g, t"""))
def q_model_bias(spark, sf):
    return xp.model_bias(sliced_scores(Tables(spark, sf)), "r_name", "p_churn", _y(), 0.5, 0.1)


@query("per_slice_thresholds", sql=with_sql(SLICED_SQL, """,
g AS (SELECT generate_series AS t FROM generate_series(0, 100)),
c AS (SELECT s.r_name, g.t, g.t / 100.0 AS threshold, count_if(p_churn >= g.t / 100.0) AS pp, count(*) AS n,
             count_if(p_churn >= g.t / 100.0 AND actual_churn = 'Yes') AS tp,
             count_if(p_churn < g.t / 100.0 AND actual_churn <> 'Yes') AS tn FROM s, g GROUP BY 1, 2, 3),
tg AS (SELECT count_if(p_churn >= 0.5) / count(*) AS target FROM s),
x AS (SELECT c.*, pp / n AS metric, tg.target, abs(pp / n - tg.target) AS gap FROM c, tg),
b AS (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY gap, abs(threshold - 0.5), threshold) AS rk FROM x)
SELECT r_name, round(threshold, 6) AS threshold, metric, target, (tp + tn) / n AS accuracy FROM b WHERE rk = 1"""))
def q_per_slice_thresholds(spark, sf):
    return xp.per_slice_thresholds(sliced_scores(Tables(spark, sf)), "r_name", "p_churn", _y(), "demographic_parity")


@query("per_slice_thresholds_opportunity", sql=with_sql(SLICED_SQL, """,
g AS (SELECT generate_series AS t FROM generate_series(0, 100)),
c AS (SELECT s.r_name, g.t, g.t / 100.0 AS threshold, count(*) AS n, count_if(actual_churn = 'Yes') AS npos,
             count_if(p_churn >= g.t / 100.0 AND actual_churn = 'Yes') AS tp,
             count_if(p_churn < g.t / 100.0 AND actual_churn <> 'Yes') AS tn FROM s, g GROUP BY 1, 2, 3),
tg AS (SELECT count_if(p_churn >= 0.5 AND actual_churn = 'Yes') / nullif(count_if(actual_churn = 'Yes'), 0) AS target FROM s),
x AS (SELECT c.*, tp / nullif(npos, 0) AS metric, tg.target, abs(tp / nullif(npos, 0) - tg.target) AS gap FROM c, tg),
b AS (SELECT *, row_number() OVER (PARTITION BY r_name ORDER BY gap, abs(threshold - 0.5), threshold) AS rk FROM x)
SELECT r_name, round(threshold, 6) AS threshold, metric, target, (tp + tn) / n AS accuracy FROM b WHERE rk = 1"""))
def q_per_slice_thresholds_opportunity(spark, sf):
    return xp.per_slice_thresholds(sliced_scores(Tables(spark, sf)), "r_name", "p_churn", _y(), "equal_opportunity")


IMP_FEATURES = ["tenure_months", "monthly_charges", "n_orders", "c_nationkey"]


def _imp_sql():
    parts = []
    for f in IMP_FEATURES:
        parts.append(f"""SELECT '{f}' AS feature,
  round(abs(corr({f}, CASE WHEN actual_churn = 'Yes' THEN 1.0 ELSE 0.0 END)), 6) AS a,
  round(abs((avg(CASE WHEN actual_churn = 'Yes' THEN {f} END) - avg(CASE WHEN actual_churn <> 'Yes' THEN {f} END))
            / stddev_samp({f})), 6) AS b FROM scores""")
    return " UNION ALL ".join(parts)


@query("importance_rank_compare", sql=with_sql(SCORES_SQL, f""",
imp AS ({_imp_sql()}),
ra AS (SELECT feature, CAST(rank() OVER (ORDER BY a DESC) AS INTEGER) AS corr_rank FROM imp),
rb AS (SELECT feature, CAST(rank() OVER (ORDER BY b DESC) AS INTEGER) AS effect_rank FROM imp)
SELECT coalesce(ra.feature, rb.feature) AS feature, corr_rank, effect_rank, corr_rank - effect_rank AS rank_gap
FROM ra FULL OUTER JOIN rb ON ra.feature = rb.feature"""))
def q_importance_rank_compare(spark, sf):
    """Two importance lists (|correlation with the label| and standardized mean
    difference between classes), ranked and compared by rank gap."""
    from sparklab.operators.joins import full_outer_rank_compare, rank_by
    s = churn_scores(Tables(spark, sf))
    y = _y()
    aggs = []
    for f in IMP_FEATURES:
        aggs += [F.round(F.abs(F.corr(F.col(f).cast("double"), y.cast("double"))), 6).alias(f"{f}__a"),
                 F.round(F.abs((F.avg(F.when(y, F.col(f))) - F.avg(F.when(~y, F.col(f)))) / F.stddev_samp(f)), 6)
                 .alias(f"{f}__b")]
    wide = s.agg(*aggs)
    stack = ", ".join(f"'{f}', `{f}__a`, `{f}__b`" for f in IMP_FEATURES)
    imp = wide.selectExpr(f"stack({len(IMP_FEATURES)}, {stack}) as (feature, a, b)")
    return full_outer_rank_compare(rank_by(imp, "feature", "a", "corr_rank"), rank_by(imp, "feature", "b", "effect_rank"),
                                   "feature", "corr_rank", "effect_rank")


# ------------------------------------------------------------------ model explanations ---

def _feature_frame(m, data):
    """Rows with the model's input vector (all stages but the estimator)."""
    from pyspark.ml import PipelineModel
    return PipelineModel(stages=m.stages[:-1]).transform(data)


def _slot_names(m, data):
    fx = _feature_frame(m, data.limit(1))
    attrs = fx.schema["features_raw"].metadata.get("ml_attr", {}).get("attrs", {})
    names = {}
    for group in attrs.values():
        for a in group:
            names[a["idx"]] = a["name"]
    n = len(names)
    return [names.get(i, f"f{i}") for i in range(n)]


@query("feature_importance")
def q_feature_importance(spark, sf):
    """Splits on each feature, with their mean gain and mean training rows, from the saved nodes."""
    m, data = fit_pipeline(Tables(spark, sf), "gbt")
    return trees.importance(m.stages[-1], _slot_names(m, data))


@query("tree_shapley")
def q_tree_shapley(spark, sf):
    """Exact attributions of the boosted trees' raw score for every customer."""
    m, data = fit_pipeline(Tables(spark, sf), "gbt")
    return trees.shapley(m.stages[-1], _feature_frame(m, data), "c_custkey", "features", _slot_names(m, data))


@query("explain_predict")
def q_explain_predict(spark, sf):
    """Top-3 signed attributions per row of the logistic model (exact: weights x
    standardized inputs, baseline = training mean)."""
    m, data = fit_pipeline(Tables(spark, sf), "logreg")
    fx = _feature_frame(m, data)
    lr = m.stages[-1]
    return xp.linear_attributions(fx, "c_custkey", "features", lr.coefficients.toArray().tolist(),
                                  _slot_names(m, data), top_k=3)


@query("global_explain")
def q_global_explain(spark, sf):
    m, data = fit_pipeline(Tables(spark, sf), "logreg")
    fx = _feature_frame(m, data)
    attr = xp.linear_attributions(fx, "c_custkey", "features", m.stages[-1].coefficients.toArray().tolist(),
                                  _slot_names(m, data))
    return xp.global_explain(attr)


@query("sampled_shapley")
def q_sampled_shapley(spark, sf):
    m, data = fit_pipeline(Tables(spark, sf), "gbt")
    fx = _feature_frame(m, data).select("c_custkey", "features")
    mean = _feature_frame(m, data).where(~F.col("is_eval")).agg(Summarizer.mean(F.col("features")).alias("m")).first()["m"]
    return xp.sampled_shapley(m.stages[-1], fx, "c_custkey", "features", _slot_names(m, data), path_count=8, baseline=mean.toArray().tolist())


@query("approximation_error")
def q_approximation_error(spark, sf):
    from pyspark.ml.functions import vector_to_array
    m, data = fit_pipeline(Tables(spark, sf), "gbt")
    fx = _feature_frame(m, data).select("c_custkey", "features")
    names = _slot_names(m, data)
    attr = xp.sampled_shapley(m.stages[-1], fx, "c_custkey", "features", names, path_count=4)
    fxs = m.stages[-1].transform(fx).select("c_custkey", vector_to_array("probability")[1].alias("_f"))
    from pyspark.ml.linalg import Vectors
    base = spark.createDataFrame([(Vectors.dense([0.0] * len(names)),)], ["features"])
    fbase = float(m.stages[-1].transform(base).select(vector_to_array("probability")[1]).first()[0])
    return xp.approximation_error(attr, "c_custkey", fxs, fbase)


@query("permutation_importance")
def q_permutation_importance(spark, sf):
    m, data = fit_pipeline(Tables(spark, sf), "logreg")
    ev = data.where(F.col("is_eval"))

    def auc(df):
        s = ml.predict_scores(m, df, ["c_custkey", "label"], out="p")
        return ml.roc_auc(s, "p", F.col("label") == 1.0)
    base = auc(ev).select(F.col("roc_auc").alias("base_auc"))
    out = None
    for f in ["tenure_months", "monthly_charges", "n_orders", "orders_90d", "days_since_order"]:
        r = auc(xp.permute_column(ev, "c_custkey", f)).select(F.lit(f).alias("feature"), F.col("roc_auc").alias("auc"))
        out = r if out is None else out.unionByName(r)
    return out.crossJoin(base).withColumn("importance", F.col("base_auc") - F.col("auc"))


@query("partial_dependence")
def q_partial_dependence(spark, sf):
    from pyspark.ml.functions import vector_to_array
    m, data = fit_pipeline(Tables(spark, sf), "logreg")
    grid = spark.range(0, 61, 6).select(F.col("id").cast("int").alias("tenure_months"))
    return xp.partial_dependence(m, data.drop("tenure_months").withColumn("tenure_months", F.lit(0)), "tenure_months",
                                 grid, vector_to_array("probability")[1])


@query("surrogate_model")
def q_surrogate_model(spark, sf):
    from pyspark.ml.classification import DecisionTreeClassifier
    m, data = fit_pipeline(Tables(spark, sf), "gbt")
    fx = _feature_frame(m, data)
    teacher = m.stages[-1].transform(fx).select("c_custkey", "features", F.col("prediction").alias("teacher"))
    tree = DecisionTreeClassifier(labelCol="teacher", featuresCol="features", maxDepth=3, seed=7).fit(teacher)
    s = tree.transform(teacher)
    return s.agg(F.avg((F.col("prediction") == F.col("teacher")).cast("double")).alias("fidelity"),
                 F.lit(tree.depth).alias("depth"), F.lit(tree.numNodes).alias("nodes"))


@query("leakage_probe")
def q_leakage_probe(spark, sf):
    """Add a leaked column (a reason code present only for churners), refit:
    AUC jumps and one feature dominates the attributions."""
    from pyspark.ml.classification import LogisticRegression
    from sparklab.operators import transforms as tf
    t = Tables(spark, sf)
    data = training_frame(t).withColumn("has_reason", (F.col("actual_churn") == "Yes").cast("double"))
    out = None
    for name, cols in (("honest", NUMERIC), ("leaky", NUMERIC + ["has_reason"])):
        mdl = tf.bound_pipeline(cols, CATEG, LogisticRegression(labelCol="label", maxIter=50)).fit(
            data.where(~F.col("is_eval")))
        s = ml.predict_scores(mdl, data.where(F.col("is_eval")), ["c_custkey", "label"], out="p")
        w = [abs(v) for v in mdl.stages[-1].coefficients.toArray().tolist()]
        share = max(w) / sum(w) if sum(w) else 0.0
        r = ml.roc_auc(s, "p", F.col("label") == 1.0).select(F.lit(name).alias("model"), "roc_auc",
                                                              F.lit(share).alias("top_weight_share"))
        out = r if out is None else out.unionByName(r)
    return out


@query("attribution_drift")
def q_attribution_drift(spark, sf):
    """Mean |attribution| shares of early vs late customers (by first order),
    compared with L-infinity."""
    m, data = fit_pipeline(Tables(spark, sf), "logreg")
    fx = _feature_frame(m, data)
    attr = xp.linear_attributions(fx, "c_custkey", "features", m.stages[-1].coefficients.toArray().tolist(),
                                  _slot_names(m, data))
    win = data.select("c_custkey", (F.col("tenure_months") > 36).alias("early"))
    a = attr.join(win, "c_custkey").groupBy("early", "feature").agg(F.avg(F.abs("attribution")).alias("m"))
    tot = a.groupBy("early").agg(F.sum("m").alias("t"))
    sh = a.join(tot, "early").withColumn("share", F.col("m") / F.col("t"))
    p = sh.where(F.col("early")).select("feature", F.col("share").alias("p"))
    q = sh.where(~F.col("early")).select("feature", F.col("share").alias("q"))
    j = p.join(q, "feature", "full_outer")
    return j.agg(F.max(F.abs(F.coalesce("p", F.lit(0.0)) - F.coalesce("q", F.lit(0.0)))).alias("linf"))


@query("feature_info")
def q_feature_info(spark, sf):
    """Per input column of the trained model: min, max, mean, stddev, cardinality, nulls
    (the statistics stored beside the model at fit time)."""
    data = training_frame(Tables(spark, sf)).where(~F.col("is_eval"))
    d = quality.describe_data(data.select(*NUMERIC, *CATEG), num_quantiles=2, top_k=0)
    return d.select("column_name", "min", "max", "mean", "stddev", "num_unique", "num_nulls")


@query("batch_input_skew_report")
def q_batch_input_skew_report(spark, sf):
    """One-off report for a scoring job: serving rows vs training statistics (0.3 default)."""
    t = Tables(spark, sf)
    train = training_frame(t).where(~F.col("is_eval"))
    serving = customer_features(t, cutoff="2001-08-01")
    stats = quality.fit_statistics(train, NUMERIC, CATEG)
    rep = quality.validate_skew(stats, serving, NUMERIC, CATEG)
    return rep.agg(F.to_json(F.collect_list(F.struct("input", "metric", "threshold", "value", "is_anomaly")))
                   .alias("report"), F.count_if("is_anomaly").alias("anomalies"))


@query("generate_dq_rules")
def q_generate_dq_rules(spark, sf):
    prof = quality.describe_data(Tables(spark, sf).customer, num_quantiles=2, top_k=10, exact_unique=True)
    rules = quality.generate_dq_rules(prof)
    return spark.createDataFrame([(r["name"], r["type"], json.dumps(r, default=str)) for r in rules],
                                 "name string, type string, rule string")


@query("table_assertions")
def q_table_assertions(spark, sf):
    f = customer_features(Tables(spark, sf))
    return quality.table_assertions(f, non_null=["c_custkey", "total_spend"],
                                    row_conditions=["n_orders >= orders_365d", "spend_per_order > 0"],
                                    unique_key=["c_custkey"])


# ------------------------------------------------------------------ unsupervised ----------

SEG_FEATURES = ["tenure_months", "monthly_charges", "n_orders", "total_spend", "orders_365d"]


_SEGMENTS: dict = {}


def _segments(spark, sf, k=4, seed=42, init="k-means||"):
    key = (spark.sparkContext.applicationId, source_version(Tables(spark, sf), "customer", "orders"), k, seed, init)
    if key not in _SEGMENTS:
        f = kept_features(Tables(spark, sf))
        _SEGMENTS[key] = (us.kmeans_pipeline(SEG_FEATURES, k, init=init, seed=seed, max_iter=20).fit(f), f)
    return _SEGMENTS[key]


@query("kmeans_segments")
def q_kmeans_segments(spark, sf):
    m, f = _segments(spark, sf)
    return m.transform(f).groupBy("centroid_id").agg(F.count(F.lit(1)).alias("customers"),
                                                     F.avg("monthly_charges").alias("avg_charges"))


@query("kmeans_predict")
def q_kmeans_predict(spark, sf):
    m, f = _segments(spark, sf)
    return us.kmeans_predict(m, f, "c_custkey", 3)


@query("kmeans_evaluate")
def q_kmeans_evaluate(spark, sf):
    m, f = _segments(spark, sf)
    return us.kmeans_evaluate(m, f)


@query("kmeans_choose_k")
def q_kmeans_choose_k(spark, sf):
    f = kept_features(Tables(spark, sf))
    out = None
    for k in range(2, 11):
        m = us.kmeans_pipeline(SEG_FEATURES, k, max_iter=10).fit(f)
        r = us.kmeans_evaluate(m, f).select(F.lit(k).alias("k"), "davies_bouldin_index")
        out = r if out is None else out.unionByName(r)
    best = out.agg(F.min("davies_bouldin_index").alias("_b"))
    return out.crossJoin(best).withColumn("is_best", F.col("davies_bouldin_index") == F.col("_b")).drop("_b")


@query("centroids")
def q_centroids(spark, sf):
    m, _ = _segments(spark, sf)
    return us.centroids_long(m, SEG_FEATURES, raw=True)


@query("cluster_health")
def q_cluster_health(spark, sf):
    m1, f = _segments(spark, sf, seed=1)
    m2, _ = _segments(spark, sf, seed=2)
    a = m1.transform(f).select("c_custkey", "centroid_id")
    b = m2.transform(f).select("c_custkey", "centroid_id")
    sizes = a.groupBy("centroid_id").count().agg(F.min("count").alias("min_size"), F.max("count").alias("max_size"))
    return us.rand_index(a, b, "c_custkey").crossJoin(sizes)


def _components_of(e):
    """The embeddings as one column per dimension, and the columns' names; all dimensions of the data."""
    width = e.agg(F.max(F.size("embedding"))).first()[0]
    names = [f"e{i}" for i in range(width)]
    return e.select("vec_id", *[F.col("embedding")[i].alias(c) for i, c in enumerate(names)]), names


@query("pca_fit")
def q_pca_fit(spark, sf):
    e = Tables(spark, sf).embeddings
    x, names = _components_of(e)
    full = us.pca_pipeline(names, len(names)).fit(x)
    k = us.choose_pca_k(us.pca_info(full), 0.9)
    m = us.pca_pipeline(names, k).fit(x)
    from pyspark.ml.functions import vector_to_array
    return m.transform(x).select("vec_id", vector_to_array("pcs").alias("components"))


@query("pca_info")
def q_pca_info(spark, sf):
    e = Tables(spark, sf).embeddings
    x, names = _components_of(e)
    return us.pca_info(us.pca_pipeline(names, len(names)).fit(x))


@query("pca_loadings")
def q_pca_loadings(spark, sf):
    e = Tables(spark, sf).embeddings
    x, names = _components_of(e)
    return us.pca_loadings(us.pca_pipeline(names, 4).fit(x), names)


def _ratings(t):
    j = t.orders.select("o_orderkey", "o_custkey").join(t.lineitem.select("l_orderkey", "l_partkey", "l_quantity"),
                                                          F.col("o_orderkey") == F.col("l_orderkey"))
    return j.groupBy(F.col("o_custkey").cast("int").alias("user_id"), F.col("l_partkey").cast("int").alias("item_id")).agg(
        F.sum("l_quantity").alias("rating"))


def _kept_ratings(t, spark):
    """Written once: fit (twice), means and pairs each read them."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/ratings-{uuid.uuid4().hex}"
    _ratings(t).write.parquet(path)
    return spark.read.parquet(path)


@query("als_recommend")
def q_als_recommend(spark, sf):
    t = Tables(spark, sf)
    r = _kept_ratings(t, spark)
    m = us.als_fit(r, "user_id", "item_id", "rating", implicit=True, alpha=40.0)
    users = t.customer.select(F.col("c_custkey").cast("int").alias("user_id"))
    return us.als_recommend(m, users, "user_id", 5)


@query("als_cold_start")
def q_als_cold_start(spark, sf):
    """Pairs with customers and parts never seen in training get the global mean
    plus the known side's bias."""
    t = Tables(spark, sf)
    r = _kept_ratings(t, spark)
    train = r.where(F.col("user_id") % 10 != 0)
    m = us.als_fit(train, "user_id", "item_id", "rating", implicit=False)
    pairs = r.where(F.col("user_id") % 10 == 0).select("user_id", "item_id")
    return us.als_predict_cold_start(m, pairs, train, "user_id", "item_id", "rating")


@query("detect_anomalies")
def q_detect_anomalies(spark, sf):
    """Distance to the nearest centroid; cut at the (1 - contamination)
    quantile of the training distances."""
    m, f = _segments(spark, sf)
    d = us.kmeans_predict(m, f, "c_custkey", 1)
    cut = us.anomaly_threshold(d, "distance", 0.02)
    return us.detect_anomalies(d.drop("nearest"), "distance", cut)
