"""Segmentation, dimensionality reduction, recommendation and anomaly flags.

Fits are Spark ML estimators; every evaluation (Davies-Bouldin, distances to
centroids, stability) is a distributed aggregate against a centroid table whose
size is k (a proven bound), broadcast to the rows."""

from __future__ import annotations

import math

from pyspark.ml import Pipeline
from pyspark.ml import clustering as MCL
from pyspark.ml import feature as MF
from pyspark.ml import recommendation as MREC
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.operators import blocks

#: Users and items of a block of factors, about.
USER_BLOCK, ITEM_BLOCK = 16_384, 262_144
#: Ratings of the users or of the items that a task of the fit holds, about; Spark's number of such blocks.
RATING_BLOCK, RATING_BLOCKS = 4_000_000, 10


def default_k(n_rows: int) -> int:
    return max(2, int(round(math.log10(max(n_rows, 10)))))


def kmeans_pipeline(features: list[str], k: int, init: str = "k-means||", distance: str = "euclidean",
                    standardize: bool = True, max_iter: int = 20, seed: int = 42) -> Pipeline:
    stages = [MF.VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="skip")]
    if standardize:
        stages.append(MF.StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True))
    else:
        stages.append(MF.SQLTransformer(statement="SELECT *, raw AS x FROM __THIS__"))
    stages.append(MCL.KMeans(featuresCol="x", predictionCol="centroid_id", k=k, initMode=init,
                             distanceMeasure=distance, maxIter=max_iter, seed=seed))
    return Pipeline(stages=stages)


def centroid_table(model, spark) -> DataFrame:
    """(centroid_id, center array) — k rows."""
    km = model.stages[-1]
    rows = [(i, [float(v) for v in c]) for i, c in enumerate(km.clusterCenters())]
    return spark.createDataFrame(rows, "centroid_id int, center array<double>")


def _dist(a, b):
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, v: s + v))


def kmeans_predict(model, df: DataFrame, key: str, n_nearest: int = 3) -> DataFrame:
    """Nearest centroid and the distances to the nearest few.  The k centres
    (k x dims values, held by the fitted model) are a literal array in the
    projection, so this is a map-only step: no join, no shuffle."""
    centers = model.stages[-1].clusterCenters()
    lit_centers = F.array(*[F.struct(F.lit(i).alias("centroid_id"),
                                     F.array(*[F.lit(float(v)) for v in c]).alias("center"))
                            for i, c in enumerate(centers)])
    x = model.transform(df).select(key, vector_to_array("x").alias("_x"))
    dists = F.transform(lit_centers, lambda c: F.struct(_dist(F.col("_x"), c["center"]).alias("distance"),
                                                        c["centroid_id"].alias("centroid_id")))
    near = x.select(key, F.slice(F.array_sort(dists), 1, n_nearest).alias("nearest"))
    return near.select(key, F.col("nearest")[0]["centroid_id"].alias("centroid_id"),
                       F.col("nearest")[0]["distance"].alias("distance"), "nearest")


def kmeans_evaluate(model, df: DataFrame) -> DataFrame:
    """Davies-Bouldin index and mean squared distance to the own centroid."""
    spark = df.sparkSession
    x = model.transform(df).select("centroid_id", vector_to_array("x").alias("_x"))
    c = centroid_table(model, spark)
    d = x.join(F.broadcast(c), "centroid_id").withColumn("d", _dist(F.col("_x"), F.col("center")))
    s = d.groupBy("centroid_id").agg(F.avg("d").alias("s"), F.avg(F.col("d") * F.col("d")).alias("msd"),
                                     F.count(F.lit(1)).alias("n"))
    # k rows: both measures below read them, the data is passed over once
    s = spark.createDataFrame(s.collect(), s.schema).join(c, "centroid_id")
    pairs = s.alias("a").crossJoin(s.alias("b")).where(F.col("a.centroid_id") != F.col("b.centroid_id"))  # k x k
    r = pairs.select(F.col("a.centroid_id").alias("i"),
                     ((F.col("a.s") + F.col("b.s")) / _dist(F.col("a.center"), F.col("b.center"))).alias("r"))
    db = r.groupBy("i").agg(F.max("r").alias("ri")).agg(F.avg("ri").alias("davies_bouldin_index"))
    msd = s.agg((F.sum(F.col("msd") * F.col("n")) / F.sum("n")).alias("mean_squared_distance"))
    return db.crossJoin(msd)


def centroids_long(model, features: list[str], raw: bool = True) -> DataFrame:
    """One row per (centroid, feature); ``raw`` undoes the standardization."""
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    km = model.stages[-1]
    sc = model.stages[1] if hasattr(model.stages[1], "mean") else None
    rows = []
    for i, center in enumerate(km.clusterCenters()):
        for j, f in enumerate(features):
            v = float(center[j])
            if raw and sc is not None:
                v = v * float(sc.std[j]) + float(sc.mean[j])
            rows.append((i, f, v))
    return spark.createDataFrame(rows, "centroid_id int, feature string, value double")


def rand_index(a: DataFrame, b: DataFrame, key: str, col_a: str = "centroid_id", col_b: str = "centroid_id") -> DataFrame:
    """Pair agreement of two clusterings from the contingency table counts
    (no pairs materialized): RI = (N + 2a - b - c) / N with pair counts."""
    j = a.select(key, F.col(col_a).alias("ca")).join(b.select(key, F.col(col_b).alias("cb")), key)
    pairs = lambda c: c * (c - 1) / 2
    nij = j.groupBy("ca", "cb").agg(F.count(F.lit(1)).alias("n"))
    s_ij = nij.agg(F.sum(pairs(F.col("n"))).alias("sa"))
    s_i = nij.groupBy("ca").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sb"))
    s_j = nij.groupBy("cb").agg(F.sum("n").alias("n")).agg(F.sum(pairs(F.col("n"))).alias("sc"))
    tot = nij.agg(F.sum("n").alias("nn"))
    r = s_ij.crossJoin(s_i).crossJoin(s_j).crossJoin(tot)
    npairs = pairs(F.col("nn"))
    return r.select(((npairs + 2 * F.col("sa") - F.col("sb") - F.col("sc")) / npairs).alias("rand_index"))


def pca_pipeline(features: list[str], k: int) -> Pipeline:
    return Pipeline(stages=[MF.VectorAssembler(inputCols=features, outputCol="raw", handleInvalid="skip"),
                            MF.StandardScaler(inputCol="raw", outputCol="x", withMean=True, withStd=True),
                            MF.PCA(inputCol="x", outputCol="pcs", k=k)])


def pca_info(model) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    ev = [float(v) for v in model.stages[-1].explainedVariance]
    rows, cum = [], 0.0
    for i, v in enumerate(ev):
        cum += v
        rows.append((i + 1, v, cum))
    return spark.createDataFrame(rows, "principal_component_id int, explained_variance_ratio double, "
                                       "cumulative_explained_variance_ratio double")


def choose_pca_k(info: DataFrame, ratio: float = 0.9) -> int:
    """Smallest k whose cumulative explained variance reaches ``ratio`` (the
    info table has one row per component)."""
    r = info.where(F.col("cumulative_explained_variance_ratio") >= ratio).agg(F.min("principal_component_id")).first()[0]
    return int(r) if r is not None else int(info.count())


def pca_loadings(model, features: list[str]) -> DataFrame:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession()
    pc = model.stages[-1].pc.toArray()
    rows = [(j + 1, f, float(pc[i, j])) for j in range(pc.shape[1]) for i, f in enumerate(features)]
    return spark.createDataFrame(rows, "principal_component_id int, feature string, loading double")


def pca_reconstruction_error(model, df: DataFrame, key: str) -> DataFrame:
    """Mean squared error between the standardized row and its projection back
    from the principal components (the PC matrix, dims x k, is a literal: the
    step is map-only)."""
    pc = model.stages[-1].pc.toArray()
    d, k = pc.shape
    x = vector_to_array("x")
    z = vector_to_array("pcs")
    rows = [F.array(*[F.lit(float(pc[i, j])) for j in range(k)]) for i in range(d)]
    recon = F.transform(F.array(*rows), lambda r: F.aggregate(F.zip_with(r, F.col("_z"), lambda a, b: a * b),
                                                                 F.lit(0.0), lambda s, v: s + v))
    t = model.transform(df).select(key, x.alias("_x"), z.alias("_z"))
    err = F.aggregate(F.zip_with(F.col("_x"), recon, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, v: s + v) / d
    return t.select(key, err.alias("reconstruction_mse"))


def als_fit(ratings: DataFrame, user: str, item: str, rating: str, implicit: bool = True, alpha: float = 40.0,
            rank: int = 10, reg: float = 0.1, max_iter: int = 10, seed: int = 42):
    """A task holds the ratings of a block of users (or items) and the factors they meet, so there are more blocks for more
    ratings.  Beyond one block's worth every iteration is checkpointed, which lets its shuffle files go.  ``ratings`` are
    read twice."""
    n = ratings.count()
    parts = max(RATING_BLOCKS, -(-n // RATING_BLOCK))
    als = MREC.ALS(userCol=user, itemCol=item, ratingCol=rating, implicitPrefs=implicit, alpha=alpha, rank=rank,
                   regParam=reg, maxIter=max_iter, seed=seed, coldStartStrategy="nan", numUserBlocks=parts,
                   numItemBlocks=parts, checkpointInterval=10 if n <= RATING_BLOCK else 1)
    return als.fit(ratings)


def als_recommend(model, users: DataFrame, user: str, k: int = 5) -> DataFrame:
    """The ``k`` items of the largest predicted rating per user the model knows (ties: the smaller item).  Every user is
    compared with every item that can be among them, in blocks of factors by matrix products."""
    known = model.userFactors.join(users.select(F.col(user).alias("id")), "id", "left_semi")
    best = blocks.top_products(known, model.itemFactors, k, USER_BLOCK, ITEM_BLOCK)
    return best.select(F.col("id").cast("int").alias(user), "rank", F.col("other").cast("int").alias(model.getItemCol()),
                       F.col("score").alias("rating"))


def als_predict_cold_start(model, pairs: DataFrame, ratings: DataFrame, user: str, item: str, rating: str) -> DataFrame:
    """Predictions where an unseen user or item falls back to the global mean
    plus the known side's bias (mean deviation of that user/item)."""
    g = ratings.agg(F.avg(rating).alias("_mu"))
    ub = ratings.groupBy(user).agg(F.avg(rating).alias("_u"))
    ib = ratings.groupBy(item).agg(F.avg(rating).alias("_i"))
    p = model.transform(pairs).crossJoin(F.broadcast(g)).join(ub, user, "left").join(ib, item, "left")
    fallback = F.col("_mu") + F.coalesce(F.col("_u") - F.col("_mu"), F.lit(0.0)) + \
        F.coalesce(F.col("_i") - F.col("_mu"), F.lit(0.0))
    pred = F.when(F.isnan("prediction") | F.col("prediction").isNull(), fallback).otherwise(F.col("prediction"))
    return p.select(*pairs.columns, pred.alias("prediction"),
                    (F.isnan("prediction") | F.col("prediction").isNull()).alias("cold_start"))


def anomaly_threshold(train_metric: DataFrame, metric: str, contamination: float) -> DataFrame:
    """Cut = the (1 - contamination) quantile of the metric on the TRAINING set."""
    if not 0 <= contamination <= 0.5:
        raise ValueError("contamination must be in [0, 0.5]")
    return train_metric.agg(F.percentile_approx(metric, 1 - contamination, 10_000).alias("cut"))


def detect_anomalies(scored: DataFrame, metric: str, cut: DataFrame) -> DataFrame:
    return scored.crossJoin(F.broadcast(cut)).withColumn("is_anomaly", F.col(metric) > F.col("cut"))
