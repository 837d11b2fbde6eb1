"""Tree ensembles read back from their saved nodes: split statistics and exact Shapley values.

``nodes`` gives the nodes of a saved ensemble as a DataFrame; ``importance`` aggregates them; ``shapley`` computes the
exact attributions that follow the tree paths: a feature outside a coalition is averaged out by the share of training
rows on either side of its splits.  For one leaf whose path asks d different features, with o[j] = 1 if the row meets all
conditions on feature j (else 0) and z[j] the product of the shares of training rows along the splits on j, a feature i
of the path gets

    value * (o[i] - z[i]) * sum over k of k! (d - k - 1)! / d! * (coefficient of t^k in the product of z[j] + o[j] t, j != i)

The value depends on a row only through the pattern of the o, so a task works out each pattern that occurs once per leaf
and batch, and adds it to all rows with it: no shuffle, no expansion of the rows, work in proportion to rows x leaves.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.session import ensure_checkpoint_dir


def nodes(model) -> DataFrame:
    """tree, id, left, right (-1 in leaves), feature, threshold or categories (of the left side), n_categories (-1:
    continuous), prediction, gain and cover (training rows) of a fitted Spark tree ensemble or tree."""
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trees-{uuid.uuid4().hex}"
    model.write().save(folder)
    n = spark.read.parquet(f"{folder}/data")
    n = n.select("treeID", "nodeData.*") if "nodeData" in n.columns else n if "treeID" in n.columns else n.withColumn("treeID", F.lit(0))
    split = F.col("split")
    return n.select(F.col("treeID").alias("tree"), "id", F.col("leftChild").alias("left"), F.col("rightChild").alias("right"), split["featureIndex"].alias("feature"), split["leftCategoriesOrThreshold"].alias("at"), split["numCategories"].alias("n_categories"), "prediction", "gain", F.col("rawCount").cast("double").alias("cover"))


def importance(model, names: list[str]) -> DataFrame:
    """Per feature: importance_weight (splits on it), importance_gain and importance_cover (mean gain and mean training
    rows of those splits); features without a split have 0."""
    own = nodes(model).where("left >= 0").groupBy("feature").agg(F.count(F.lit(1)).alias("w"), F.avg("gain").alias("g"), F.avg("cover").alias("c"))
    spark = own.sparkSession
    every = spark.createDataFrame(list(enumerate(names)), "feature int, name string")  # a row per input
    j = every.join(own, "feature", "left")
    return j.select(F.col("name").alias("feature"), F.coalesce("w", F.lit(0)).alias("importance_weight"), F.coalesce("g", F.lit(0.0)).alias("importance_gain"), F.coalesce("c", F.lit(0.0)).alias("importance_cover"))


@dataclass
class Leaf:
    """A leaf: its value (times the tree's weight), the features of its path, the conditions on each, and their shares."""

    value: float
    features: list[int]
    #: per feature: (threshold or categories, continuous, whether the left side is taken)
    conditions: list[list[tuple]]
    shares: np.ndarray


def leaves(rows: list, weights: list[float]) -> list[Leaf]:
    """The leaves of all trees from their node rows."""
    trees: dict[int, dict] = {}
    for r in rows:
        trees.setdefault(r["tree"], {})[r["id"]] = r
    out: list[Leaf] = []

    def walk(tree: dict, i: int, weight: float, path: dict) -> None:
        r = tree[i]
        if r["left"] < 0:
            features = sorted(path)
            out.append(Leaf(weight * r["prediction"], features, [path[f][0] for f in features], np.array([path[f][1] for f in features], float)))
            return
        f = r["feature"]
        for child, left in ((r["left"], True), (r["right"], False)):
            tests, share = path.get(f, ([], 1.0))
            test = (r["at"][0], True, left) if r["n_categories"] < 0 else (tuple(r["at"]), False, left)
            walk(tree, child, weight, path | {f: (tests + [test], share * tree[child]["cover"] / r["cover"])})

    for k, tree in sorted(trees.items()):
        walk(tree, 0, weights[k], {})
    return out


def met(leaf: Leaf, x: np.ndarray) -> np.ndarray:
    """Whether the rows of ``x`` meet all conditions on each feature of the path: rows x features."""
    out = np.ones((len(x), len(leaf.features)), bool)
    for j, (f, tests) in enumerate(zip(leaf.features, leaf.conditions)):
        for at, continuous, left in tests:
            inside = x[:, f] <= at if continuous else np.isin(x[:, f], at)
            out[:, j] &= inside if left else ~inside
    return out


def pattern_values(shares: np.ndarray, o: np.ndarray) -> np.ndarray:
    """Attributions (of a leaf of value 1) to the features of its path, for patterns ``o``: patterns x features."""
    d = len(shares)
    weight = np.array([factorial(k) * factorial(d - k - 1) / factorial(d) for k in range(d)])
    out = np.zeros(o.shape)
    for i in range(d):
        poly = np.ones((len(o), 1))
        for j in range(d):
            if j != i:
                poly = np.pad(poly * shares[j], ((0, 0), (0, 1))) + np.pad(poly * o[:, j : j + 1], ((0, 0), (1, 0)))
        out[:, i] = (o[:, i] - shares[i]) * (poly @ weight)
    return out


def attributions(found: list[Leaf], x: np.ndarray) -> np.ndarray:
    """Shapley values of the rows of ``x``: rows x features."""
    out = np.zeros(x.shape)
    for leaf in found:
        if not leaf.features:
            continue
        o = met(leaf, x)
        packed = np.packbits(o, axis=1)
        _, first, inverse = np.unique(packed, axis=0, return_index=True, return_inverse=True)
        out[:, leaf.features] += leaf.value * pattern_values(leaf.shares, o[first].astype(float))[inverse.ravel()]
    return out


def shapley(model, df: DataFrame, key: str, features_col: str, names: list[str]) -> DataFrame:
    """Long rows (key, feature, attribution, expected_value): the exact attributions of a tree ensemble's raw score (the
    weighted sum of its trees) for every row; over the features they add up to the score less ``expected_value``, the
    mean score of the training rows of the trees.  Rows with a null vector are left out."""
    single = not hasattr(model, "trees")
    weights = [1.0] if single else list(model.treeWeights)
    if not single and not hasattr(model, "getLossType") and not hasattr(model, "getStepSize"):
        weights = [w / len(weights) for w in weights]  # a forest averages its trees
    rows = nodes(model).collect()  # the nodes of one model
    found = leaves(rows, weights)
    expected = float(sum(leaf.value * leaf.shares.prod() for leaf in found))
    held = df.sparkSession.sparkContext.broadcast(found)
    src = df.where(F.col(features_col).isNotNull()).select(F.col(key), vector_to_array(features_col).alias("_x"))
    kind = T.StructType([src.schema[key], T.StructField("_a", T.ArrayType(T.DoubleType()))])

    def run(batches):
        for b in batches:
            x = b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
            a = attributions(held.value, x) if len(x) else x
            at = pa.array(np.arange(len(x) + 1) * (a.shape[1] if len(x) else 0), pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(key), pa.ListArray.from_arrays(at, pa.array(a.ravel()))], names=[key, "_a"])

    label = F.array(*[F.lit(n) for n in names])
    long = src.mapInArrow(run, kind).select(key, F.posexplode("_a").alias("_i", "attribution"))
    return long.select(key, F.get(label, F.col("_i")).alias("feature"), "attribution", F.lit(expected).alias("expected_value"))
