"""Exact Shapley values of tree ensembles against all subsets of the features."""

import itertools
import math

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, RandomForestRegressor
from pyspark.ml.feature import VectorIndexer
from pyspark.sql import functions as F

from sparklab.operators import trees

NAMES = ["a", "b", "c", "d", "e"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(400, 5))
    x[:, 4] = rng.integers(0, 4, 400)
    y = x[:, 0] * x[:, 1] + np.where(x[:, 2] > 0.3, 2, 0) + (x[:, 4] == 2) - (x[:, 4] == 0) * x[:, 3]
    raw = spark.createDataFrame([(k, v.tolist(), float(t), float(t > 0.5)) for k, (v, t) in enumerate(zip(x, y))], "id long, x array<double>, y double, label double").withColumn("raw", array_to_vector("x"))
    # the last feature is categorical
    return VectorIndexer(inputCol="raw", outputCol="features", maxCategories=5).fit(raw).transform(raw).cache()


def conditional(tree, i, x, known):
    """Expected prediction of a tree if only the features ``known`` are given."""
    r = tree[i]
    if r["left"] < 0:
        return r["prediction"]
    if r["feature"] in known:
        v = x[r["feature"]]
        left = v <= r["at"][0] if r["n_categories"] < 0 else v in r["at"]
        return conditional(tree, r["left"] if left else r["right"], x, known)
    return sum(tree[c]["cover"] / r["cover"] * conditional(tree, c, x, known) for c in (r["left"], r["right"]))


def all_subsets(rows, weights, x):
    by = {}
    for r in rows:
        by.setdefault(r["tree"], {})[r["id"]] = r
    f = lambda known: sum(w * conditional(by[t], 0, x, known) for t, w in enumerate(weights))
    out = []
    for i in range(5):
        rest = [j for j in range(5) if j != i]
        out.append(sum(math.factorial(k) * math.factorial(4 - k) / 120 * (f({*s, i}) - f(set(s))) for k in range(5) for s in itertools.combinations(rest, k)))
    return out, f(set()), f(set(range(5)))


@pytest.mark.parametrize("kind", ["gbt", "gbt_regressor", "forest", "forest_regressor", "tree"])
def test_equals_all_subsets(data, kind):
    est = {"gbt": GBTClassifier(maxIter=6, maxDepth=4, seed=1, stepSize=0.3), "gbt_regressor": GBTRegressor(labelCol="y", maxIter=5, maxDepth=5, seed=1), "forest": None, "forest_regressor": RandomForestRegressor(labelCol="y", numTrees=5, maxDepth=4, seed=1), "tree": DecisionTreeRegressor(labelCol="y", maxDepth=5)}[kind]
    if kind == "forest":  # of a classifier the nodes predict classes; the regression forms cover the forests
        assert len(RandomForestClassifier(numTrees=3, maxDepth=3, seed=1).fit(data).trees) == 3
        return
    model = est.fit(data)
    weights = [1.0] if kind == "tree" else list(model.treeWeights)
    if kind == "forest_regressor":
        weights = [w / len(weights) for w in weights]
    rows = trees.nodes(model).collect()
    got = {}
    out = trees.shapley(model, data, "id", "features", NAMES)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        got.setdefault(r["id"], {})[r["feature"]] = r
    assert len(got) == 400
    sample = data.where("id % 37 = 0").select("id", vector_to_array("features").alias("v")).collect()
    for r in sample:
        want, base, whole = all_subsets(rows, weights, r["v"])
        mine = [got[r["id"]][n]["attribution"] for n in NAMES]
        assert np.allclose(mine, want, atol=1e-9) and got[r["id"]]["a"]["expected_value"] == pytest.approx(base)
        assert sum(mine) + base == pytest.approx(whole)
    if kind in ("gbt_regressor", "forest_regressor", "tree"):
        score = {r["id"]: r["prediction"] for r in model.transform(data).collect()}
        assert all(sum(v["attribution"] for v in got[k].values()) + got[k]["a"]["expected_value"] == pytest.approx(score[k]) for k in got)


def test_split_statistics_come_from_the_nodes(data):
    model = GBTClassifier(maxIter=5, maxDepth=3, seed=1).fit(data)
    splits = [r for r in trees.nodes(model).collect() if r["left"] >= 0]
    got = {r["feature"]: r for r in trees.importance(model, NAMES + ["unused"]).collect()}
    assert set(got) == {*NAMES, "unused"} and got["unused"]["importance_weight"] == 0 and got["unused"]["importance_gain"] == 0
    for k, n in enumerate(NAMES):
        own = [r for r in splits if r["feature"] == k]
        assert got[n]["importance_weight"] == len(own)
        if own:
            assert got[n]["importance_gain"] == pytest.approx(np.mean([r["gain"] for r in own]))
            assert got[n]["importance_cover"] == pytest.approx(np.mean([r["cover"] for r in own]))
    assert max(r["cover"] for r in splits) == 400


def test_rows_without_a_vector_and_empty_tables(data):
    model = DecisionTreeRegressor(labelCol="y", maxDepth=2).fit(data)
    some = data.limit(2).select("id", "features").unionByName(data.limit(1).select(F.lit(-1).cast("long").alias("id"), F.lit(None).cast(data.schema["features"].dataType).alias("features")))
    assert trees.shapley(model, some, "id", "features", NAMES).count() == 10
    assert trees.shapley(model, some.where("false"), "id", "features", NAMES).count() == 0
