"""Successive halving: one fit per tree, trials that resume, tables that are read back."""

import math

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sparklab.operators import tuning


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    y = ((x[:, 0] * x[:, 1] > 0) ^ (rng.random(600) < 0.1)).astype(float)
    rows = spark.createDataFrame([(k, v.tolist(), float(t), k % 5 == 0) for k, (v, t) in enumerate(zip(x, y))] + [(600, [0.0] * 4, None, False)], "id long, x array<double>, label double, is_eval boolean")
    return rows.withColumn("features", array_to_vector("x")).cache()


def test_draws_lie_in_the_space_and_repeat():
    a, b = tuning.draw(50, 3), tuning.draw(50, 3)
    assert a == b and a != tuning.draw(50, 4)
    for t in a:
        assert isinstance(t["max_depth"], int) and all(lo <= t[k] <= hi for k, (lo, hi) in tuning.SPACE.items())
    assert len({t["max_depth"] for t in a}) > 4


def test_halving_fits_each_tree_once_and_resumes(spark, data):
    seen = []
    folder = tuning.search(data, "id", "label", "features", "is_eval", trials=10, parallel=2, rungs=(1, 2, 4), on_fit=lambda t: seen.append((t.trial_id, len(t.trees), t.fits)))
    info = {r["trial_id"]: r for r in tuning.trial_info(spark, folder).collect()}
    assert len(info) == 10 and sum(r["is_optimal"] for r in info.values()) == 1
    assert sorted(r["n_trees"] for r in info.values()) == [1] * 5 + [2] * 3 + [4] * 2
    # no tree of any trial was fitted twice, in whichever rung
    assert all(r["n_fits"] == r["n_trees"] for r in info.values()) and all(n == f for _, n, f in seen)
    assert sum(r["n_fits"] for r in info.values()) == 5 + 6 + 8
    assert {r["status"] for r in info.values()} == {"STOPPED", "SUCCEEDED"} and sum(r["status"] == "SUCCEEDED" for r in info.values()) == 2
    kept = [r["roc_auc"] for r in info.values() if r["status"] == "SUCCEEDED"]
    best = next(r for r in info.values() if r["is_optimal"])
    assert best["roc_auc"] == max(kept) and 0.5 < best["roc_auc"] <= 1
    steps = tuning.iterations(spark, folder).collect()
    assert len(steps) == 19 and all(r["loss"] > 0 and r["eval_loss"] > 0 for r in steps)
    assert [r["iteration"] for r in steps if r["trial_id"] == best["trial_id"]] == [1, 2, 3, 4]


def test_resumed_trial_equals_one_that_never_stopped(spark, data, tmp_path):
    rows = tuning.start(data, "id", "label", "features", "is_eval")
    p = {"max_depth": 3, "learn_rate": 0.2, "min_split_gain": 0.0, "subsample": 0.8}
    once, twice = (tuning.Trial(k, p, str(tmp_path / str(k)), 5) for k in range(2))
    tuning.boost(once, rows, 4)
    tuning.boost(twice, rows, 1)
    tuning.boost(twice, rows, 3)
    assert np.allclose([x[1:] for x in once.losses], [x[1:] for x in twice.losses]) and once.auc == pytest.approx(twice.auc)
    # margins are the start plus the steps of the trees, and the loss is that of the margins
    got = {r["key"]: r["margin"] for r in spark.read.parquet(twice.at).collect()}
    base = rows.first()["margin"]
    vectors = {r["key"]: (r["features"], r["y"], r["is_eval"]) for r in rows.collect()}
    assert set(got) == set(vectors) == set(range(600))
    for k in range(0, 600, 41):
        assert got[k] == pytest.approx(base + sum(4 * 0.2 * t.predict(vectors[k][0]) for t in twice.trees))
    train = [math.log1p(math.exp(-(got[k] if y == 1 else -got[k]))) for k, (_, y, e) in vectors.items() if not e]
    assert twice.losses[-1][1] == pytest.approx(np.mean(train))
    assert twice.losses[-1][1] < twice.losses[0][1]


def test_early_stop_and_failed_trials(spark, data, tmp_path):
    rows = tuning.start(data.withColumn("label", F.when(F.col("is_eval"), F.pmod(F.xxhash64("id"), F.lit(2)).cast("double")).otherwise(F.col("label"))), "id", "label", "features", "is_eval")
    t = tuning.Trial(0, {"max_depth": 8, "learn_rate": 0.3, "min_split_gain": 0.0, "subsample": 1.0}, str(tmp_path), 1)
    tuning.boost(t, rows, 30, patience=2)
    assert t.status == "EARLY_STOPPED" and 2 <= len(t.trees) < 30  # random evaluation labels cannot be learnt
    folder = tuning.search(data, "id", "label", "features", "is_eval", trials=2, rungs=(1,), space=tuning.SPACE | {"max_depth": (40, 41)})
    rows = tuning.trial_info(spark, folder).collect()
    assert [r["status"] for r in rows] == ["FAILED"] * 2 and all(r["error_message"] for r in rows) and not any(r["is_optimal"] for r in rows)
