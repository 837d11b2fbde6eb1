"""Queries that pass over their rows once, and exact comparisons in blocks."""

import datetime as dt
import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.operators import blocks, unsup
from sparklab.operators import explain as xp
from sparklab.operators import text as tx
from sparklab.sources import io


@pytest.mark.parametrize("n,m,k", [(3, 2, 5), (1500, 9000, 5), (7, 6000, 1)])
def test_best_matches_of_a_block(n, m, k):
    r = np.random.default_rng(n)
    x, y = r.normal(size=(n, 6)), r.normal(size=(m, 6))
    y[: m // 2] = y[m // 2 : m // 2 * 2]  # every row twice: ties
    full = x @ y.T
    row, col, score = blocks.best(x, y, np.zeros(m), k, 0.0)
    for i in range(n):
        want = np.sort(full[i])[::-1][:k]
        assert set(np.flatnonzero(full[i] > want[-1] + 1e-9)) <= set(col[row == i]) and np.allclose(np.sort(score[row == i])[::-1][: len(want)], want)


def test_vector_search_in_blocks_equals_brute_force(spark, monkeypatch):
    r = np.random.default_rng(2)
    rows = [(k, [float(x) for x in r.normal(size=4)]) for k in range(400)]
    rows += [(400 + k, rows[k][1]) for k in range(5)] + [(500, [1.0, 2.0]), (501, [1.0, float("nan"), 0.0, 0.0])]
    base = spark.createDataFrame(rows, "id long, v array<double>")
    ask = base.where("id < 120")
    got = tx.vector_search(base, "id", "v", ask, "id", "v", k=3)
    assert "FlatMapCoGroupsInArrow" in got._jdf.queryExecution().toString()
    monkeypatch.setattr(tx, "FEW_QUERIES", 10_000)
    old = tx.vector_search(base, "id", "v", ask, "id", "v", k=3)
    key = lambda d: sorted((x["query_id"], x["rank"], x["base_id"], str(x["distance"])) for x in d.collect())
    assert key(got) == key(old)


def test_recommendations_are_the_best_of_all_items(spark, monkeypatch):
    monkeypatch.setattr(unsup, "USER_BLOCK", 7)
    monkeypatch.setattr(unsup, "ITEM_BLOCK", 10)
    r = np.random.default_rng(3)
    rows = [(int(u), int(i), float(x)) for u, i, x in zip(r.integers(0, 40, 400), r.integers(0, 60, 400), r.integers(1, 9, 400))]
    ratings = spark.createDataFrame(rows, "user_id int, item_id int, rating double")
    m = unsup.als_fit(ratings, "user_id", "item_id", "rating", max_iter=3)
    users = spark.createDataFrame([(u,) for u in [*range(20), 3, None, 900]], "user_id int")
    rec = unsup.als_recommend(m, users, "user_id", 4)
    assert [(f.name, f.dataType.simpleString()) for f in rec.schema] == [("user_id", "int"), ("rank", "int"), ("item_id", "int"), ("rating", "float")]
    u = {x["id"]: np.array(x["features"]) for x in m.userFactors.collect()}
    v = {x["id"]: np.array(x["features"]) for x in m.itemFactors.collect()}
    got = {}
    for x in rec.collect():
        got.setdefault(x["user_id"], {})[x["rank"]] = (x["item_id"], x["rating"])
    assert set(got) == set(u) & set(range(20))
    for k, best in got.items():
        want = sorted((float(u[k] @ w) for w in v.values()), reverse=True)[:4]
        assert np.allclose([best[n][1] for n in (1, 2, 3, 4)], want, atol=1e-5)
        assert all(math.isclose(float(u[k] @ v[i]), x, abs_tol=1e-5) for i, x in best.values())


def test_features_are_worked_out_once(spark, tmpdir_path):
    from sparklab.plans import modeling
    from sparklab.sources.tables import Tables
    day = dt.datetime(2000, 1, 1)
    customers = [(k, k % 5, float(k), ["A", "B"][k % 2]) for k in range(40)]
    orders = [(k, k % 40, 10.0 * k, day + dt.timedelta(days=k % 400)) for k in range(300)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(os.path.join(tmpdir_path, "customer.parquet"))
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz").write.parquet(os.path.join(tmpdir_path, "orders.parquet"))
    t = Tables(spark, tmpdir_path)
    f = modeling.kept_features(t)
    plan = modeling.training_frame(t)._jdf.queryExecution().toString()
    assert "Join" not in plan and "Exchange" not in plan and modeling.kept_features(t) is f
    key = lambda d: sorted(map(str, d.collect()))
    assert key(f) == key(modeling.customer_features(t)) and f.count() > 0


def test_cluster_measures_pass_over_the_rows_once(spark):
    r = np.random.default_rng(4)
    d = spark.createDataFrame([(k, float(x), float(y)) for k, (x, y) in enumerate(r.normal(size=(200, 2)))], "id long, a double, b double")
    m = unsup.kmeans_pipeline(["a", "b"], 3).fit(d)
    e = unsup.kmeans_evaluate(m, d)
    assert "UDF" not in e._jdf.queryExecution().toString() and e.first()["davies_bouldin_index"] > 0


def test_sampled_shapley_sums_without_ordering_paths(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.linalg import Vectors
    r = np.random.default_rng(6)
    rows = [(k, float(a), float(b), float(c), float(a + b > 0)) for k, (a, b, c) in enumerate(r.normal(size=(60, 3)))]
    d = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(spark.createDataFrame(rows, "id long, a double, b double, c double, label double"))
    m = LogisticRegression(maxIter=5).fit(d)
    s = xp.sampled_shapley(m, d, "id", "features", ["a", "b", "c"], path_count=4)
    assert "Window" not in s._jdf.queryExecution().toString() and s.count() == 180
    p = {x["id"]: x["probability"][1] for x in m.transform(d).collect()}
    zero = m.predictProbability(Vectors.dense([0.0] * 3))[1]
    for x in s.groupBy("id").agg(F.sum("attribution").alias("t")).collect():
        assert math.isclose(x["t"], p[x["id"]] - zero, abs_tol=1e-9)


def test_scorer_gets_slices_of_bounded_size(spark):
    def scorer(prompts):
        return ['{"n": %d}' % len(prompts)] * len(prompts)
    few = spark.range(0, 5000, 1, 1).select("id", F.lit("t").alias("t"))
    got = tx.score_table(few, F.col("t"), scorer, "n INT", keep=["id"])
    assert got.count() == 5000 and got.agg(F.max("n")).first()[0] <= 1000
    long = spark.range(0, 40, 1, 1).select("id", F.repeat(F.lit("x"), 300_000).alias("t"))
    assert tx.score_table(long, F.col("t"), scorer, "n INT", keep=["id"]).agg(F.max("n")).first()[0] <= 4


def test_scorer_holds_no_arrow_batch_beyond_its_slices(spark):
    for key, value in (("maxRecordsPerBatch", "10000"), ("maxBytesPerBatch", str(64 << 20))):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", value)
    few = spark.range(0, 10, 1, 1).select("id", F.lit("t").alias("t"))
    assert tx.score_table(few, F.col("t"), tx.LexiconScorer, "sentiment string", keep=["id"]).count() == 10
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == str(tx.SCORE_ROWS)
    assert spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch") == str(tx.SCORE_BYTES)


def test_row_groups_of_a_file_are_opened_together(spark):
    groups = spark.createDataFrame([("f", k) for k in range(600)] + [("g", 5)], "file string, row_group int")
    lists = [x["row_groups"] for x in io.neighbours(groups).where("file = 'f'").collect()]
    assert len(lists) == 3 and sorted(k for x in lists for k in x) == list(range(600))
    assert io.neighbours(groups).where("file = 'g'").collect()[0]["row_groups"] == [5]


def test_feature_flags_are_those_of_the_scored_customers():
    import __spark_entry__ as e
    sql = e.oracle_sql()["feature_flags"]
    assert "FROM scores" in sql and all(c in sql for c in ("is_high_value", "is_new_customer", "is_frequent"))


def test_best_products_are_carried_from_block_to_block(spark):
    r = np.random.default_rng(8)
    x, y = r.normal(size=(50, 4)).astype(np.float32), r.normal(size=(90, 4)).astype(np.float32) * r.lognormal(size=(90, 1)).astype(np.float32)
    x[0], y[60:] = 0, y[:30]  # a row that ties with all, rows that come twice
    left = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "id int, features array<float>")
    right = spark.createDataFrame([(200 - k, v.tolist()) for k, v in enumerate(y)] + [(1, [math.nan] * 4)], "id int, features array<float>")
    for size, k in ((1000, 3), (20, 3), (7, 5), (20, 100)):
        got = {}
        for z in blocks.top_products(left, right, k, 16, size).collect():
            got.setdefault(z["id"], {})[z["rank"]] = (z["other"], z["score"])
        assert set(got) == set(range(50))
        for n, best in got.items():
            want = sorted(((-float(s), 200 - m) for m, s in enumerate((x[n : n + 1] @ y.T)[0])))[:k]
            assert sorted(best) == list(range(1, len(want) + 1))
            assert [best[m + 1][0] for m in range(len(want))] == [m for _, m in want] and np.allclose([best[m + 1][1] for m in range(len(want))], [-s for s, _ in want], atol=1e-5)
    assert blocks.top_products(left, right.where("id < 0"), 3, 16, 7).count() == 0 and blocks.top_products(left.where("id < 0"), right, 3, 16, 7).count() == 0


def test_rows_that_tie_with_all_hold_k():
    y = np.ones((9000, 3), np.float32)
    held, scores = np.zeros((300, 2), np.int64), np.full((300, 2), -np.inf, np.float32)
    blocks.top(np.zeros((300, 3), np.float32), y, np.arange(9000)[::-1], np.full(9000, 3**0.5), held, scores)
    assert (held == [0, 1]).all() and (scores == 0).all()


def test_recommendations_pack_no_block_into_a_row_and_fit_in_more_blocks(spark, monkeypatch):
    ratings = spark.createDataFrame([(u, (u * k) % 31, float(k)) for u in range(30) for k in range(1, 9)], "user_id int, item_id int, rating double").distinct()
    few = unsup.als_fit(ratings, "user_id", "item_id", "rating", max_iter=1)
    assert few.userFactors._jdf.rdd().getNumPartitions() == 10
    monkeypatch.setattr(unsup, "RATING_BLOCK", 10)
    m = unsup.als_fit(ratings, "user_id", "item_id", "rating", max_iter=2)
    assert m.userFactors._jdf.rdd().getNumPartitions() == m.itemFactors._jdf.rdd().getNumPartitions() == 24
    plan = unsup.als_recommend(m, ratings.select("user_id").distinct(), "user_id", 4)._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInArrow" not in plan and "collect_list" not in plan and "Window" not in plan


def test_rounds_follow_the_rows_and_not_the_partitions(spark, monkeypatch):
    frame = type(spark.range(0))
    dealt = frame.repartitionByRange
    monkeypatch.setattr(frame, "repartitionByRange", lambda self, n, *cols: dealt(self, max(n, 40), *cols))
    said = []
    send = type(spark.sparkContext).broadcast
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", lambda self, value: said.append(len(value[0])) or send(self, value))
    side = spark.createDataFrame([(k, [1.0, k / 100]) for k in range(100)], "id int, features array<float>")
    assert blocks.top_products(side, side, 2, 100, 100).count() == 200 and said == [100]
