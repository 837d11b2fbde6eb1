"""Distributed order statistics equal Spark's window functions, including ties,
NULLs, a hot group holding a third of the rows and n not divisible by k."""

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sparklab.operators import ranking


@pytest.fixture(scope="module")
def data(spark):
    rows = []
    for i in range(997):
        g = "hot" if i % 3 == 0 else f"g{i % 7}"
        v = None if i % 101 == 0 else float((i * 37) % 50)  # many ties
        rows.append((i, g, v))
    return spark.createDataFrame(rows, "id long, g string, v double")


def _cmp(a, b, col_a, col_b):
    j = a.select("id", col_a).join(b.select("id", col_b), "id")
    bad = j.where(~F.col(col_a).eqNullSafe(F.col(col_b))).count()
    return bad, j.count()


def test_row_number_partitioned(data):
    a = ranking.row_number(data, ["g"], [F.col("v"), F.col("id")], "rn", n_parts=5)
    b = data.withColumn("rn2", F.row_number().over(Window.partitionBy("g").orderBy("v", "id")))
    assert _cmp(a, b, "rn", "rn2") == (0, 997)


@pytest.mark.parametrize("k", [3, 10, 7])
def test_ntile_global(data, k):
    a = ranking.ntile(data, k, [], [F.col("v"), F.col("id")], "t", n_parts=6)
    b = data.withColumn("t2", F.ntile(k).over(Window.orderBy("v", "id")))
    assert _cmp(a, b, "t", "t2") == (0, 997)


def test_percent_rank_and_rank_with_ties_and_nulls(data):
    a = ranking.percent_rank(data, ["g"], "v", "pr", n_parts=4)
    b = data.withColumn("pr2", F.percent_rank().over(Window.partitionBy("g").orderBy("v")))
    assert _cmp(a, b, "pr", "pr2") == (0, 997)
    r = ranking.rank(data, [], "v", "r", descending=True)
    r2 = data.withColumn("r2", F.rank().over(Window.orderBy(F.desc("v"))))
    assert _cmp(r, r2, "r", "r2") == (0, 997)


def test_dense_rank_and_cume_dist(data):
    a = ranking.rank(data, ["g"], "v", "dr", dense=True)
    b = data.withColumn("dr2", F.dense_rank().over(Window.partitionBy("g").orderBy("v")))
    assert _cmp(a, b, "dr", "dr2") == (0, 997)
    c = ranking.cume_dist(data, ["g"], "v", "cd")
    d = data.withColumn("cd2", F.cume_dist().over(Window.partitionBy("g").orderBy("v")))
    assert _cmp(c, d, "cd", "cd2") == (0, 997)


def test_no_single_partition_exchange(data):
    """Rows never cross a single-partition exchange; only aggregated slice totals do."""
    lines = ranking.ntile(data, 10, [], [F.col("v"), F.col("id")], "t")._jdf.queryExecution().executedPlan() \
        .toString().split("\n")
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "Aggregate" in lines[i + 1]


def test_null_groups_stay(spark):
    from pyspark.sql import Window
    from pyspark.sql import functions as F

    from sparklab.operators import ranking

    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 2.0), ("a", 3, 1.0), ("a", 4, 3.0)], "g string, id int, v double")
    w = Window.partitionBy("g").orderBy("v", "id")
    want = {(r["id"], r["rn"], r["pr"], r["nt"]) for r in df.select("id", F.row_number().over(w).alias("rn"), F.percent_rank().over(Window.partitionBy("g").orderBy("v")).alias("pr"), F.ntile(2).over(w).alias("nt")).collect()}
    rn = {r["id"]: r["rn"] for r in ranking.row_number(df, ["g"], ["v", "id"]).collect()}
    pr = {r["id"]: r["percent_rank"] for r in ranking.percent_rank(df, ["g"], "v").collect()}
    nt = {r["id"]: r["ntile"] for r in ranking.ntile(df, 2, ["g"], ["v", "id"]).collect()}
    assert {(k, rn[k], pr[k], nt[k]) for k in rn} == want and len(rn) == len(pr) == len(nt) == 4


def test_auto_split_of_a_huge_table_has_eval_rows(spark):
    from sparklab.operators import ml

    rows = spark.range(400_000).withColumnRenamed("id", "k")
    assert ml.data_split(rows, "AUTO", "k", n_rows=1_000_000_000).where("is_eval").count() > 0


def test_exact_quantiles_of_a_hot_group(spark):
    """A group with half of the rows, ties, NULLs and a NULL group; the same as NumPy's, from slices that hold no group."""
    rng = np.random.default_rng(5)
    rows = [("hot", float(v)) for v in rng.integers(0, 400, 3000) / 4] + [(f"g{k % 40}", float(v)) for k, v in enumerate(rng.normal(size=2900))]
    rows += [(None, 3.0), (None, 8.0), ("none", None), ("hot", None), ("one", 4.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    qs = {"a": 0.0, "b": 0.25, "median": 0.5, "c": 0.9, "d": 1.0}
    got = {r["g"]: r for r in ranking.exact_quantiles(df, ["g"], "v", qs, n_parts=7).collect()}
    by = {}
    for g, v in rows:
        if v is not None:
            by.setdefault(g, []).append(v)
    assert set(got) == set(by)
    for g, v in by.items():
        assert np.allclose([got[g][n] for n in qs], np.quantile(v, list(qs.values())))
    whole = ranking.exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert whole == pytest.approx(np.median([v for x in by.values() for v in x]))
    from sparklab.operators import aggs
    m = {r["g"]: r for r in aggs.group_mean_median(df, ["g"], "v").collect()}
    assert m["none"]["n"] == 1 and m["none"]["median"] is None and m[None]["median"] == 5.5 and m["hot"]["n"] == 3001


def test_window_drift_without_a_grid(spark):
    """Against all (window, category) pairs, with categories that only one side has."""
    from sparklab.streaming.events import linf_by_window
    rng = np.random.default_rng(6)
    cats = [f"c{k}" for k in range(8)] + [None]
    base = {c: float(p) for c, p in zip(cats[:6] + [None], rng.dirichlet(np.ones(7)))}
    share = []
    for w in range(30):
        some = [cats[k] for k in rng.choice(9, rng.integers(1, 9), replace=False)]
        share += [(w, c, float(q)) for c, q in zip(some, rng.dirichlet(np.ones(len(some))))]
    got = {r["_w"]: r["linf"] for r in linf_by_window(spark.createDataFrame(share, "_w int, cat string, q double"), spark.createDataFrame(list(base.items()), "cat string, p double"), "cat").collect()}
    for w in range(30):
        own = {c: q for x, c, q in share if x == w}
        assert got[w] == pytest.approx(max(abs(own.get(c, 0) - base.get(c, 0)) for c in cats))
