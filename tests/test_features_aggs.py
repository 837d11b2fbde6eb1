import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from sparklab.operators import aggs, features as feat
from sparklab.operators import windows as win
from sparklab.streaming import events as ev


@pytest.mark.parametrize("strict", [False, True])
def test_asof_join_brute_force_hot_key_and_ties(spark, strict):
    rng = np.random.default_rng(11)
    # key 0 holds about a third of the rows; many equal timestamps
    fk = rng.choice([0, 0, 0, 1, 2, 3, 4, 5, 6, 7], 600)
    ft = rng.integers(0, 50, 600)
    fv = rng.integers(0, 1000, 600)
    lk = rng.choice([0, 0, 0, 1, 2, 3, 9], 300)
    lt = rng.integers(0, 55, 300)
    feats = pd.DataFrame({"k": fk, "ft": ft, "v": fv})
    labs = pd.DataFrame({"id": np.arange(300), "k": lk, "t": lt})
    f = spark.createDataFrame(feats.astype({"k": "int64", "ft": "int64", "v": "int64"}))
    lab = spark.createDataFrame(labs.astype("int64"))
    got = {r.id: (r.feature_ts, r.v) for r in feat.asof_join(lab, f, "k", "t", "ft", ["v"], strict=strict).collect()}
    for r in labs.itertuples():
        c = feats[(feats.k == r.k) & ((feats.ft < r.t) if strict else (feats.ft <= r.t))]
        if c.empty:
            exp = (None, None)
        else:
            best = c.sort_values(["ft", "v"]).iloc[-1]
            exp = (int(best.ft), int(best.v))
        assert got[r.id] == exp, (r, got[r.id], exp)


def test_windowed_counts_point_in_time(spark):
    df = spark.createDataFrame([(1, "2024-01-30 10:00:00", "a"), (1, "2024-01-31 23:59:59", "a"),
                                (1, "2024-02-01 00:00:00", "a"), (1, "2024-01-01 00:00:00", "b"),
                                (2, "2023-12-01 00:00:00", "b")], "k int, ts string, t string") \
        .withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    r = {x.k: x for x in feat.windowed_counts(df, "k", "ts", "2024-01-31", windows=(7, 60), type_col="t",
                                               typed={"a_7d": ("a", 7)}, ratio=(7, 60)).collect()}
    assert (r[1].events_7d, r[1].events_60d, r[1].a_7d) == (2, 3, 2)   # the Feb 1 row is after the cutoff
    # 2023-12-01 is 61 days before the cutoff: outside both windows, but still the last event
    assert r[2].events_7d == 0 and r[2].events_60d == 0 and str(r[2].last_event_date) == "2023-12-01"
    assert r[2].days_since_last_event == 61 and r[2].activity_ratio_7d_vs_avg is None  # 0 / 0 -> NULL


def test_contribution_analysis_cube(spark):
    df = spark.createDataFrame([("a", "x", 1.0, False), ("a", "x", 3.0, True), ("b", "y", 2.0, True)],
                               "d1 string, d2 string, m double, t boolean")
    r = {(x.d1, x.d2): x for x in aggs.contribution_analysis(df, ["d1", "d2"], F.col("m"), F.col("t")).collect()}
    assert r[(None, None)].delta == 4.0 and r[("a", None)].delta == 2.0 and r[("b", "y")].control == 0.0


def test_expected_value_curve_against_pandas(spark):
    rng = np.random.default_rng(2)
    p = rng.random(300).round(3)
    y = rng.random(300) < p
    m = rng.random(300) * 100
    df = spark.createDataFrame(pd.DataFrame({"p": p, "y": y, "m": m}))
    out = {round(r.threshold, 2): r for r in aggs.expected_value_curve(
        df, "p", F.col("y"), "m", aggs.threshold_grid(spark, 10, 90, 5)).collect()}
    for k in range(10, 91, 5):
        th = k / 100.0
        hit = p >= th
        assert out[round(th, 2)].contacted == hit.sum()
        net = (m[hit & y] * 12 * 0.45 * 0.30).sum() - hit.sum() * 12.0
        assert abs(out[round(th, 2)].net_value - round(net)) <= 1


def test_dedup_keeps_earliest_and_string_agg_handles_nulls(spark):
    df = spark.createDataFrame([("s", 1, "2024-01-01 00:05:00", "late"), ("s", 1, "2024-01-01 00:00:00", "first"),
                                ("s", 2, "2024-01-01 00:00:00", "x")], "source string, id int, ts string, v string")
    r = {x.id: x.v for x in ev.dedup_events(df, ["source", "id"], "ts").collect()}
    assert r == {1: "first", 2: "x"}
    g = spark.createDataFrame([(1, "b"), (1, "a"), (1, None), (1, "a")], "k int, t string")
    assert aggs.string_agg_distinct(g, ["k"], "t").first()[1] == "a,b"


def test_merge_upsert_inserts_updates_keeps(spark):
    tgt = spark.createDataFrame([(1, "old"), (2, "keep")], "k int, v string")
    src = spark.createDataFrame([(1, "new"), (3, "ins")], "k int, v string")
    assert sorted(win.merge_upsert(tgt, src, ["k"]).collect()) == [(1, "new"), (2, "keep"), (3, "ins")]


def test_profile_scan_options(spark):
    from sparklab.operators.quality import profile_scan
    df = spark.range(0, 500).selectExpr("id", "id % 3 as g", "cast(id as string) as s", "timestamp_seconds(id) as ts")
    p = {r.column_name: r for r in profile_scan(df, include=["id", "g", "s"], exclude=["s"],
                                                 incremental_col="id", last_watermark=99, top_k=2).collect()}
    assert set(p) == {"id", "g"} and p["id"].num_rows == 400 and p["g"].distinct_ratio < 0.01
    sampled = profile_scan(df, sampling_percent=50.0).first().num_rows
    assert 150 < sampled < 350


def test_mergeable_sketches_close_to_exact(spark):
    from tests.conftest import SF01
    li = spark.read.parquet(f"{SF01}/lineitem.parquet").withColumn("d", F.to_date("l_shipdate"))
    sk = aggs.quantile_sketches(li, "l_extendedprice", ["d"])
    q = aggs.merged_quantiles(sk, [0.5, 0.9]).first()
    n = li.count()
    # rank error of the merged sketch stays within a few percent
    for got, p in ((q.q50, 0.5), (q.q90, 0.9)):
        r = li.where(F.col("l_extendedprice") <= got).count() / n
        assert abs(r - p) < 0.03
    ds = aggs.merged_distinct(aggs.distinct_sketches(li, "l_partkey", ["d"])).first()[0]
    ex = li.select("l_partkey").distinct().count()
    assert abs(ds - ex) / ex < 0.05


def test_vector_search_without_broadcast_matches(spark):
    from sparklab.operators import text as tx
    from tests.conftest import SF01
    e = spark.read.parquet(f"{SF01}/embeddings.parquet")
    q = tx.centroids_by(e, "label", "embedding")
    a = tx.vector_search(e, "vec_id", "embedding", q, "label", "centroid", k=3).select("query_id", "base_id", "rank")
    b = tx.vector_search(e, "vec_id", "embedding", q, "label", "centroid", k=3, max_broadcast_queries=1).select(
        "query_id", "base_id", "rank")
    assert sorted(a.collect()) == sorted(b.collect())


def test_watchlist_tiers_and_first_true_action(spark):
    from sparklab.operators import ml
    rows = [(1, 0.9, 10.0, "a"), (2, 0.5, 20.0, "b"), (3, 0.5, 30.0, "a"), (4, 0.1, 99.0, "a"), (5, None, 1.0, "a")]
    w = ml.watchlist(spark.createDataFrame(rows, "id int, p double, v double, k string"), "id", "p", [(0.3, "low"), (0.8, "top")],
                     [("first", F.col("k") == "b"), ("rest", None)], F.col("v"), ["k"])
    got = {r["id"]: (r["tier"], r["expected_loss"], r["action"], r["k"]) for r in w.collect()}
    assert got == {1: ("top", 9.0, "rest", "a"), 2: ("low", 10.0, "first", "b"), 3: ("low", 15.0, "rest", "a")}


def test_expected_value_sums_cells_once(spark):
    """No row is multiplied by the thresholds, whichever scores there are."""
    df = spark.createDataFrame([(0.05, True, 10.0), (0.95, False, 1.0), (0.5, True, 100.0), (None, True, 7.0)], "p double, y boolean, m double")
    out = aggs.expected_value_curve(df, "p", F.col("y"), "m", aggs.threshold_grid(spark, 10, 90, 40))
    got = {r["threshold"]: (r["contacted"], r["churners_reached"], r["recall"]) for r in out.collect()}
    assert got == {0.1: (2, 1, 0.333), 0.5: (2, 1, 0.333), 0.9: (1, 0, 0.0)}
    assert "CartesianProduct" not in (plan := out._jdf.queryExecution().executedPlan().toString()) and "NestedLoop" not in plan


def test_title_verdict_by_words(spark):
    from sparklab.operators import text as tx
    rows = [("big_red_dog.jpg", "Big Red Dog", "exact", 3), ("big_red_dog.jpg", "red, big", "partial", 2), ("dog.png", "the dog", "partial", 1),
            ("dog.png", "cat", "mismatch", 0), ("dog.png", " -- ", "abstained", 0), ("dog.png", None, "abstained", 0), ("big_dog.jpg", "dog cat", "mismatch", 1)]
    got = tx.title_verdict(spark.createDataFrame([(k, *r[:2]) for k, r in enumerate(rows)], "k int, f string, t string"), "f", "t").orderBy("k").collect()
    assert [(r["verdict"], r["hits"]) for r in got] == [r[2:] for r in rows]
