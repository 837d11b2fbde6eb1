"""Inputs on which an operator must neither drop rows nor stay silent: NULL groups, ties, constant baselines,
repeated matches, long chains, series that cannot be fitted."""

import pytest
from pyspark.sql import functions as F

from sparklab.operators import lineage, privacy, quality, ranking, timeseries, windows
from sparklab.streaming import events


def test_constant_baseline_shows_drift(spark):
    a, b = (spark.range(50).select(F.lit(x).alias("x")) for x in (5.0, 99.0))
    assert quality.js_divergence(a, b, "x").first()["jsd"] == pytest.approx(1.0)
    assert quality.js_divergence(a, a, "x").first()["jsd"] == pytest.approx(0.0)
    c = spark.range(50).select(F.col("id").cast("double").alias("x"))
    assert quality.js_divergence(c, c.select((F.col("x") - 1000).alias("x")), "x").first()["jsd"] == pytest.approx(1.0)


def test_dedupe_exact_with_ties_and_null_groups(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (None, None), (4, None)], "id long, k string")
    got = {(r["id"], r["k"], r["n"]) for r in windows.dedupe_exact(df, ["k"], "id", copies="n").collect()}
    assert got == {(1, "a", 2), (1, "b", 1), (4, None, 2)}


def test_lag_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1, 10), (None, 2, 20), ("a", 1, 5)], "k string, o int, v int")
    got = {(r["k"], r["o"], r["p"]) for r in events.distributed_lag(df, ["k"], ["o"], "v", "p").collect()}
    assert got == {(None, 1, None), (None, 2, 10), ("a", 1, None)}


def test_ranked_frame_starts_no_job_and_is_released(spark):
    df = spark.range(100).groupBy((F.col("id") % 7).alias("g")).agg(F.count("*").alias("n"))
    sc = spark.sparkContext
    sc.setJobGroup("ranked-frame", "building only")
    ranked = ranking.ntile(df, 3, [], ["n", "g"])
    jobs = sc.statusTracker().getJobIdsForGroup("ranked-frame")
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs and ranked.count() == 7
    ranking.release()
    assert not ranking._HELD


def test_lineage_of_any_depth(spark):
    chain = spark.createDataFrame([(f"n{k}", f"n{k + 1}") for k in range(12)], "child string, parent string")
    starts = spark.createDataFrame([("n0",)], "start string")
    assert lineage.upstream(chain, starts).agg(F.max("depth")).first()[0] == 12
    with pytest.raises(ValueError, match="not complete"):
        lineage.upstream(chain, starts, max_depth=5)


def test_hotword_counts_for_its_own_finding(spark):
    card = "4111 1111 1111 1111"
    df = spark.createDataFrame([(1, f"{card} and then a long stretch of other words, card {card}")], "id long, t string")
    found = privacy.inspect_infotypes(df, "id", "t", with_offsets=True).where("info_type = 'CREDIT_CARD_NUMBER'")
    rows = privacy.apply_rules(found, df, "id", "t", hotwords={"CREDIT_CARD_NUMBER": ["card"]}).orderBy("start").collect()
    assert [r["likelihood"] for r in rows] == ["LIKELY", "VERY_LIKELY"]


def test_series_that_cannot_be_fitted_are_rows(spark):
    df = spark.createDataFrame([("a", k, None if k == 2 else 1.0 * k) for k in range(8)] + [("b", 1, 1.0)] + [("c", k, k % 3 + 0.5) for k in range(9)], "s string, d int, y double")
    df = df.select("s", F.expr("date_add(date'2024-01-01', d)").alias("ts"), "y")
    got = {r["series_id"]: r["status"] for r in timeseries.fit_metadata(df, "s").collect()}
    assert got == {"a": "failed", "b": "failed", "c": "ok"}
    hist = df.withColumn("x", F.dayofmonth("ts").cast("double"))
    future = hist.where("s <> 'a'").withColumn("ts", F.expr("ts + interval 30 days").cast("date")).drop("y")
    out = {(r["s"], r["status"]) for r in timeseries.xreg_fit_forecast(hist, future, "s", ["x"]).collect()}
    assert out == {("a", "failed"), ("b", "failed"), ("c", "ok")}
