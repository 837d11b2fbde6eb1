import pytest
from pyspark.sql import functions as F

from sparklab.operators import lineage as lg
from sparklab.operators import timeseries as ts


def test_regularize_duplicates_and_gaps(spark):
    rows = [("s", "2024-01-01", 1.0), ("s", "2024-01-01", 3.0), ("s", "2024-01-04", 8.0)]
    df = spark.createDataFrame(rows, "series_id string, ts string, v double").withColumn("ts", F.to_date("ts"))
    got = [(str(r.ts), r.y, r.is_filled) for r in ts.regularize(df, ["series_id"], "ts", "v").orderBy("ts").collect()]
    assert got == [("2024-01-01", 2.0, False), ("2024-01-02", 4.0, True), ("2024-01-03", 6.0, True),
                   ("2024-01-04", 8.0, False)]


def test_decomposition_adds_up_and_spikes(spark):
    rows = [("s", i, 10.0 + (i % 7) + (100.0 if i == 20 else 0.0)) for i in range(60)]
    df = spark.createDataFrame(rows, "series_id string, i int, y double").withColumn(
        "ts", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")))
    d = ts.decompose(df, ["series_id"], 7).where(F.col("trend").isNotNull())
    bad = d.where(F.abs(F.col("trend") + F.col("seasonal") + F.col("residual") - F.col("y")) > 1e-9).count()
    assert bad == 0
    sp = ts.clean_spikes(df, ["series_id"], 3, 5.0).where("is_spike").select("i").collect()
    assert [r.i for r in sp] == [20]


def test_forecast_failures_are_rows(spark):
    rows = [("long", i, float(i % 5)) for i in range(40)] + [("one", 0, 1.0), ("two", 0, 1.0), ("two", 1, 2.0)]
    df = spark.createDataFrame(rows, "series_id string, i int, y double").withColumn(
        "ts", F.date_add(F.lit("2024-01-01").cast("date"), F.col("i")))
    fc = ts.forecast_many(df, "series_id", horizon=5)
    st = {r.series_id: r.status for r in fc.select("series_id", "status").distinct().collect()}
    assert st == {"long": "ok", "one": "failed", "two": "failed"}
    iv = ts.with_intervals(fc, 0.9, horizon=3)
    assert iv.count() == 3 and iv.where("prediction_interval_lower_bound > forecast_value").count() == 0


def test_reconcile_children_sum_to_parent(spark):
    leaf = spark.createDataFrame([("d1", "a", "x", 1.0), ("d1", "a", "y", 2.0), ("d1", "b", "x", 4.0)],
                                 "fd string, l1 string, l2 string, v double")
    r = {(x.l1, x.l2): x.v for x in ts.reconcile_bottom_up(leaf, ["l1", "l2"], "fd", "v").collect()}
    assert r[(None, None)] == 7.0 and r[("a", None)] == 3.0


def test_lineage_cycles_terminate(spark):
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "d")], "child string, parent string")
    starts = spark.createDataFrame([("a",)], "start string")
    got = {(r.ancestor, r.depth) for r in lg.upstream(edges, starts, max_depth=10).collect()}
    assert got == {("b", 1), ("c", 2), ("d", 3)}


def test_sampled_shapley_efficiency(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.linalg import Vectors
    from sparklab.operators.explain import approximation_error, sampled_shapley
    rows = [(i, Vectors.dense([float(i % 5), float(i % 3), float(i % 7)]), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, ["id", "features", "label"])
    m = LogisticRegression().fit(df)
    attr = sampled_shapley(m, df.select("id", "features"), "id", "features", ["a", "b", "c"], path_count=5)
    fx = m.transform(df).select("id", vector_to_array("probability")[1].alias("_f"))
    base = spark.createDataFrame([(Vectors.dense([0.0, 0.0, 0.0]),)], ["features"])
    fb = m.transform(base).select(vector_to_array("probability")[1]).first()[0]
    err = approximation_error(attr, "id", fx, fb)
    assert err.agg(F.max("approximation_error")).first()[0] < 1e-9


def test_linear_attributions_sum(spark):
    from pyspark.ml.linalg import Vectors
    from sparklab.operators.explain import linear_attributions
    df = spark.createDataFrame([(1, Vectors.dense([1.0, 2.0]))], ["id", "f"])
    a = linear_attributions(df, "id", "f", [0.5, -1.0], ["x", "y"], baseline=[0.0, 1.0])
    assert sorted((r.feature, r.attribution) for r in a.collect()) == [("x", 0.5), ("y", -1.0)]


def test_pca_reconstruction_error_zero_at_full_rank(spark):
    from sparklab.operators import unsup as us
    rows = [(i, float(i % 5), float((i * 3) % 7), float(i % 2)) for i in range(40)]
    df = spark.createDataFrame(rows, "id int, a double, b double, c double")
    full = us.pca_pipeline(["a", "b", "c"], 3).fit(df)
    e = us.pca_reconstruction_error(full, df, "id").agg(F.max("reconstruction_mse")).first()[0]
    assert e < 1e-18
    one = us.pca_pipeline(["a", "b", "c"], 1).fit(df)
    assert us.pca_reconstruction_error(one, df, "id").agg(F.max("reconstruction_mse")).first()[0] > 0
