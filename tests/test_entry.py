"""Driver contract and plan-shape checks (scale properties visible in the plan)."""

import __spark_entry__ as E
from pyspark.sql import functions as F

from tests.conftest import SF001


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "events_7d" in df.columns


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs) and len(qs) >= 200


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_and_columns_reach_the_scan(spark):
    qs = E.queries()
    p = _plan(qs["windowed_countif"](spark, SF001))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in p
    p2 = _plan(qs["select_except"](spark, SF001))
    assert "c_name" not in p2.split("ReadSchema:")[1].split("\n")[0]


def test_global_windows_are_distributed(spark):
    """Only already-aggregated data (slice totals, one-row counts) may cross a
    single-partition exchange: the child of every such exchange is an aggregate."""
    qs = E.queries()
    for k in ("ntile_deciles", "decile_calibration", "percent_rank_in_group", "rank_desc", "chronological_split",
              "roc_curve", "pr_auc", "evaluate_classifier"):
        lines = _plan(qs[k](spark, SF001)).split("\n")
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" in line:
                assert "Aggregate" in lines[i + 1], (k, lines[i + 1])


def test_no_python_udf_in_sql_paths(spark):
    qs = E.queries()
    for k in ("windowed_countif", "build_customer_features", "sentiment_score_magnitude", "inspect_infotypes",
              "chunk_documents", "vector_search", "dedup_events"):
        p = _plan(qs[k](spark, SF001))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, k


def test_per_group_top_n_is_limited_before_the_shuffle(spark):
    p = _plan(E.queries()["stratified_sample"](spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_kmeans_scoring_is_map_only(spark):
    from sparklab.operators import unsup as us
    df = spark.range(0, 60).selectExpr("id", "cast(id % 7 as double) as a", "cast(id % 5 as double) as b")
    m = us.kmeans_pipeline(["a", "b"], 3, max_iter=5).fit(df)
    p = _plan(us.kmeans_predict(m, df, "id"))
    assert "Exchange" not in p and "Join" not in p
