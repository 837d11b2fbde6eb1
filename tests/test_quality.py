import pytest
from pyspark.sql import functions as F

from sparklab.operators import quality as qa


@pytest.fixture(scope="module")
def pair(spark):
    base = spark.createDataFrame([(float(i % 10), "a" if i % 2 else "b") for i in range(200)], "x double, c string")
    test = spark.createDataFrame([(float(i % 10) + (5 if i < 50 else 0), "a" if i % 3 else None) for i in range(200)]
                                 + [(None, "z")], "x double, c string")
    return base, test


def test_jsd_bounds_symmetry_identity(spark, pair):
    base, test = pair
    d1 = qa.js_divergence(base, test, "x").first()["jsd"]
    assert 0.0 <= d1 <= 1.0
    same = qa.js_divergence(base, base, "x").first()["jsd"]
    assert abs(same) < 1e-12
    # symmetric in the distributions when both use the same edges
    d2 = qa.distances(qa.fit_statistics(test.where("x IS NOT NULL"), ["x"], []), base, ["x"], []).first()["value"]
    assert d2 >= 0.0


def test_linf_with_one_sided_and_null_categories(pair):
    base, test = pair
    v = qa.linf_distance(base, test, "c").first()["linf"]
    assert 0.0 < v <= 1.0


def test_validate_skew_ignores_extra_columns_and_flags(pair):
    base, test = pair
    stats = qa.fit_statistics(base, ["x"], ["c"])
    r = {row.input: row for row in qa.validate_skew(stats, test.withColumn("extra", F.lit(1)), ["x"], ["c"],
                                                    overrides={"x": 0.01}).collect()}
    assert set(r) == {"x", "c"}
    assert r["x"].threshold == 0.01 and r["x"].is_anomaly


def test_stats_validate_surfaces_type_mismatch(spark, pair):
    base, _ = pair
    a = qa.stats_blob(qa.fit_statistics(base, ["x"], ["c"]))
    b = qa.stats_blob(qa.fit_statistics(base.withColumn("x", F.col("x").cast("string")), [], ["x", "c"]))
    rows = {r.input: r for r in qa.stats_validate(a, b).collect()}
    assert rows["x"].metric == "TYPE_MISMATCH" and rows["x"].is_anomaly


def test_assert_gate_raises(spark):
    rep = spark.createDataFrame([("x", 0.5, True)], "input string, value double, is_anomaly boolean")
    with pytest.raises(AssertionError):
        qa.assert_gate(rep)
    ok = spark.createDataFrame([("x", 0.1, False)], "input string, value double, is_anomaly boolean")
    qa.assert_gate(ok)
    with pytest.raises(Exception):
        qa.assert_gate_lazy(rep).collect()


def test_dq_scan_nulls_and_ignore_null(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (2, None, "b"), (2, 50.0, None), (4, 7.0, "q")],
                               "k int, v double, s string")
    rules = [{"name": "v_range", "type": "range", "column": "v", "min": 0, "max": 10},
             {"name": "v_range_ign", "type": "range", "column": "v", "min": 0, "max": 10, "ignoreNull": True},
             {"name": "s_set", "type": "set", "column": "s", "values": ["a", "b"], "ignoreNull": True},
             {"name": "k_unique", "type": "uniqueness", "column": "k"},
             {"name": "rows", "type": "tableCondition", "expr": "count(*) = 4"},
             {"name": "no_big", "type": "sqlAssertion", "sql": "SELECT * FROM data WHERE v > 100"}]
    r = {x.rule: x for x in qa.dq_scan(df, rules).collect()}
    assert (r["v_range"].rows_evaluated, r["v_range"].rows_passed) == (4, 2)
    assert (r["v_range_ign"].rows_evaluated, r["v_range_ign"].rows_passed) == (3, 2)
    assert (r["s_set"].rows_evaluated, r["s_set"].rows_passed) == (3, 2)
    assert (r["k_unique"].rows_evaluated, r["k_unique"].rows_passed) == (4, 2)
    assert r["rows"].passed and r["no_big"].passed
    failed = qa.dq_failed_rows(df, rules[0]).select("k").collect()
    assert sorted(x.k for x in failed) == [2, 2]
    scores = {(x.level, x.name): x.score for x in qa.dq_scores(qa.dq_scan(df, rules)).collect()}
    assert 0 <= scores[("job", "all")] <= 100


def test_describe_data_edge_columns(spark):
    df = spark.createDataFrame([(1, None, 3.0, [1, 2]), (1, None, 3.0, None), (1, None, 3.0, [3])],
                               "c int, allnull double, const double, arr array<int>")
    r = {x.column_name: x for x in qa.describe_data(df, top_k=1, exact_unique=True).collect()}
    assert r["allnull"].num_nulls == 3 and r["allnull"].mean is None
    assert r["const"].stddev == 0.0 and r["const"].num_unique == 1
    assert r["arr"].num_nulls == 1 and r["arr"].num_unique is None and r["arr"].min is None
    rules = qa.generate_dq_rules(qa.describe_data(df.select("c", "const"), top_k=3, exact_unique=True))
    assert any(x["type"] == "nonNull" for x in rules)


def test_leakage_null_label_flags(spark):
    rows = [(i, "Yes" if i % 4 == 0 else "No", "r" if i % 4 == 0 else None, float(i)) for i in range(100)]
    df = spark.createDataFrame(rows, "id int, y string, reason string, v double")
    r = {x.column_name: x for x in qa.leakage_null_label(df, F.col("y") == "Yes", ["reason", "v"]).collect()}
    assert r["reason"].suspected_leak and not r["v"].suspected_leak


def test_table_assertions(spark):
    df = spark.createDataFrame([(1, 2), (1, None), (3, -1)], "k int, v int")
    v = qa.table_assertions(df, non_null=["v"], row_conditions=["v > 0"], unique_key=["k"])
    kinds = sorted({r.assertion.split(":")[0] for r in v.collect()})
    assert kinds == ["nonNull", "rowCondition", "uniqueKey"]
    with pytest.raises(AssertionError):
        qa.raise_on_violations(v)


def test_template_rule(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 50.0)], "k int, v double")
    r = qa.dq_scan(df, [{"name": "t", "type": "template", "column": "v", "template": "{column} < {hi}",
                         "params": {"hi": 10}}]).first()
    assert (r.rows_evaluated, r.rows_passed) == (2, 1)


def test_stats_validate_flags_different_bin_edges(spark, pair):
    base, test = pair
    a = qa.stats_blob(qa.fit_statistics(base, ["x"], []))
    b = qa.stats_blob(qa.fit_statistics(test, ["x"], []))  # own edges: not comparable
    r = {x.input: x for x in qa.stats_validate(a, b).collect()}
    assert r["x"].metric == "BIN_EDGE_MISMATCH" and r["x"].is_anomaly
    c = qa.stats_blob(qa.fit_statistics(test, ["x"], [], edges_from=qa.fit_statistics(base, ["x"], [])))
    r2 = {x.input: x for x in qa.stats_validate(a, c).collect()}
    assert r2["x"].metric == "JENSEN_SHANNON_DIVERGENCE"


def test_top_values_count_exactly_without_grouping_by_text(spark):
    import random
    from collections import Counter

    from pyspark.sql import functions as F

    from sparklab.operators.quality import top_values
    r = random.Random(1)
    long = "a long text " * 500
    rows = [(r.choice(["x", "y", "y", None, long, long + "2"]), r.randint(0, 30), k) for k in range(2000)]
    df = spark.createDataFrame(rows, "t string, n int, id int").repartition(5)
    got = {}
    out = top_values(df, ["t", "n", "id"], 4)
    for x in out.collect():
        got.setdefault(x["column_name"], []).append((x["rank"], x["value"], x["count"], x["ratio"]))
    for j, c in enumerate(["t", "n"]):
        count = Counter(str(v[j]) for v in rows if v[j] is not None)
        best = sorted(count.values(), reverse=True)[:4]
        mine = sorted(got[c])
        assert [x[2] for x in mine] == best and [x[0] for x in mine] == [1, 2, 3, 4]
        assert all(count[x[1]] == x[2] and abs(x[3] - x[2] / 2000) < 1e-12 for x in mine)
        assert mine == sorted(mine, key=lambda x: (-x[2], x[1]))
    assert [x[2] for x in got["id"]] == [1] * 4
    assert sorted(x[1] for x in got["id"]) == ["0", "1", "10", "100"]
    out = top_values(df.select("t"), ["t"], 4)
    keys = [line for line in out._jdf.queryExecution().executedPlan().toString().split("\n") if "Exchange hashpartitioning" in line]
    assert keys and not any("value" in k.split("hashpartitioning(")[1].split(")")[0] for k in keys)
    assert top_values(df.where(F.lit(False)), ["t"], 3).count() == 0
