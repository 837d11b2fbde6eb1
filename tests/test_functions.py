import duckdb
from pyspark.sql import functions as F

from sparklab.functions.core import band, blank_to_null, bool_sum, md5num, regexp_extract_or_null, safe_divide, safe_double
from sparklab.plans.fixtures import md5num_sql


def test_md5num_matches_duckdb_twin(spark):
    keys = ["a", "b", "customer-1", "", "é"]
    got = [r[0] for r in spark.createDataFrame([(k,) for k in keys], "k string").select(md5num("k")).collect()]
    con = duckdb.connect()
    exp = [con.execute(f"SELECT {md5num_sql('?')}", [k]).fetchone()[0] for k in keys]
    assert got == exp
    assert spark.range(1).select(F.pmod(md5num(F.lit("a")), F.lit(1000))).first()[0] == 362


def test_safe_functions_on_edge_values(spark):
    df = spark.createDataFrame([(" 12.5 ", 4, 0), ("", None, 2), ("abc", 3, None), (None, 1, 1), ("\t7", 1, 1)],
                               "s string, a int, b int")
    r = df.select(safe_double("s").alias("x"), safe_divide("a", "b").alias("d"), blank_to_null("s").alias("n")).collect()
    assert [row.x for row in r][:4] == [12.5, 0.0, 0.0, 0.0]
    assert [row.d for row in r][:4] == [None, None, None, 1.0]
    assert r[1].n is None and r[0].n == "12.5"


def test_band_boolsum_regex(spark):
    df = spark.createDataFrame([(3,), (6,), (24,), (25,), (None,)], "t int")
    out = [r[0] for r in df.select(band("t", [(6, "new"), (24, "growing")], "established")).collect()]
    assert out == ["new", "new", "growing", "established", "established"]
    s = spark.range(1).select(bool_sum(F.lit(True), F.lit(None).cast("boolean"), F.lit(True))).first()[0]
    assert s == 2
    x = spark.createDataFrame([("a/b/c.jpg",), ("nofile/",)], "u string").select(regexp_extract_or_null("u", r"([^/]+)$"))
    assert [r[0] for r in x.collect()] == ["c.jpg", None]
