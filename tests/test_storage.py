import os

import pytest
from pyspark.sql import functions as F

from sparklab.operators import layout
from sparklab.operators import windows as win
from sparklab.sources import io
from tests.conftest import SF001


def test_load_csv_declared_keeps_dirty_numerics(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "c.csv")
    with open(p, "w") as f:
        f.write('id,total,note\n1,12.5,"multi\nline"\n2, ,x\n3,abc,y\n')
    df = io.load_csv(spark, p, "id INT, total STRING, note STRING", multiline=True)
    assert df.schema["total"].dataType.simpleString() == "string"
    from sparklab.operators.clean import load_audit
    a = load_audit(df, "note", ["total"]).first()
    assert a.rows_loaded == 3 and a.uncastable_total == 2


def test_load_csv_default_reads_line_by_line(spark, tmpdir_path):
    p = os.path.join(tmpdir_path, "c.csv")
    with open(p, "w") as f:
        f.write('id,total,note\n1,12.5,"a, b"\n2, ,x\n3,abc,y\n')
    rows = io.load_csv(spark, p, "id INT, total STRING, note STRING").orderBy("id").collect()
    assert [(r.id, r.total, r.note) for r in rows] == [(1, "12.5", "a, b"), (2, " ", "x"), (3, "abc", "y")]
    with open(p, "w") as f:
        f.write('id,total,note\n1,2,"multi\nline"\n')
    assert io.load_csv(spark, p, "id INT, total STRING, note STRING").count() == 2


def test_object_table_metadata_only(spark, tmpdir_path):
    d = os.path.join(tmpdir_path, "obj")
    os.makedirs(d)
    for i in range(3):
        with open(os.path.join(d, f"p{i}.html"), "w") as f:
            f.write("<html>" + "x" * i + "</html>")
    with open(os.path.join(d, "skip.txt"), "w") as f:
        f.write("no")
    o = io.object_table(spark, d, glob="*.html")
    assert o.count() == 3 and set(o.columns) == {"uri", "content_type", "size", "updated"}
    inv = io.object_inventory(o).first()
    assert inv.objects == 3 and inv.content_types == 1
    assert "content" not in o._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1][:60]


def test_exports_round_trip(spark, tmpdir_path):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet").where(F.year("l_shipdate") == 1996)
    io.export_parquet(li, tmpdir_path + "/p")
    io.export_parquet(li, tmpdir_path + "/p")  # overwrite, not append
    assert spark.read.parquet(tmpdir_path + "/p").count() == li.count()
    io.export_jsonl(li.select("l_orderkey", "l_quantity"), tmpdir_path + "/j")
    assert spark.read.json(tmpdir_path + "/j").count() == li.count()
    v = io.replace_table(li.select("l_orderkey"), tmpdir_path + "/t")
    v2 = io.replace_table(li.select("l_orderkey").limit(3), tmpdir_path + "/t")
    assert v != v2 and io.read_table(spark, tmpdir_path + "/t").count() == 3


def test_partition_by_date_pruning_and_overwrite(spark, tmpdir_path):
    e = layout.with_date_partition(spark.read.parquet(f"{SF001}/events.parquet"), "ts", "d")
    path = tmpdir_path + "/ev"
    layout.write_partitioned(e, path, ["d"], cluster_cols=["user_id"])
    one_day = e.where(F.col("d") == "2024-01-02")
    layout.write_partitioned(one_day, path, ["d"])  # dynamic overwrite: other days untouched
    r = spark.read.parquet(path)
    assert r.count() == e.count()
    plan = r.where(F.col("d") == F.lit("2024-01-03").cast("date"))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(d" in plan
    with pytest.raises(ValueError):
        layout.write_partitioned(e, tmpdir_path + "/ev2", ["d"], max_partitions=5)
    old = layout.partitions_to_expire(spark, path, "d", "2024-01-31", 20)
    assert old.count() == 10


def test_int_range_bucket_special_partitions(spark):
    df = spark.createDataFrame([(None,), (-1,), (0,), (15,), (40,)], "x int")
    got = [r[0] for r in df.select(layout.int_range_bucket("x", 0, 40, 10)).collect()]
    assert got == ["__NULL__", "__UNPARTITIONED__", "0", "10", "__UNPARTITIONED__"]


def test_ingestion_time(spark):
    r = layout.ingestion_time(spark.range(2), "2024-05-06 13:14:15").first()
    assert str(r["_PARTITIONTIME"]).startswith("2024-05-06 00:00:00")


def test_merge_upsert_idempotent_and_persisted(spark, tmpdir_path):
    tgt = spark.createDataFrame([("2024-01-01", 1, 0.1), ("2024-01-01", 2, 0.2), ("2024-01-02", 1, 0.3)],
                                "d string, k int, p double")
    src = spark.createDataFrame([("2024-01-01", 2, 0.9), ("2024-01-01", 3, 0.5)], "d string, k int, p double")
    once = win.merge_upsert(tgt, src, ["d", "k"])
    twice = win.merge_upsert(once, src, ["d", "k"])
    assert sorted(once.collect()) == sorted(twice.collect())
    path = tmpdir_path + "/hist"
    win.write_merged(spark, path, tgt, ["d", "k"], "d")
    win.write_merged(spark, path, src, ["d", "k"], "d")
    win.write_merged(spark, path, src, ["d", "k"], "d")
    got = sorted((r.d, r.k, r.p) for r in spark.read.parquet(path).collect())
    assert [x for x in got if str(x[0]) == "2024-01-01"] and len(got) == 4
    dup = spark.createDataFrame([("2024-01-01", 2, 0.9), ("2024-01-01", 2, 0.8)], "d string, k int, p double")
    with pytest.raises(Exception):
        win.assert_unique_source(dup, ["d", "k"]).collect()


def test_cluster_layout_ranges_do_not_overlap(spark, tmpdir_path):
    o = spark.read.parquet(f"{SF001}/orders.parquet")
    layout.cluster_layout(o, ["o_orderdate"], 4).write.parquet(tmpdir_path + "/o")
    r = (spark.read.parquet(tmpdir_path + "/o").withColumn("f", F.input_file_name()).groupBy("f")
         .agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi")).orderBy("lo").collect())
    for a, b in zip(r, r[1:]):
        assert a.hi <= b.lo


def test_block_and_hash_samples(spark):
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    b = win.block_sample(li, 0.5, block_rows=100).count()
    assert 0 < b < li.count()
    h1 = win.hash_sample(li, "l_orderkey", 10).count()
    assert h1 == win.hash_sample(li, "l_orderkey", 10).count()


def test_uri_list_is_read_by_tasks_and_failures_are_rows(spark, tmpdir_path):
    want = {}
    for k in range(6):
        p = os.path.join(tmpdir_path, f"f {k}.bin")
        with open(p, "wb") as f:
            f.write(bytes(range(k * 40)))
        want[f"file:{p}" if k % 2 else f"file://{p}"] = bytes(range(k * 40))
    lists = os.path.join(tmpdir_path, "lists")
    os.makedirs(lists)
    for k, part in enumerate([list(want)[:3], list(want)[3:] + ["", "file:/no/such/file", "odd"]]):
        with open(os.path.join(lists, f"{k}.txt"), "w") as f:
            f.write("\n".join(part))
    got = {r["path"]: r for r in io.read_uri_list(spark, lists).collect()}
    assert {p: bytes(r["content"]) for p, r in got.items() if r["error"] is None} == want
    assert all(r["length"] == len(want[p]) and r["modificationTime"] is not None for p, r in got.items() if p in want)
    bad = {p: r for p, r in got.items() if p not in want}
    assert set(bad) == {"file:/no/such/file", "odd"} and all(r["error"] and r["content"] is None and r["length"] is None for r in bad.values())
    os.makedirs(os.path.join(tmpdir_path, "none"))
    assert io.read_uri_list(spark, os.path.join(tmpdir_path, "none")).count() == 0


def test_row_groups_are_sampled_whole(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "t")
    d = spark.range(0, 40_000, 1, 4).select("id", F.concat(F.lit("v"), F.col("id").cast("string")).alias("s"), F.timestamp_seconds(F.col("id")).cast("timestamp_ntz").alias("t"))
    d.write.option("parquet.block.size", 16 * 1024).option("parquet.page.size", 4096).option("parquet.block.size.row.check.min", 100).parquet(path)
    groups = io.row_groups(spark, path).collect()
    assert sum(g["n_rows"] for g in groups) == 40_000 and len(groups) > 8
    assert sorted(r["id"] for r in io.row_group_sample(spark, path, 1.0).collect()) == list(range(40_000))
    some = io.row_group_sample(spark, path, 0.4, seed=3, columns=["s", "t"])
    assert some.columns == ["s", "t"] and [f.dataType.simpleString() for f in some.schema] == ["string", "timestamp_ntz"]
    rows = some.collect()
    assert rows == io.row_group_sample(spark, path, 0.4, seed=3, columns=["s", "t"]).collect() or sorted(rows) == sorted(io.row_group_sample(spark, path, 0.4, seed=3, columns=["s", "t"]).collect())
    assert 0 < len(rows) < 40_000 and io.row_group_sample(spark, path, 0.0).count() == 0
    # what is kept are whole groups
    sizes = [g["n_rows"] for g in groups]
    reachable = {0}
    for n in sizes:
        reachable |= {x + n for x in reachable}
    assert len(rows) in reachable


def test_partitions_expire_on_the_file_system(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "p")
    d = spark.createDataFrame([(k, f"2024-01-{k:02d}") for k in range(1, 11)] + [(99, None)], "id int, d string").withColumn("d", F.to_date("d"))
    d.write.partitionBy("d").parquet(path)
    gone = layout.expire_partitions(spark, path, "d", "2024-01-10", 4, dry_run=False)
    assert sorted(r["d"].day for r in gone.collect()) == [1, 2, 3, 4, 5]
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [6, 7, 8, 9, 10, 99]
    assert layout.expire_partitions(spark, path, "d", "2024-01-10", 4, dry_run=False).count() == 0
