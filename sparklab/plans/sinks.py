"""Source, sink, layout and stream keys as round trips over the fixture tables.

Each query writes what the operator produces into a fresh folder under the
session's shared checkpoint folder (``spark.checkpoint.dir``) and returns what
reading it back gives, so the rows checked are the rows that landed."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import layout
from sparklab.operators import quality as qa
from sparklab.plans.fixtures import SCORES_SQL, md5num_sql, with_sql
from sparklab.plans.quality import DQ_SQL
from sparklab.plans.registry import query
from sparklab.plans.text import FINDINGS_SQL, SENT_SQL
from sparklab.session import ensure_checkpoint_dir
from sparklab.sources import io
from sparklab.sources.tables import Tables
from sparklab.streaming import events as ev


def scratch(spark, name: str) -> str:
    return os.path.join(ensure_checkpoint_dir(spark).replace("file:", ""), f"{name}-{uuid.uuid4().hex}")


@query("load_csv_declared", sql=f"""
SELECT CAST(count(*) AS BIGINT) AS rows_loaded, CAST(count_if(c_name IS NULL OR trim(c_name) = '') AS BIGINT) AS blank_text,
       CAST(count_if(({md5num_sql('c_custkey')}) % 50 = 1) AS BIGINT) AS uncastable_acctbal_text FROM customer""")
def q_load_csv_declared(spark, sf):
    """``customer`` exported as CSV with a dirty numeric text column (blank or
    'n/a' for some keys), loaded back with a declared schema: the dirty column
    stays STRING and the audit counts what does not cast."""
    c = Tables(spark, sf).customer
    h = F.pmod(md5num("c_custkey"), F.lit(50))
    dirty = F.when(h == 0, F.lit(" ")).when(h == 1, F.lit("n/a")).otherwise(F.col("c_acctbal").cast("string"))
    path = scratch(spark, "customer-csv")
    c.select("c_custkey", "c_name", dirty.alias("acctbal_text"), "c_mktsegment").write.option("header", True).csv(path)
    df = io.load_csv(spark, path, "c_custkey BIGINT, c_name STRING, acctbal_text STRING, c_mktsegment STRING")
    from sparklab.operators.clean import load_audit
    return load_audit(df, "c_name", ["acctbal_text"])


def _page_files(spark, sf):
    p = Tables(spark, sf).pages
    path = scratch(spark, "pages-files")
    p.select(F.pmod("page_id", F.lit(8)).alias("shard"), "html").write.partitionBy("shard").text(path)
    return path


@query("object_table")
def q_object_table(spark, sf):
    """One row per file (metadata only: the bytes are not read)."""
    return io.object_table(spark, _page_files(spark, sf), glob="*.txt").select("uri", "content_type", "size")


@query("read_uri_list")
def q_read_uri_list(spark, sf):
    path = _page_files(spark, sf)
    objs = io.object_table(spark, path, glob="*.txt")
    lst = scratch(spark, "uri-list")
    objs.select("uri").write.text(lst)
    return io.read_uri_list(spark, lst).select("path", "length", F.md5("content").alias("md5_hash"), "error")


@query("row_group_sample")
def q_row_group_sample(spark, sf):
    """A fifth of the blocks of the line items (written in small row groups first): only those are read."""
    path = scratch(spark, "lineitem-groups")
    # files of bounded size, as many as the rows need: a footer lists all groups of its file
    Tables(spark, sf).lineitem.repartition("l_orderkey").write.option("maxRecordsPerFile", 500_000).option("parquet.block.size", 64 * 1024).option("parquet.page.size", 8 * 1024).parquet(path)
    return io.row_group_sample(spark, path, 0.2, columns=["l_orderkey", "l_linenumber", "l_quantity", "l_shipdate"])


@query("read_jsonl_batch", sql="SELECT doc_id, lang, text FROM documents")
def q_read_jsonl_batch(spark, sf):
    path = scratch(spark, "docs-jsonl")
    Tables(spark, sf).documents.select("doc_id", "lang", "text").write.json(path)
    return io.read_jsonl_batch(spark, path, "doc_id BIGINT, lang STRING, text STRING")


@query("read_csv_batch", sql="SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def q_read_csv_batch(spark, sf):
    path = scratch(spark, "orders-csv")
    Tables(spark, sf).orders.select("o_orderkey", "o_custkey", "o_totalprice").write.option("header", True).csv(path)
    return io.read_csv_batch(spark, path, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE")


@query("export_jsonl", sql=with_sql(SCORES_SQL, "SELECT c_custkey, p_churn, actual_churn FROM scores"))
def q_export_jsonl(spark, sf):
    from sparklab.plans.fixtures import churn_scores
    s = churn_scores(Tables(spark, sf)).select("c_custkey", "p_churn", "actual_churn")
    path = scratch(spark, "scores-jsonl")
    io.export_jsonl(s, path, compression="gzip")
    return spark.read.schema("c_custkey BIGINT, p_churn DOUBLE, actual_churn STRING").json(path)


@query("ctas", sql="SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def q_ctas(spark, sf):
    """CREATE OR REPLACE TABLE ... AS SELECT on a path: a new version folder per
    run, readers see the current one; run twice, the table holds one copy."""
    path = scratch(spark, "ctas")
    sel = Tables(spark, sf).orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_totalprice")
    io.replace_table(sel, path)
    io.replace_table(sel, path)
    return io.read_table(spark, path)


@query("write_truncate_result", sql="""
SELECT CAST(ts AS DATE) AS day, CAST(count(*) AS BIGINT) AS n, round(avg(value), 4) AS avg_value,
       CAST(count(DISTINCT user_id) AS BIGINT) AS distinct_user_id FROM events GROUP BY 1""")
def q_write_truncate_result(spark, sf):
    from sparklab.operators.aggs import daily_rollup
    path = scratch(spark, "daily")
    r = daily_rollup(Tables(spark, sf).events, "ts", "value", "user_id")
    io.write_truncate(r, path)
    io.write_truncate(r, path)  # truncate disposition: still one copy
    return spark.read.parquet(path)


@query("ingestion_time_partition")
def q_ingestion_time_partition(spark, sf):
    e = layout.ingestion_time(Tables(spark, sf).events, "2024-02-01 03:15:00", "day")
    path = scratch(spark, "ingest")
    e.write.partitionBy("_PARTITIONTIME").parquet(path)
    return spark.read.parquet(path).groupBy("_PARTITIONTIME").agg(F.count(F.lit(1)).alias("n"))


def _events_by_day(spark, sf):
    path = scratch(spark, "events-days")
    e = layout.with_date_partition(Tables(spark, sf).events, "ts", "d")
    layout.write_partitioned(e, path, ["d"])
    return path, e


@query("expire_partitions", sql="""
SELECT DISTINCT CAST(ts AS DATE) AS d FROM events WHERE CAST(ts AS DATE) < DATE '2024-01-31' - 14""")
def q_expire_partitions(spark, sf):
    """Dry run: the daily partitions older than 14 days before 2024-01-31."""
    path, _ = _events_by_day(spark, sf)
    return layout.expire_partitions(spark, path, "d", "2024-01-31", 14, dry_run=True)


@query("partition_limits", sql="""
SELECT CAST(count(DISTINCT CAST(ts AS DATE)) AS INTEGER) AS partitions, 10000 AS table_limit, 4000 AS job_limit,
       count(DISTINCT CAST(ts AS DATE)) <= 4000 AS within_job_limit FROM events""")
def q_partition_limits(spark, sf):
    e = layout.with_date_partition(Tables(spark, sf).events, "ts", "d")
    n = layout.partition_count_guard(e, ["d"], 10_000)
    return spark.createDataFrame([(n, 10_000, 4_000, n <= 4_000)],
                                 "partitions int, table_limit int, job_limit int, within_job_limit boolean")


@query("partition_overwrite_by_input", sql="""
SELECT CAST(ts AS DATE) AS d, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def q_partition_overwrite_by_input(spark, sf):
    """Two runs over the same input days overwrite those days instead of appending."""
    path, e = _events_by_day(spark, sf)
    late = e.where(F.col("d") >= F.lit("2024-01-25").cast("date"))
    ev.overwrite_partitions(late, path, ["d"])
    ev.overwrite_partitions(late, path, ["d"])
    return spark.read.parquet(path).groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@query("atomic_claim_sink", sql="""
SELECT 0 AS batch_id, CAST(count(*) AS BIGINT) AS n FROM events WHERE ts < TIMESTAMP '2024-01-16'
UNION ALL SELECT 1, count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-16'""")
def q_atomic_claim_sink(spark, sf):
    """Micro-batches written by batch id; batch 0 is delivered twice (a replay)
    and must not double."""
    e = Tables(spark, sf).events
    out = scratch(spark, "claims")
    w = ev.atomic_claim_writer(out)
    first = e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz"))
    w(first, 0)
    w(first, 0)
    w(e.where(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")), 1)
    return spark.read.parquet(out).groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"))


@query("sentinel_batch", sql="""
SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events WHERE event_type = 'click' GROUP BY 1""")
def q_sentinel_batch(spark, sf):
    """Only folders holding ``_SUCCESS`` are processed."""
    root = scratch(spark, "landing")
    e = Tables(spark, sf).events
    e.where(F.col("event_type") == "click").write.parquet(os.path.join(root, "click"))
    e.where(F.col("event_type") == "view").write.parquet(os.path.join(root, "view"))
    marker = os.path.join(root, "view", "_SUCCESS")
    if os.path.exists(marker):
        os.remove(marker)  # an incomplete delivery (local folder in this fixture)
    return ev.read_complete(spark, root).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("path_filter", sql="SELECT * FROM events WHERE value >= 10")
def q_path_filter(spark, sf):
    """Handle only ``validated/*.parquet``."""
    root = scratch(spark, "incoming")
    e = Tables(spark, sf).events
    e.where(F.col("value") >= 10).write.parquet(os.path.join(root, "validated"))
    e.where(F.col("value") < 10).write.parquet(os.path.join(root, "quarantine"))
    return spark.read.option("pathGlobFilter", "*.parquet").parquet(os.path.join(root, "validated"))


@query("batch_on_schedule", sql="SELECT event_id, user_id, event_type, value FROM events")
def q_batch_on_schedule(spark, sf):
    """Accumulate, then process what arrived: two ``availableNow`` runs over a
    growing folder; the checkpoint makes the second pick up only new files."""
    src, sink, ck = scratch(spark, "sched-src"), scratch(spark, "sched-sink"), scratch(spark, "sched-ck")
    e = Tables(spark, sf).events.select("event_id", "user_id", "event_type", "value")
    e.where(F.col("event_id") % 2 == 0).write.parquet(os.path.join(src, "a"))
    stream = lambda: spark.readStream.schema(e.schema).option("recursiveFileLookup", "true").parquet(src)
    ev.run_available_now(stream(), sink, ck)
    e.where(F.col("event_id") % 2 == 1).write.parquet(os.path.join(src, "b"))
    ev.run_available_now(stream(), sink, ck)
    return spark.read.parquet(sink)


@query("findings_stream", sql=with_sql(FINDINGS_SQL, "SELECT doc_id, info_type, quote, likelihood FROM findings"))
def q_findings_stream(spark, sf):
    """Sensitive-data findings available while the job runs (append mode)."""
    from sparklab.operators.privacy import inspect_infotypes
    src, sink, ck = scratch(spark, "docs-in"), scratch(spark, "findings"), scratch(spark, "findings-ck")
    d = Tables(spark, sf).documents.select("doc_id", "text")
    d.write.parquet(src)
    s = spark.readStream.schema(d.schema).parquet(src)
    ev.run_available_now(inspect_infotypes(s, "doc_id", "text"), sink, ck)
    return spark.read.parquet(sink)


@query("dq_results_sink", sql=f"""
SELECT r.*, j.job_date FROM ({DQ_SQL}) r, (VALUES (DATE '2024-02-01'), (DATE '2024-02-02')) j(job_date)""")
def q_dq_results_sink(spark, sf):
    """Rule results appended, partitioned by the day the job started."""
    from sparklab.plans.quality import DQ_RULES
    path = scratch(spark, "dq-results")
    for start in ("2024-02-01 01:00:00", "2024-02-02 01:00:00"):
        r = qa.dq_scan(Tables(spark, sf).customer, DQ_RULES).withColumn(
            "job_date", F.to_date(F.lit(start).cast("timestamp")))
        r.write.mode("append").partitionBy("job_date").parquet(path)
    return spark.read.parquet(path)


@query("assert_gate")
def q_assert_gate(spark, sf):
    """The gate as a lazy one-row frame: evaluating it raises when the report
    has an anomaly (here the thresholds let the halves of ``events`` pass)."""
    from sparklab.plans.quality import event_halves
    b, t = event_halves(Tables(spark, sf))
    rep = qa.validate_drift(b, t, ["value"], ["event_type"], default=0.9)
    return qa.assert_gate_lazy(rep, "drift above threshold")


@query("merge_repair", sql=with_sql(SENT_SQL, "SELECT doc_id, sentiment, confidence, '' AS status FROM scored"))
def q_merge_repair(spark, sf):
    """Rows whose first score failed take the re-scored values; others keep theirs."""
    from sparklab.operators.windows import merge_repair
    from sparklab.plans.text import lexicon_scored
    s = lexicon_scored(Tables(spark, sf))
    failed_first = s.withColumn("status", F.when(F.col("doc_id") % 5 == 0, F.lit("error: timeout")).otherwise(F.lit(""))) \
                    .withColumn("sentiment", F.when(F.col("status") != "", F.lit(None)).otherwise(F.col("sentiment")))
    rescored = s.join(failed_first.where(F.col("status") != "").select("doc_id"), "doc_id")
    return merge_repair(failed_first, rescored, "doc_id", F.col("status") != "", ["sentiment", "confidence", "status"])


@query("percent_rank_frozen")
def q_percent_rank_frozen(spark, sf):
    """Percentile within the segment as served: the peer distribution is frozen
    at training time as 101 cut points per segment (a mergeable quantile
    sketch); scoring looks a value up in its segment's cut array — the small
    cut table (segments x 101) is broadcast, rows never shuffle."""
    c = Tables(spark, sf).customer
    train = c.where(F.pmod(md5num("c_custkey"), F.lit(10)) < 8)
    cuts = train.groupBy("c_mktsegment").agg(
        F.percentile_approx("c_acctbal", [i / 100 for i in range(101)], 10_000).alias("cuts"))
    j = c.join(F.broadcast(cuts), "c_mktsegment", "left")
    pos = F.size(F.filter("cuts", lambda q: q <= F.col("c_acctbal"))) - 1
    return j.select("c_custkey", "c_mktsegment", (F.greatest(pos, F.lit(0)) / 100.0).alias("balance_pctile"))


