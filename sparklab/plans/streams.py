"""Event-stream queries (batch twins), lineage walks, experiments, object
tables and partition layouts."""

from __future__ import annotations

from pyspark.sql import functions as F

from sparklab.functions.core import md5num
from sparklab.operators import layout
from sparklab.operators import lineage as lg
from sparklab.plans.fixtures import md5num_sql, with_sql
from sparklab.plans.aggregations import EV_SQL
from sparklab.plans.registry import query
from sparklab.sources.tables import Tables
from sparklab.streaming import events as ev

REPLAY_SQL = f"""replayed AS (
  SELECT event_type AS source, event_id AS id, ts, user_id, value, props FROM events
  UNION ALL SELECT event_type, event_id, ts + INTERVAL 5 MINUTE, user_id, value, props FROM events WHERE ts < TIMESTAMP '2024-01-16'
  UNION ALL SELECT event_type, event_id + 1000000000, ts + INTERVAL 7 MINUTE, user_id, value, props FROM events
            WHERE ({md5num_sql('event_id')}) % 100 = 0)"""


def replayed(t):
    """``events`` delivered at least once: the first half replayed with the same
    id (later arrival), 1 % re-sent under a new id (same content)."""
    e = t.events.select(F.col("event_type").alias("source"), F.col("event_id").alias("id"), "ts", "user_id", "value", "props")
    again = e.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")).withColumn(
        "ts", F.col("ts") + F.expr("INTERVAL 5 MINUTES"))
    renamed = e.where(F.pmod(md5num("id"), F.lit(100)) == 0).withColumn("id", F.col("id") + 1_000_000_000).withColumn(
        "ts", F.col("ts") + F.expr("INTERVAL 7 MINUTES"))
    return e.unionByName(again).unionByName(renamed)


@query("dedup_events", sql=with_sql(REPLAY_SQL, """
SELECT source, id, min(ts) AS ts, arg_min(user_id, ts) AS user_id, arg_min(value, ts) AS value, arg_min(props, ts) AS props
FROM replayed GROUP BY source, id"""))
def q_dedup_events(spark, sf):
    return ev.dedup_events(replayed(Tables(spark, sf)), ["source", "id"], "ts")


@query("dedup_key_compare", sql=with_sql(REPLAY_SQL, """
SELECT 'id' AS key_choice, CAST(count(*) AS BIGINT) AS rows, CAST(count(DISTINCT id) AS BIGINT) AS distinct_keys,
       CAST(count(*) - count(DISTINCT id) AS BIGINT) AS would_drop FROM replayed
UNION ALL SELECT 'source+id', count(*), count(DISTINCT (source, id)), count(*) - count(DISTINCT (source, id)) FROM replayed
UNION ALL SELECT 'content_hash', count(*), count(DISTINCT md5(concat_ws('|', source, user_id, value, props))),
       count(*) - count(DISTINCT md5(concat_ws('|', source, user_id, value, props))) FROM replayed"""))
def q_dedup_key_compare(spark, sf):
    r = replayed(Tables(spark, sf))
    content = F.md5(F.concat_ws("|", "source", F.col("user_id").cast("string"), F.col("value").cast("string"), "props"))
    return ev.dedup_key_compare(r, {"id": ["id"], "source+id": ["source", "id"], "content_hash": [content]})


@query("drop_stale", sql="""
SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-30 12:00:00' - INTERVAL 60 MINUTE""")
def q_drop_stale(spark, sf):
    e = Tables(spark, sf).events.select("event_id", "ts")
    return ev.drop_stale(e, "ts", "2024-01-30 12:00:00", 60)


DEBOUNCE_SQL = """
WITH l AS (SELECT user_id, ts, event_id, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev FROM events),
f AS (SELECT *, sum(CASE WHEN prev IS NULL OR ts >= prev + INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
                  OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS s FROM l)
SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end, CAST(count(*) AS BIGINT) AS arrivals
FROM f GROUP BY user_id, s"""


@query("debounce_arrivals", sql=DEBOUNCE_SQL)
def q_debounce_arrivals(spark, sf):
    return ev.sessionize(Tables(spark, sf).events, "user_id", "ts", 30, "event_id")


@query("debounce_stateful", sql=DEBOUNCE_SQL)
def q_debounce_stateful(spark, sf):
    """The same sessions from a stream with timers, every tenth event being sent twice; two later events close all."""
    from sparklab.streaming import stateful
    base = _scratch(spark, "sessions")
    e = Tables(spark, sf).events.select("user_id", "ts", "event_id")
    end = e.agg(F.max("ts").alias("m"))
    last = lambda days: end.select(F.lit(-1).cast("long").alias("user_id"), F.expr(f"m + INTERVAL {days} DAYS").alias("ts"), F.lit(-days).cast("long").alias("event_id"))
    sent = [e.unionAll(e.where(F.col("event_id") % 10 == 0)), last(30), last(60)]
    store = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(store)
    stateful.use_rocksdb(spark)
    try:
        for part in sent:
            part.write.mode("append").parquet(f"{base}/in")
            stream = spark.readStream.schema(e.schema).parquet(f"{base}/in")
            out = stateful.sessions(stream, "user_id", "ts", "event_id", 1800, "1 hour")
            out.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(store, before)
    done = spark.read.parquet(f"{base}/out").where(F.col("user_id") >= 0)
    return done.select("user_id", *(F.col(c).cast("timestamp_ntz").alias(c) for c in ("session_start", "session_end")), "arrivals")


@query("windowed_monitor", sql=f"""
WITH d AS (SELECT date_trunc('day', ts) AS w, * FROM events),
st AS (SELECT w, count(*) AS requests, avg(value) AS avg_latency,
              avg((({md5num_sql('user_id')}) % 1000) / 1000.0) AS avg_score FROM d GROUP BY w),
mix AS (SELECT w, event_type, count(*) / sum(count(*)) OVER (PARTITION BY w) AS q FROM d GROUP BY w, event_type),
base AS (SELECT event_type, count(*) / sum(count(*)) OVER () AS p FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY 1),
cats AS (SELECT event_type FROM mix UNION SELECT event_type FROM base),
g AS (SELECT st.w, c.event_type, coalesce(m.q, 0.0) AS q, coalesce(b.p, 0.0) AS p
      FROM st CROSS JOIN cats c LEFT JOIN mix m ON m.w = st.w AND m.event_type = c.event_type
      LEFT JOIN base b ON b.event_type = c.event_type)
SELECT st.w AS window_start, CAST(st.requests AS BIGINT) AS requests, round(st.avg_latency, 6) AS avg_latency,
       round(st.avg_score, 6) AS avg_score, round(max(abs(g.q - g.p)), 6) AS linf
FROM st JOIN g ON g.w = st.w GROUP BY st.w, st.requests, st.avg_latency, st.avg_score""")
def q_windowed_monitor(spark, sf):
    e = Tables(spark, sf).events
    base = e.where(F.col("ts") < F.lit("2024-01-08").cast("timestamp_ntz"))
    score = F.pmod(md5num("user_id"), F.lit(1000)) / 1000.0
    m = ev.windowed_monitor(e, "ts", "value", score, "event_type", base, "1 day")
    return m.select("window_start", "requests", *[F.round(c, 6).alias(c) for c in ("avg_latency", "avg_score", "linf")])


# ------------------------------------------------------------------ lineage -------------

EDGES_SQL = """edges AS (
  SELECT 'order:' || o_orderkey AS child, 'customer:' || o_custkey AS parent FROM orders
  UNION ALL SELECT 'customer:' || c_custkey, 'nation:' || c_nationkey FROM customer
  UNION ALL SELECT 'nation:' || n_nationkey, 'region:' || n_regionkey FROM nation)"""


def lineage_edges(t):
    """Typed INPUT edges derived from the tables: order <- customer <- nation <- region."""
    o = t.orders.select(F.concat(F.lit("order:"), F.col("o_orderkey").cast("string")).alias("child"),
                        F.concat(F.lit("customer:"), F.col("o_custkey").cast("string")).alias("parent"))
    c = t.customer.select(F.concat(F.lit("customer:"), F.col("c_custkey").cast("string")).alias("child"),
                          F.concat(F.lit("nation:"), F.col("c_nationkey").cast("string")).alias("parent"))
    n = t.nation.select(F.concat(F.lit("nation:"), F.col("n_nationkey").cast("string")).alias("child"),
                        F.concat(F.lit("region:"), F.col("n_regionkey").cast("string")).alias("parent"))
    return o.unionByName(c).unionByName(n)


@query("lineage_upstream", sql=with_sql("RECURSIVE " + EDGES_SQL, """,
up(start, node, depth) AS (
  SELECT child, parent, 1 FROM edges WHERE child LIKE 'order:%'
  UNION ALL SELECT up.start, e.parent, up.depth + 1 FROM up JOIN edges e ON e.child = up.node)
SELECT start, node AS ancestor, CAST(min(depth) AS INTEGER) AS depth FROM up GROUP BY start, node"""))
def q_lineage_upstream(spark, sf):
    t = Tables(spark, sf)
    e = lineage_edges(t)
    starts = e.where(F.col("child").startswith("order:")).select(F.col("child").alias("start")).distinct()
    return lg.upstream(e, starts)


@query("lineage_downstream", sql=with_sql("RECURSIVE " + EDGES_SQL, """,
dn(start, node, depth) AS (
  SELECT parent, child, 1 FROM edges WHERE parent LIKE 'region:%'
  UNION ALL SELECT dn.start, e.child, dn.depth + 1 FROM dn JOIN edges e ON e.parent = dn.node)
SELECT start, node AS descendant, CAST(min(depth) AS INTEGER) AS depth FROM dn GROUP BY start, node"""))
def q_lineage_downstream(spark, sf):
    t = Tables(spark, sf)
    e = lineage_edges(t)
    starts = e.where(F.col("parent").startswith("region:")).select(F.col("parent").alias("start")).distinct()
    return lg.downstream(e, starts)


@query("experiment_table", sql=f"""
SELECT printf('run_%02d', CAST(round(threshold * 100) AS INTEGER)) AS run_id, threshold AS "param.threshold",
       precision AS "metric.precision", recall AS "metric.recall", net_value AS "metric.net_value",
       net_value = max(net_value) OVER () AS is_best
FROM ({EV_SQL}) ev""")
def q_experiment_table(spark, sf):
    """Threshold runs over the stored scores as an experiment log (long:
    run, kind, name, value) pivoted wide; the best run by net value flagged."""
    from sparklab.operators import aggs
    from sparklab.plans.fixtures import churn_scores
    s = churn_scores(Tables(spark, sf))
    ev_ = aggs.expected_value_curve(s, "p_churn", F.col("actual_churn") == "Yes", "monthly_charges",
                                    aggs.threshold_grid(spark, 10, 90, 5))
    run = F.format_string("run_%02d", F.round(F.col("threshold") * 100).cast("int"))
    long = ev_.select(run.alias("run_id"), F.inline(F.array(
        F.struct(F.lit("param").alias("kind"), F.lit("threshold").alias("name"), F.col("threshold").alias("value")),
        F.struct(F.lit("metric").alias("kind"), F.lit("precision").alias("name"), F.col("precision").alias("value")),
        F.struct(F.lit("metric").alias("kind"), F.lit("recall").alias("name"), F.col("recall").alias("value")),
        F.struct(F.lit("metric").alias("kind"), F.lit("net_value").alias("name"), F.col("net_value").alias("value")))))
    wide = lg.experiment_table(long, names=["param.threshold", "metric.precision", "metric.recall", "metric.net_value"])
    best = wide.agg(F.max("`metric.net_value`").alias("_best"))
    return wide.crossJoin(best).withColumn("is_best", F.col("`metric.net_value`") == F.col("_best")).drop("_best")


# ------------------------------------------------------------------ objects & layout ----

@query("object_inventory", sql="""
SELECT CAST(count(*) AS BIGINT) AS objects,
       CAST(count(DISTINCT 'text/html; lang=' || regexp_extract(html, '<html lang="([a-z]+)"', 1)) AS BIGINT) AS content_types,
       round(sum(octet_length(encode(html))) / 1024 / 1024, 6) AS total_mb FROM pages""")
def q_object_inventory(spark, sf):
    from sparklab.sources.io import object_inventory
    p = Tables(spark, sf).pages
    objs = p.select(F.col("url").alias("uri"),
                    F.concat(F.lit("text/html; lang="), F.regexp_extract("html", r'<html lang="([a-z]+)"', 1)).alias("content_type"),
                    F.octet_length("html").cast("long").alias("size"))
    return object_inventory(objs)


@query("partition_by_trunc", sql="""
SELECT date_trunc('hour', ts) AS bucket, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1""")
def q_partition_by_trunc(spark, sf):
    e = Tables(spark, sf).events
    bucket = layout.trunc_bucket("ts", "hour").cast("timestamp_ntz")
    return e.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("partition_by_int_range", sql="""
SELECT CASE WHEN p_size IS NULL THEN '__NULL__' WHEN p_size < 0 OR p_size >= 40 THEN '__UNPARTITIONED__'
            ELSE CAST(CAST(floor(p_size / 10) * 10 AS BIGINT) AS VARCHAR) END AS partition_id, CAST(count(*) AS BIGINT) AS n
FROM part GROUP BY 1""")
def q_partition_by_int_range(spark, sf):
    p = Tables(spark, sf).part
    return p.groupBy(layout.int_range_bucket("p_size", 0, 40, 10).alias("partition_id")).agg(F.count(F.lit(1)).alias("n"))


def _scratch(spark, name):
    from sparklab.session import ensure_checkpoint_dir
    import uuid
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query("partition_by_date", sql="SELECT CAST(ts AS DATE) AS d, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1")
def q_partition_by_date(spark, sf):
    """Write ``events`` with daily partitions (to the shared checkpoint folder)
    and read one day back: partition pruning shows as PartitionFilters."""
    path = _scratch(spark, "events-by-day")
    e = layout.with_date_partition(Tables(spark, sf).events, "ts", "d")
    layout.write_partitioned(e, path, ["d"], cluster_cols=["user_id"])
    return spark.read.parquet(path).groupBy("d").agg(F.count(F.lit(1)).alias("n"))


@query("export_parquet", sql="SELECT * FROM lineitem WHERE year(l_shipdate) = 1996")
def q_export_parquet(spark, sf):
    from sparklab.sources.io import export_parquet
    path = _scratch(spark, "lineitem-1996")
    li = Tables(spark, sf).lineitem.where(F.year("l_shipdate") == 1996)
    export_parquet(li, path)
    return spark.read.parquet(path)


@query("cluster_layout")
def q_cluster_layout(spark, sf):
    """Orders range-partitioned and sorted by date: per output file, the
    min/max date ranges do not overlap (what row-group pruning needs)."""
    path = _scratch(spark, "orders-clustered")
    layout.cluster_layout(Tables(spark, sf).orders, ["o_orderdate", "o_custkey"], 8).write.parquet(path)
    r = spark.read.parquet(path).withColumn("file", F.input_file_name())
    return r.groupBy("file").agg(F.min("o_orderdate").alias("min_date"), F.max("o_orderdate").alias("max_date"),
                                 F.count(F.lit(1)).alias("n")).drop("file")
