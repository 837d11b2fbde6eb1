"""At-least-once event handling: de-duplication, staleness, debouncing,
windowed monitoring and idempotent sinks — each with a batch twin (the oracle
for a drained stream) and a Structured Streaming form."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklab.operators import ranking


# ------------------------------------------------------------------ de-duplication ---

def dedup_events(df: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Batch twin: one row per event id (``keys``), the earliest arrival kept.
    ``min_by`` is a partial aggregate, so a replay storm of one id is combined
    map-side instead of piling into one task."""
    others = [c for c in df.columns if c not in keys]
    pick = F.min_by(F.struct(*others), F.struct(F.col(ts), *[F.col(c) for c in others if c != ts]))
    return df.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*")


def dedup_events_stream(stream: DataFrame, keys: list[str], ts: str, ttl: str = "1 hour") -> DataFrame:
    """Streaming: idempotent by event id with the de-dup window as TTL
    (state for an id is dropped once the watermark passes ``ts + ttl``)."""
    return stream.withWatermark(ts, ttl).dropDuplicatesWithinWatermark(keys)


def dedup_key_compare(df: DataFrame, candidates: dict[str, list]) -> DataFrame:
    """What each key choice would drop: rows, distinct keys, rows dropped."""
    out = None
    for name, cols in candidates.items():
        k = F.struct(*[F.col(c) if isinstance(c, str) else c for c in cols])
        one = df.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(k).alias("distinct_keys")).select(
            F.lit(name).alias("key_choice"), "rows", "distinct_keys",
            (F.col("rows") - F.col("distinct_keys")).alias("would_drop"))
        out = one if out is None else out.unionByName(one)
    return out


def drop_stale(df: DataFrame, ts: str, now, max_age_minutes: int = 60) -> DataFrame:
    """Discard events older than ``max_age`` relative to a given ``now`` (the
    end condition for retries); the bound is pushed to the scan."""
    lo = F.lit(str(now)).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(max_age_minutes)} MINUTES")
    return df.where(F.col(ts) >= lo)


# ------------------------------------------------------------------ sessions ---------

def distributed_lag(df: DataFrame, key: list[str], order: list[str], value: str, out: str,
                    n_parts: int | None = None) -> DataFrame:
    """``LAG(value) OVER (PARTITION BY key ORDER BY order)`` without sending a
    whole key to one task: rows are range-partitioned on (key, order); inside a
    partition the lag is local; the first row of each slice takes the last
    value of the same key from the previous slice (a table of one row per
    (partition, key) slice)."""
    r = ranking.range_slices(df, [F.col(c) for c in key + order], n_parts)
    w = Window.partitionBy("_pid", *key).orderBy(*order)
    local = r.withColumn("_lag", F.lag(value).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    last = r.groupBy("_pid", *key).agg(F.max_by(F.col(value), F.struct(*[F.col(c) for c in order])).alias("_last"))
    ws = Window.partitionBy(*key).orderBy("_pid")
    # one row per (range partition, key) slice: bounded by partitions + keys
    prev = last.withColumn("_prev_slice", F.lag("_last").over(ws)).drop("_last")
    j = ranking._join_back(local, prev, ["_pid", *key])
    return (j.withColumn(out, F.when(F.col("_first"), F.col("_prev_slice")).otherwise(F.col("_lag")))
             .drop("_pid", "_lag", "_prev_slice", "_first"))


def sessionize(df: DataFrame, key: str, ts: str, gap_minutes: int, tiebreak: str) -> DataFrame:
    """Sessions per key: a new session starts when the gap to the previous event
    is at least ``gap``; returns (key, session_start, session_end, arrivals)
    with ``session_end`` = last event + gap (session-window semantics)."""
    lagged = distributed_lag(df.select(key, ts, tiebreak), [key], [ts, tiebreak], ts, "_prev_ts")
    gap = F.expr(f"INTERVAL {int(gap_minutes)} MINUTES")
    new = (F.col("_prev_ts").isNull() | (F.col(ts) >= F.col("_prev_ts") + gap)).cast("long")
    flagged = lagged.withColumn("_new", new)
    s = ranking.prefix_sum(flagged, [key], [ts, tiebreak], "_new", "_session", inclusive=True)
    return s.groupBy(key, "_session").agg(F.min(ts).alias("session_start"), (F.max(ts) + gap).alias("session_end"),
                                         F.count(F.lit(1)).alias("arrivals")).drop("_session")


def debounce_stream(stream: DataFrame, key: str, ts: str, gap: str = "30 minutes", watermark: str = "1 hour"):
    """Streaming: 50 arrivals -> 1 run after a quiet period (``session_window``)."""
    s = stream.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", watermark)
    return s.groupBy(key, F.session_window("_ts", gap).alias("w")).agg(F.count(F.lit(1)).alias("arrivals")).select(
        key, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "arrivals")


# ------------------------------------------------------------------ monitoring -------

def linf_by_window(share: DataFrame, baseline: DataFrame, category: str) -> DataFrame:
    """Largest distance between a window's category shares (_w, category, q) and the baseline's (category, p), a category
    that one side lacks having the share 0 there.

    No window x category grid: of the categories a window lacks only the most common one of the baseline counts, and that
    is the first gap in the baseline ranks of those it has."""
    r = ranking.row_number(baseline, [], [F.desc("p"), F.col(category)], "_rank")
    r = r.select(F.col(category).alias("_cat"), "p", "_rank")
    j = share.join(r, F.col(category).eqNullSafe(F.col("_cat")), "left")
    w = Window.partitionBy("_w").orderBy(F.col("_rank").asc_nulls_last())
    # ranks are in place up to the first category that the window lacks
    j = j.withColumn("_place", F.row_number().over(w))
    g = j.groupBy("_w").agg(F.max(F.abs(F.col("q") - F.coalesce("p", F.lit(0.0)))).alias("_d"),
                            (F.coalesce(F.sum(F.when(F.col("_rank") == F.col("_place"), 1)), F.lit(0)) + 1).alias("_gap"))
    absent = r.select(F.col("_rank").alias("_gap"), F.col("p").alias("_absent"))
    return g.join(absent, "_gap", "left").select("_w", F.greatest("_d", F.coalesce("_absent", F.lit(0.0))).alias("linf"))


def windowed_monitor(df: DataFrame, ts: str, value: str, score: Column, category: str, baseline: DataFrame,
                     window: str = "1 day", slide: str | None = None) -> DataFrame:
    """Per tumbling window (or sliding, with ``slide``, for smoothing): requests,
    mean latency, mean score, and L-infinity drift of the category mix against
    a baseline (small share table)."""
    if slide:  # a row belongs to every window that covers it
        d = df.withColumn("_w", F.window(F.col(ts).cast("timestamp"), window, slide).start.cast("timestamp_ntz"))
    elif window == "1 day":  # calendar days of the wall-clock timestamp
        d = df.withColumn("_w", F.date_trunc("day", F.col(ts)).cast("timestamp_ntz"))
    else:
        d = df.withColumn("_w", F.window(F.col(ts).cast("timestamp"), window).start.cast("timestamp_ntz"))
    stats = d.groupBy("_w").agg(F.count(F.lit(1)).alias("requests"), F.avg(value).alias("avg_latency"),
                                F.avg(score).alias("avg_score"))
    mix = d.groupBy("_w", category).agg(F.count(F.lit(1)).alias("_n"))
    tot = mix.groupBy("_w").agg(F.sum("_n").alias("_t"))
    share = mix.join(tot, "_w").select("_w", category, (F.col("_n") / F.col("_t")).alias("q"))
    b = baseline.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    bt = b.agg(F.sum("_n").alias("_t"))
    bshare = b.crossJoin(bt).select(category, (F.col("_n") / F.col("_t")).alias("p"))
    drift = linf_by_window(share, bshare, category)
    return stats.join(drift, "_w").withColumnRenamed("_w", "window_start")


def windowed_monitor_stream(stream: DataFrame, ts: str, value: str, score: Column, category: str,
                            baseline_shares: DataFrame, sink_path: str, checkpoint: str, window: str = "1 day",
                            watermark: str = "1 hour", available_now: bool = True):
    """Streaming monitor: a watermarked aggregation keeps per (window, category)
    counts and sums in state and emits a window once the watermark passes its
    end (append mode); ``foreachBatch`` then turns the finalized windows into
    requests, means and the L-infinity distance to the baseline shares
    (``baseline_shares``: category, p — a small table) and appends them."""
    s = stream.withColumn("_t", F.col(ts).cast("timestamp")).withWatermark("_t", watermark)
    agg = (s.groupBy(F.window("_t", window).alias("w"), F.col(category))
             .agg(F.count(F.lit(1)).alias("_n"), F.sum(value).alias("_sv"), F.sum(score).alias("_ss")))

    def finalize(batch: DataFrame, batch_id: int) -> None:
        b = batch.withColumn("_w", F.col("w.start").cast("timestamp_ntz"))
        stats = b.groupBy("_w").agg(F.sum("_n").alias("requests"), (F.sum("_sv") / F.sum("_n")).alias("avg_latency"),
                                    (F.sum("_ss") / F.sum("_n")).alias("avg_score"))
        share = b.join(stats.select("_w", "requests"), "_w").select("_w", category,
                                                                    (F.col("_n") / F.col("requests")).alias("q"))
        drift = linf_by_window(share, baseline_shares, category)
        out = stats.join(drift, "_w").withColumnRenamed("_w", "window_start").withColumn("batch_id", F.lit(batch_id))
        # overwrite this batch's own folder: a replayed batch does not duplicate rows
        out.write.mode("overwrite").parquet(os.path.join(sink_path, f"batch_id={batch_id}"))

    w = agg.writeStream.outputMode("append").option("checkpointLocation", checkpoint).foreachBatch(finalize)
    q = (w.trigger(availableNow=True) if available_now else w).start()
    if available_now:
        q.awaitTermination()
    return q


def baseline_shares(baseline: DataFrame, category: str) -> DataFrame:
    b = baseline.groupBy(category).agg(F.count(F.lit(1)).alias("_n"))
    return b.crossJoin(b.agg(F.sum("_n").alias("_t"))).select(category, (F.col("_n") / F.col("_t")).alias("p"))


# ------------------------------------------------------------------ sinks ------------

def atomic_claim_writer(path: str):
    """``foreachBatch`` function: each micro-batch is written to its own
    ``batch_id=N`` folder with overwrite, so a replayed batch replaces its own
    output instead of appending a duplicate (check-and-write in one step)."""
    def write(batch_df: DataFrame, batch_id: int) -> None:
        batch_df.write.mode("overwrite").parquet(os.path.join(path, f"batch_id={batch_id}"))
    return write


def overwrite_partitions(df: DataFrame, path: str, partition_cols: list[str]) -> None:
    """Repeat runs overwrite the partitions of their input instead of appending."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_cols)
       .parquet(path))


def sentinel_dirs(spark, root: str, marker: str = "_SUCCESS") -> list[str]:
    """Input folders that are complete (contain the marker file).  A listing of
    folder names, not of data."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(root)
    fs = p.getFileSystem(conf)
    out = []
    if not fs.exists(p):
        return out
    for st in fs.listStatus(p):
        if st.isDirectory() and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), marker)):
            out.append(st.getPath().toString())
    return sorted(out)


def read_complete(spark, root: str, marker: str = "_SUCCESS", glob: str = "*.parquet") -> DataFrame | None:
    dirs = sentinel_dirs(spark, root, marker)
    if not dirs:
        return None
    return spark.read.option("pathGlobFilter", glob).parquet(*dirs)


def run_available_now(stream: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet",
                      output_mode: str = "append", foreach_batch=None):
    """Accumulate, then process what has arrived (``trigger(availableNow=True)``);
    progress lives in the checkpoint, so a re-run picks up only new files."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).outputMode(output_mode).trigger(availableNow=True)
    if foreach_batch is not None:
        q = w.foreachBatch(foreach_batch).start()
    else:
        q = w.format(fmt).option("path", sink_path).start()
    q.awaitTermination()
    return q
