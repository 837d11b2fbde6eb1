"""Partitioned storage layout as user-level jobs (partition columns, clustering,
expiry) plus the date predicates that keep partition pruning possible."""

from __future__ import annotations

import datetime as _dt
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.functions.core import col

NULL_PARTITION = "__NULL__"
OUT_OF_RANGE_PARTITION = "__UNPARTITIONED__"


def day_bounds(day) -> tuple[Column, Column]:
    d = F.to_date(F.lit(str(day)))
    return d.cast("timestamp_ntz"), F.date_add(d, 1).cast("timestamp_ntz")


def on_day(df: DataFrame, ts_col: str, day) -> DataFrame:
    """``DATE(ts) = day`` written as a half-open timestamp range so it reaches the
    Parquet scan as pushed filters (``DATE(ts) = x`` would not)."""
    lo, hi = day_bounds(day)
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def with_date_partition(df: DataFrame, ts_col: str, out: str = "d") -> DataFrame:
    return df.withColumn(out, F.to_date(F.col(ts_col)))


def trunc_bucket(ts, unit: str) -> Column:
    """Hour / day / month / year partition key (``TIMESTAMP_TRUNC``)."""
    return F.date_trunc(unit, col(ts))


def int_range_bucket(x, start: int, end: int, step: int) -> Column:
    """``RANGE_BUCKET(x, GENERATE_ARRAY(start, end, step))`` as a partition label:
    the lower bound of the bucket, or ``__NULL__`` / ``__UNPARTITIONED__``."""
    c = col(x)
    lower = (F.floor((c - F.lit(start)) / F.lit(step)) * F.lit(step) + F.lit(start)).cast("bigint")
    return (F.when(c.isNull(), F.lit(NULL_PARTITION))
             .when((c < F.lit(start)) | (c >= F.lit(end)), F.lit(OUT_OF_RANGE_PARTITION))
             .otherwise(lower.cast("string")))


def ingestion_time(df: DataFrame, load_ts, unit: str = "day", out: str = "_PARTITIONTIME") -> DataFrame:
    """Stamp rows with the load time truncated to the partition boundary.  The
    load time is a parameter (never ``current_timestamp`` inside the operator)."""
    return df.withColumn(out, F.date_trunc(unit, F.lit(str(load_ts)).cast("timestamp")))


def write_partitioned(df: DataFrame, path: str, partition_cols: list[str], mode: str = "overwrite",
                      cluster_cols: list[str] = (), max_partitions: int | None = 10_000) -> None:
    """Write with Hive-style partitions; rows sorted inside files by up to four
    cluster columns (prefix order matters) so Parquet min/max stats prune.

    Dynamic partition overwrite: only the partitions present in ``df`` are
    replaced, so re-running one day is idempotent.
    """
    if len(cluster_cols) > 4:
        raise ValueError("at most 4 cluster columns")
    if max_partitions:
        n = df.select(*partition_cols).distinct().count()
        if n > max_partitions:
            raise ValueError(f"{n} partitions exceed the limit of {max_partitions}")
    out = df
    if partition_cols:
        out = out.repartition(*[F.col(c) for c in partition_cols])
    if cluster_cols:
        out = out.sortWithinPartitions(*partition_cols, *cluster_cols)
    (out.write.mode(mode).option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_cols).parquet(path))


def cluster_layout(df: DataFrame, cluster_cols: list[str], n_files: int | None = None) -> DataFrame:
    """Range-partition by the cluster columns and sort inside partitions: each
    output file then covers a narrow, ordered key range."""
    if len(cluster_cols) > 4:
        raise ValueError("at most 4 cluster columns")
    r = df.repartitionByRange(n_files, *cluster_cols) if n_files else df.repartitionByRange(*cluster_cols)
    return r.sortWithinPartitions(*cluster_cols)


def partition_folders(spark, path: str, part_col: str) -> list[tuple[str, str]]:
    """(value, folder) of the partitions of a table by ``part_col``, from the listing of its folder by the cluster's file
    system: no data file is opened."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = []
    for s in at.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(at):
        name = s.getPath().getName()
        if s.isDirectory() and name.startswith(f"{part_col}="):
            out.append((unquote(name[len(part_col) + 1:]), s.getPath().toString()))
    return sorted(out)


def partitions_to_expire(spark, path: str, part_col: str, as_of, keep_days: int) -> DataFrame:
    """Partition values older than ``keep_days`` before ``as_of``, nothing deleted.  Reads only the listing of the table's
    folder; values that are no dates (the null partition) never expire."""
    rows = [(v,) for v, _ in partition_folders(spark, path, part_col)]  # a row per partition
    parts = spark.createDataFrame(rows, f"`{part_col}` string").select(F.expr(f"try_cast(`{part_col}` AS date)").alias(part_col))
    return parts.where(F.col(part_col) < F.date_sub(F.to_date(F.lit(str(as_of))), keep_days))


def expire_partitions(spark, path: str, part_col: str, as_of, keep_days: int, dry_run: bool = True):
    """Delete the folders of old partitions through the cluster's file system (any store that Spark reads), and return
    their values; with ``dry_run`` only the values.  The kept partitions are not touched."""
    old = partitions_to_expire(spark, path, part_col, as_of, keep_days)
    if dry_run:
        return old
    gone = {str(r[0]) for r in old.collect()}  # a row per partition
    folders = [f for v, f in partition_folders(spark, path, part_col) if v in gone]
    for f in folders:
        at = spark._jvm.org.apache.hadoop.fs.Path(f)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    return spark.createDataFrame([(_dt.date.fromisoformat(v),) for v in sorted(gone)], f"`{part_col}` date")


def partition_count_guard(df: DataFrame, part_cols: list[str], per_table: int = 10_000) -> int:
    """Number of distinct partition values; raise above the table limit."""
    n = df.select(*part_cols).distinct().count()
    if n > per_table:
        raise ValueError(f"{n} partitions > {per_table}")
    return n
