"""Sampling, top-k per group, idempotent upserts and de-duplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparklab.functions.core import md5num


def stratified_sample(df: DataFrame, strata: list[str], key: str, n: int, rn: str = "rn") -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY strata ORDER BY hash(key)) <= n``.

    The filter on the row number lets Catalyst insert a partial per-partition
    group limit below the shuffle (``WindowGroupLimit``), so a hot stratum ships
    at most ``n`` rows per map task."""
    w = Window.partitionBy(*strata).orderBy(md5num(key), F.col(key))
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) <= n)


def hash_sample(df: DataFrame, key: str, pct: int, salt: str = "") -> DataFrame:
    """Reproducible key-hash sample: ``MOD(ABS(hash(key)), 100) < pct``."""
    k = F.concat(F.col(key).cast("string"), F.lit(salt)) if salt else F.col(key)
    return df.where(F.pmod(md5num(k), F.lit(100)) < pct)


def block_sample(df: DataFrame, fraction: float, seed: int = 7, block_rows: int = 1000) -> DataFrame:
    """Block sampling: keep whole storage blocks (file + run of ``block_rows``
    rows) chosen by a hash of the block id — cheap and correlated, like
    ``TABLESAMPLE SYSTEM``; contrast with row-level ``df.sample``."""
    block = F.concat_ws("#", F.col("_metadata.file_path"),
                        F.floor(F.col("_metadata.row_index") / block_rows).cast("string"))
    bucket = F.pmod(F.xxhash64(block, F.lit(seed)), F.lit(10_000))
    return df.where(bucket < int(fraction * 10_000))


def dedupe_exact(df: DataFrame, by: list[str] | Column, keep_min: str, copies: str | None = None) -> DataFrame:
    """One row per duplicate group: one with the smallest ``keep_min`` (any one of
    them on a tie, NULL last); ``copies`` names a column for the group's size.
    NULL keys are a group.  The pick is a partial aggregate, so a hot group is
    combined before the shuffle."""
    by_cols = by if isinstance(by, list) else [by.alias("_dk")]
    first = F.min_by(F.struct(*df.columns), F.struct(F.col(keep_min).isNull(), F.col(keep_min)))
    g = df.groupBy(*by_cols).agg(first.alias("_row"), F.count(F.lit(1)).alias("_copies"))
    return g.select("_row.*", *([F.col("_copies").alias(copies)] if copies else []))


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str],
                 update_cols: list[str] | None = None) -> DataFrame:
    """MERGE: matched keys take the source row, unmatched source rows are
    inserted, other target rows are kept.  Expressed as anti-join + union (the
    result DataFrame); ``write_merged`` persists it.  Running it twice with the
    same source yields the same table (idempotent per key)."""
    src = source.select(*target.columns) if update_cols is None else source
    keep = target.join(src.select(*keys), on=keys, how="left_anti")
    return keep.unionByName(src.select(*target.columns))


def assert_unique_source(source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE must not see two source rows for one key: a lazy assertion."""
    dup = source.groupBy(*keys).count().where(F.col("count") > 1)
    return dup.agg(F.count(F.lit(1)).alias("dups")).withColumn(
        "_ok", F.assert_true(F.col("dups") == 0, F.lit("MERGE source has duplicate keys")))


def write_merged(spark, target_path: str, source: DataFrame, keys: list[str], partition_col: str) -> None:
    """Persist a MERGE on plain Parquet without reading and writing one path in
    the same job: only partitions touched by the source are rewritten (dynamic
    partition overwrite) after staging the merged rows in the checkpoint folder."""
    import uuid

    from sparklab.session import ensure_checkpoint_dir

    touched = source.select(partition_col).distinct()
    try:
        tgt = spark.read.parquet(target_path)
        tgt_touched = tgt.join(touched, partition_col, "left_semi")
        merged = merge_upsert(tgt_touched.select(*source.columns), source, keys)
    except Exception as e:  # first run: no target yet
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        merged = source
    stage = f"{ensure_checkpoint_dir(spark).rstrip('/')}/merge-stage-{uuid.uuid4().hex}"
    merged.write.mode("overwrite").parquet(stage)
    (spark.read.parquet(stage).repartition(partition_col).write.mode("overwrite")
          .option("partitionOverwriteMode", "dynamic").partitionBy(partition_col).parquet(target_path))


def merge_repair(scored: DataFrame, rescored: DataFrame, key: str, failed: Column,
                 value_cols: list[str]) -> DataFrame:
    """Re-score only failed rows and merge: failed rows take the new values."""
    fixed = rescored.select(key, *[F.col(c).alias(f"_new_{c}") for c in value_cols])
    j = scored.join(fixed, key, "left")
    out = j.select(*[F.when(failed & F.col(f"_new_{c}").isNotNull(), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
                     if c in value_cols else F.col(c) for c in scored.columns])
    return out
