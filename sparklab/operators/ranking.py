"""Order statistics without a single-partition window.

``Window.orderBy(x)`` with no PARTITION BY (``NTILE``, ``PERCENT_RANK`` over the
whole table, ROC cumulative sums) moves every row into one task, and
``PARTITION BY g`` does the same for a hot group.  The operators here compute
the same numbers in three distributed steps:

1. range-partition the rows on ``(group, order)`` — Spark samples the keys, so a
   hot group is split across many partitions;
2. a prefix sum inside each (partition, group) slice — bounded by the size of a
   range partition;
3. per-(partition, group) totals (one row per slice: at most partitions + groups
   rows) turned into offsets with a small window and joined back on
   ``(partition id, group)`` — a key that is balanced by construction.

Ranks with ties go through the distinct ``(group, value)`` table first (partial
aggregation, so duplicates collapse map-side), then join back on the value.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


#: Frames that ``range_slices`` persisted and ``release`` has not given back yet.
_HELD: list[DataFrame] = []


def _n_parts(df: DataFrame, n: int | None) -> int:
    """Range slices: the caller's number, or the configured shuffle partitions
    (asking the input for its splits would run its upstream stages)."""
    return n or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def release() -> None:
    """Unpersist every frame that ranking calls hold.  Call it when their results
    have been written or collected; a result read later is computed again."""
    while _HELD:
        _HELD.pop().unpersist()


def range_slices(df: DataFrame, keys: list, n_parts: int | None = None) -> DataFrame:
    """Range-partition on ``keys`` and tag each row with its partition id (``_pid``).

    The frame is persisted because two branches read it (the rows and the
    per-slice totals): range bounds come from sampling seeded by the RDD, so two
    independent evaluations could assign a row to different partitions.  One
    materialization gives every consumer the same assignment; a lost block is
    recomputed from the same partitioner, so the assignment survives executor
    loss.  ``release`` gives the storage back."""
    r = (df.repartitionByRange(_n_parts(df, n_parts), *keys)
           .withColumn("_pid", F.spark_partition_id()))
    r = r.persist(StorageLevel.MEMORY_AND_DISK)
    _HELD.append(r)
    return r


def prefix_sum(df: DataFrame, part: list[str], order: list, weight, out: str,
               inclusive: bool = False, n_parts: int | None = None) -> DataFrame:
    """Running sum of ``weight`` in ``order`` within each ``part`` group.

    ``order`` must be unique within a group (add a key as the last tie-break).
    Exclusive by default (sum of strictly earlier rows).
    """
    w = weight if not isinstance(weight, str) else F.col(weight)
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    r = range_slices(df.withColumn("_w", w), [F.col(p) for p in part] + order_cols, n_parts)
    frame_end = Window.currentRow if inclusive else -1
    wl = Window.partitionBy("_pid", *part).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, frame_end)
    local = r.withColumn("_local", F.coalesce(F.sum("_w").over(wl), F.lit(0)))
    slices = r.groupBy("_pid", *part).agg(F.sum("_w").alias("_tot"))
    wo = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1) if part else \
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    # ``slices`` has one row per (range partition, group): its size is bounded by
    # partitions + groups, never by rows, so this small window and the join are cheap.
    offsets = slices.withColumn("_off", F.coalesce(F.sum("_tot").over(wo), F.lit(0))).drop("_tot")
    res = _join_back(local, offsets, ["_pid", *part])
    return res.withColumn(out, F.col("_local") + F.col("_off")).drop("_w", "_pid", "_local", "_off")


def row_number(df: DataFrame, part: list[str], order: list, out: str = "rn",
               n_parts: int | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY part ORDER BY order)``; order must end in a unique key."""
    r = prefix_sum(df, part, order, F.lit(1).cast("long"), "_rn0", n_parts=n_parts)
    return r.withColumn(out, (F.col("_rn0") + 1).cast("int")).drop("_rn0")


def group_sizes(df: DataFrame, part: list[str], out: str = "_n") -> DataFrame:
    """Attach the group size (a partial aggregate joined back on the group key)."""
    if not part:
        tot = df.agg(F.count(F.lit(1)).alias(out))
        return df.crossJoin(F.broadcast(tot))  # one row: a proven size bound
    sizes = df.groupBy(*part).agg(F.count(F.lit(1)).alias(out))
    return _join_back(df, sizes, part)


def ntile(df: DataFrame, k: int, part: list[str], order: list, out: str = "ntile",
          n_parts: int | None = None) -> DataFrame:
    """``NTILE(k) OVER (PARTITION BY part ORDER BY order)`` with SQL bucket sizes
    (the first ``n % k`` buckets hold one extra row)."""
    r = group_sizes(row_number(df, part, order, "_rn", n_parts), part, "_n")
    n, rn = F.col("_n"), F.col("_rn").cast("long")
    q = F.floor(n / k).cast("long")
    rem = (n - q * k).cast("long")
    big = rem * (q + 1)
    bucket = (F.when(q == 0, rn)
               .when(rn <= big, F.floor((rn - 1) / (q + 1)) + 1)
               .otherwise(rem + F.floor((rn - 1 - big) / q) + 1))
    return r.withColumn(out, bucket.cast("int")).drop("_rn", "_n")


def value_ranks(df: DataFrame, part: list[str], value: str, n_parts: int | None = None) -> DataFrame:
    """For each row: ``_lt`` rows of its group with a smaller value, ``_le`` with a
    smaller-or-equal value, ``_n`` group size.  Ties share values, as in SQL."""
    d = df.groupBy(*part, value).agg(F.count(F.lit(1)).alias("_c"))
    tot = d.groupBy(*part).agg(F.sum("_c").alias("_n")) if part else d.agg(F.sum("_c").alias("_n"))
    d = prefix_sum(d, part, [value], "_c", "_lt", n_parts=n_parts)
    d = d.withColumn("_le", F.col("_lt") + F.col("_c")).drop("_c")
    # group totals: one row per group (a single row when global -> broadcast is bounded)
    d = _join_back(d, tot, part) if part else d.crossJoin(F.broadcast(tot))
    return _join_back(df, d, [*part, value])


def _join_back(df: DataFrame, d: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe equi-join of per-key statistics back to the rows.  A hot key is a
    skewed partition on the row side only; AQE's skew-join splitting handles it."""
    dd = d.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[c for c in d.columns if c not in keys])
    cond = None
    for k in keys:
        c = df[k].eqNullSafe(dd[f"_k_{k}"])
        cond = c if cond is None else cond & c
    return df.join(dd, cond, "inner").drop(*[f"_k_{k}" for k in keys])


def percent_rank(df: DataFrame, part: list[str], value: str, out: str = "percent_rank",
                 n_parts: int | None = None) -> DataFrame:
    """``PERCENT_RANK() OVER (PARTITION BY part ORDER BY value)``."""
    r = value_ranks(df, part, value, n_parts)
    pr = F.when(F.col("_n") <= 1, F.lit(0.0)).otherwise(F.col("_lt") / (F.col("_n") - 1))
    return r.withColumn(out, pr.cast("double")).drop("_lt", "_le", "_n")


def rank(df: DataFrame, part: list[str], value: str, out: str = "rank", descending: bool = False,
         dense: bool = False, n_parts: int | None = None) -> DataFrame:
    """``RANK()`` (or ``DENSE_RANK()`` with ``dense``) over one value column."""
    if descending:
        # DESC NULLS LAST, as SQL: order by (is null, -value)
        tmp = df.withColumn("_neg", F.struct(F.col(value).isNull().alias("n"), (-F.col(value)).alias("v")))
        return rank(tmp, part, "_neg", out, False, dense, n_parts).drop("_neg")
    if dense:
        d = df.select(*part, value).distinct()
        d = prefix_sum(d, part, [value], F.lit(1).cast("long"), "_dr", n_parts=n_parts)
        return _join_back(df, d, [*part, value]).withColumn(out, (F.col("_dr") + 1).cast("int")).drop("_dr")
    r = value_ranks(df, part, value, n_parts)
    return r.withColumn(out, (F.col("_lt") + 1).cast("int")).drop("_lt", "_le", "_n")


def cume_dist(df: DataFrame, part: list[str], value: str, out: str = "cume_dist",
              n_parts: int | None = None) -> DataFrame:
    r = value_ranks(df, part, value, n_parts)
    return r.withColumn(out, (F.col("_le") / F.col("_n")).cast("double")).drop("_lt", "_le", "_n")


def exact_quantiles(df: DataFrame, part: list[str], value: str, qs: dict[str, float], n_parts: int | None = None) -> DataFrame:
    """Exact quantiles per group, interpolated between neighbours as ``percentile`` does: one row per group with a column
    for each name of ``qs``.  NULL values are left out; a group without values has no row.

    No task sees a whole group: equal values are counted first, range slices and their totals give each value its ranks,
    and only the values at the wanted ranks go on."""
    d = df.where(F.col(value).isNotNull()).select(*part, F.col(value).alias("_v")).groupBy(*part, "_v").agg(F.count(F.lit(1)).alias("_c"))
    total = d.groupBy(*part).agg(F.sum("_c").alias("_n")) if part else d.agg(F.sum("_c").alias("_n"))
    d = prefix_sum(d, part, ["_v"], "_c", "_lt", n_parts=n_parts)
    d = _join_back(d, total, part) if part else d.crossJoin(F.broadcast(total))  # a row per group; one row
    held, out = [], []
    for k, (name, q) in enumerate(qs.items()):
        at = F.lit(float(q)) * (F.col("_n") - 1)
        lo, hi = F.floor(at), F.ceil(at)
        here = lambda rank: (F.col("_lt") <= rank) & (rank < F.col("_lt") + F.col("_c"))
        held += [F.max(F.when(here(lo), F.col("_v"))).alias(f"_a{k}"), F.max(F.when(here(hi), F.col("_v"))).alias(f"_b{k}"), F.max(at - lo).alias(f"_s{k}")]
        out.append((F.col(f"_a{k}") + (F.col(f"_b{k}") - F.col(f"_a{k}")) * F.col(f"_s{k}")).alias(name))
    return (d.groupBy(*part) if part else d.groupBy()).agg(*held).select(*part, *out)
