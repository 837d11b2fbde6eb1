"""Feature tables: windowed conditional counts, point-in-time joins, feature derivation."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sparklab.functions.core import safe_divide


def _as_date(v):
    if isinstance(v, (_dt.date, _dt.datetime)):
        return F.lit(v).cast("date")
    return F.to_date(F.lit(str(v)))


def windowed_counts(events: DataFrame, key: str, ts_col: str, as_of,
                    windows=(30, 90, 180), type_col: str | None = None,
                    typed: dict | None = None, ratio: tuple | None = None) -> DataFrame:
    """Nested conditional counts per key, all windows ending at ``as_of``.

    ``windows``: day lengths; a row counts for window w when
    ``as_of - w < date(ts) <= as_of``.  ``typed``: ``{name: (type_value, w)}``.
    ``ratio``: ``(short, long)`` gives ``events_short / (events_long / (long/short))``.

    Only rows on or before the cutoff are read (point-in-time); the bound is a
    timestamp comparison so it reaches the Parquet scan as a pushed filter.
    One grouped pass; every aggregate is algebraic so a hot key is combined
    map-side before the shuffle.
    """
    cutoff = _as_date(as_of)
    d = F.to_date(F.col(ts_col))
    upper = F.date_add(cutoff, 1).cast("timestamp_ntz")
    base = events.where(F.col(ts_col) < upper)
    aggs = [F.count_if(d > F.date_sub(cutoff, int(w))).alias(f"events_{w}d") for w in windows]
    for name, (value, w) in (typed or {}).items():
        aggs.append(F.count_if((F.col(type_col) == F.lit(value)) & (d > F.date_sub(cutoff, int(w)))).alias(name))
    aggs.append(F.max(d).alias("last_event_date"))
    out = base.groupBy(key).agg(*aggs)
    out = out.withColumn("days_since_last_event", F.datediff(cutoff, F.col("last_event_date")))
    if ratio:
        s, l = ratio
        out = out.withColumn(f"activity_ratio_{s}d_vs_avg",
                             safe_divide(F.col(f"events_{s}d").cast("double"),
                                         F.col(f"events_{l}d") / F.lit(l / s)))
    return out


def asof_join(labels: DataFrame, features: DataFrame, key: str, label_ts: str, feature_ts: str,
              value_cols: list[str], strict: bool = False) -> DataFrame:
    """Point-in-time join: for each label row, the latest feature row with
    ``feature_ts <= label_ts`` (``<`` when ``strict``) on the same key (NULL features when none).

    Labels and features are unioned into one time-ordered stream per key and
    the latest feature is carried forward (``distributed_ffill``): linear in the
    rows, no label x feature pairs, and a hot key is split across range
    partitions.  At equal timestamps features sort before labels (``<=``) or
    after them (``<``); among features with the same timestamp the largest
    value tuple wins, so the pick is deterministic.
    """
    lab_cols = labels.columns
    lab = labels.select(F.col(key).alias("_k"), F.col(label_ts).alias("_t"),
                        F.lit(1 if not strict else 0).alias("_o"),
                        F.struct(*[F.col(c) for c in lab_cols]).alias("_lab"),
                        F.lit(None).cast(T.StructType([T.StructField("feature_ts", features.schema[feature_ts].dataType)]
                                                      + [features.schema[c] for c in value_cols])).alias("_v"))
    fea = features.select(F.col(key).alias("_k"), F.col(feature_ts).alias("_t"),
                          F.lit(0 if not strict else 1).alias("_o"),
                          F.lit(None).cast(lab.schema["_lab"].dataType).alias("_lab"),
                          F.struct(F.col(feature_ts).alias("feature_ts"), *[F.col(c) for c in value_cols]).alias("_v"))
    u = lab.unionByName(fea)
    filled = distributed_ffill(u, "_k", [F.col("_t"), F.col("_o"), F.col("_v")], "_v", "_f")
    out = filled.where(F.col("_lab").isNotNull())
    return out.select("_lab.*", "_f.feature_ts", *[F.col(f"_f.{c}").alias(c) for c in value_cols])


def distributed_ffill(df: DataFrame, key: str, order: list, value: str, out: str,
                      n_parts: int | None = None) -> DataFrame:
    """``LAST(value IGNORE NULLS) OVER (PARTITION BY key ORDER BY order)`` without
    sending a key to one task: range partitions on (key, order) fill locally;
    the last non-null value of each earlier (partition, key) slice is carried
    in through a table with one row per slice."""
    from sparklab.operators.ranking import range_slices
    r = range_slices(df, [F.col(key), *order], n_parts)
    w = Window.partitionBy("_pid", key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = r.withColumn("_loc", F.last(F.col(value), ignorenulls=True).over(w))
    # every (partition, key) slice gets a row, NULL when it holds no value
    last = r.groupBy("_pid", key).agg(
        F.max_by(F.col(value), F.when(F.col(value).isNotNull(), F.struct(*order))).alias("_last"))
    ws = Window.partitionBy(key).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.withColumn("_carry", F.last("_last", ignorenulls=True).over(ws)).drop("_last")
    j = local.join(carried, ["_pid", key], "left")
    return j.withColumn(out, F.coalesce(F.col("_loc"), F.col("_carry"))).drop("_pid", "_loc", "_carry")


def left_join_defaults(base: DataFrame, feats: DataFrame, on: str | list, defaults: dict) -> DataFrame:
    """LEFT JOIN + COALESCE of absent features to per-column defaults."""
    j = base.join(feats, on=on, how="left")
    return j.select(*[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c)
                      for c in j.columns])
