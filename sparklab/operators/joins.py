"""Joins beyond a plain ``df.join``: cutoffs, fan-out checks, rank comparison,
range expansion.  Join strategy is left to Catalyst/AQE; ``broadcast`` is only
used for sides with a fixed size (one row, a threshold grid)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparklab.operators import ranking


def with_cutoff(df: DataFrame, as_of, name: str = "as_of") -> DataFrame:
    """CROSS JOIN to a one-row CTE holding the cutoff date: a literal column."""
    return df.withColumn(name, F.to_date(F.lit(str(as_of))))


def full_outer_rank_compare(a: DataFrame, b: DataFrame, key: str, a_rank: str, b_rank: str) -> DataFrame:
    """FULL OUTER JOIN of two rankings with the rank gap (NULL when one side lacks the key)."""
    j = a.select(key, a_rank).join(b.select(key, b_rank), key, "full_outer")
    return j.withColumn("rank_gap", F.col(a_rank) - F.col(b_rank))


def rank_by(df: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """``RANK() OVER (ORDER BY value DESC)`` via the distributed ranking."""
    return ranking.rank(df.select(key, value), [], value, out, descending=True)


def range_expand(df: DataFrame, n: Column, out: str = "n") -> DataFrame:
    """Row -> n copies numbered 1..n (``UNNEST(GENERATE_ARRAY(1, n))``)."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), n.cast("int"))))


def fanout_check(joined: DataFrame, key: str, base_rows: DataFrame) -> DataFrame:
    """After a join: rows, distinct keys and base rows must all be equal."""
    j = joined.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct(key).alias("distinct_keys"))
    b = base_rows.agg(F.count(F.lit(1)).alias("base_rows"))
    r = j.crossJoin(b)  # two one-row frames
    return r.withColumn("ok", (F.col("rows") == F.col("distinct_keys")) & (F.col("rows") == F.col("base_rows")))


def assert_no_fanout(check: DataFrame) -> DataFrame:
    """Fail the job when ``fanout_check`` is not ok (lazy: raises at the action)."""
    return check.withColumn("_assert", F.assert_true(F.col("ok"), F.lit("join fan-out detected")))


def scalar_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """One row of uncorrelated scalar subqueries ``(SELECT COUNT(*) FROM t)``."""
    out = None
    for name, df in frames.items():
        c = df.agg(F.count(F.lit(1)).alias(name))
        out = c if out is None else out.crossJoin(c)  # all one-row
    return out
