"""Scalar column helpers: the warehouse-SQL functions that Spark spells differently.

Every helper returns a ``Column`` built only from JVM-side built-ins, so it stays
inside whole-stage codegen.  Where an oracle twin in DuckDB exists it is noted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def md5num(*parts) -> Column:
    """Stable 60-bit non-negative integer from the md5 of the concatenated parts.

    Stands in for a fingerprint hash; DuckDB twin:
    ``('0x' || substr(md5(k), 1, 15))::BIGINT``.
    """
    key = F.concat(*[col(p).cast("string") for p in parts]) if len(parts) > 1 else col(parts[0]).cast("string")
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("bigint")


def unit_hash(*parts, modulus: int = 1000) -> Column:
    """Deterministic value in [0, 1) from a key: ``(md5num % m) / m``."""
    return (F.pmod(md5num(*parts), F.lit(modulus)) / F.lit(float(modulus)))


def safe_divide(a, b) -> Column:
    """``SAFE_DIVIDE(a, NULLIF(b, 0))``: NULL instead of an error on 0 or NULL."""
    return F.try_divide(col(a), F.nullif(col(b), F.lit(0)))


def safe_double(c, default: float | None = 0.0) -> Column:
    """``COALESCE(SAFE_CAST(TRIM(x) AS FLOAT64), default)``."""
    v = F.trim(col(c).cast("string")).try_cast("double")
    return F.coalesce(v, F.lit(default)) if default is not None else v


def blank_to_null(c) -> Column:
    """``NULLIF(TRIM(x), '')``."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def regexp_extract_or_null(c, pattern: str, idx: int = 1) -> Column:
    """``REGEXP_EXTRACT`` with warehouse semantics: NULL (not '') on no match."""
    return F.nullif(F.regexp_extract(col(c), pattern, idx), F.lit(""))


def band(c, edges: list[tuple], otherwise: str) -> Column:
    """CASE bands: ``edges`` = [(upper_inclusive, label), ...] in ascending order."""
    expr = None
    for upper, label in edges:
        cond = col(c) <= F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(otherwise))


def bool_sum(*conds: Column) -> Column:
    """Sum of boolean casts: ``CAST(a AS INT64) + CAST(b AS INT64) + ...``."""
    total = None
    for c in conds:
        term = F.coalesce(c.cast("int"), F.lit(0))
        total = term if total is None else total + term
    return total


def to_day(c) -> Column:
    """``DATE(ts)``."""
    return F.to_date(col(c))
