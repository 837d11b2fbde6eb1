"""Registry of named queries over the fixture tables.

Each registered query is ``fn(spark, sf_dir) -> DataFrame`` built from library
operators; ``sql`` is the equivalent DuckDB statement used as the oracle.
``check`` records how the key is verified: O (exact oracle), R (rows + pytest
invariant), T (pytest only).
"""

from __future__ import annotations

QUERIES: dict = {}
ORACLES: dict = {}
CHECKS: dict = {}


def query(key: str, sql: str | None = None, check: str | None = None):
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql.strip()
        CHECKS[key] = check or ("O" if sql is not None else "R")
        return fn
    return deco
