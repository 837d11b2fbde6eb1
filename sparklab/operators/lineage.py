"""Graph walks over lineage edges and experiment comparison tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.session import ensure_checkpoint_dir


def walk(edges: DataFrame, starts: DataFrame, src: str, dst: str, max_depth: int | None = None) -> DataFrame:
    """Transitive closure from ``starts`` (column ``start``) along ``src -> dst``.

    Iterated join of the frontier with the edge table, with an anti-join on the
    (start, node) pairs already visited, so cycles terminate; the walk ends when
    the frontier is empty.  With ``max_depth``, nodes that lie deeper raise a
    ``ValueError``: nothing is cut silently.  The loop runs once per depth level
    (not per row); each level and the visited pairs are cut with a reliable
    ``checkpoint``, so no level computes an earlier one again.  Returns (start,
    node, depth) with the minimum depth."""
    ensure_checkpoint_dir(starts.sparkSession)
    e = edges.select(F.col(src).alias("_s"), F.col(dst).alias("_d"))
    frontier = starts.select("start", F.col("start").alias("node"))
    visited = None
    depth = 0
    while True:
        depth += 1
        nxt = (frontier.join(e, frontier["node"] == e["_s"]).select("start", F.col("_d").alias("node"))
                       .where(F.col("node") != F.col("start")).distinct())
        if visited is not None:
            nxt = nxt.join(visited.select("start", "node"), ["start", "node"], "left_anti")
        nxt = nxt.withColumn("depth", F.lit(depth)).checkpoint()
        if nxt.isEmpty():
            break
        if max_depth is not None and depth > max_depth:
            raise ValueError(f"the walk is not complete after {max_depth} levels")
        visited = nxt if visited is None else visited.unionByName(nxt)
        frontier = nxt.select("start", "node")
    if visited is None:
        return starts.sparkSession.createDataFrame([], "start string, node string, depth int")
    return visited


def upstream(edges: DataFrame, starts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Walk INPUT edges back: child -> parent."""
    return walk(edges, starts, "child", "parent", max_depth).withColumnRenamed("node", "ancestor")


def downstream(edges: DataFrame, starts: DataFrame, max_depth: int | None = None) -> DataFrame:
    """Walk OUTPUT edges forward: parent -> child."""
    return walk(edges, starts, "parent", "child", max_depth).withColumnRenamed("node", "descendant")


def experiment_table(long: DataFrame, run: str = "run_id", kind: str = "kind", name: str = "name",
                     value: str = "value", names: list[str] | None = None) -> DataFrame:
    """Runs x params x metrics, wide: one pivot of the long table (the pivot
    values are given, so no extra pass collects them)."""
    col = F.concat_ws(".", F.col(kind), F.col(name))
    p = long.withColumn("_c", col).groupBy(run)
    p = p.pivot("_c", names) if names else p.pivot("_c")
    return p.agg(F.first(value))
