"""Connected components of an edge table by randomised contraction.

Each round every node moves to the neighbour (or itself) of the smallest hash under the round's seed, the edges are
rewritten to the new nodes, and loops go; a constant share of the nodes disappears per round.  The minimum is a partial
aggregate, so a hub's neighbours never meet in one task.  Rounds are written to the shared folder; their moves are put
together at the end, the last and smallest first.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparklab.llm.common import written

#: Rows that a file of a round holds at least, if there are as many: a round of few edges is few files and tasks.
ROWS = 200_000


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """Of edges (a, b), at most so many, every node with a label that is equal within a component: (node, label)."""
    edges = edges.select("a", "b").where("a <> b").distinct()
    edges = written(edges if most is None else edges.coalesce(max(-(-most // ROWS), 1)), "edges")
    steps = []
    seed = 0
    while left := edges.count():
        files = -(-left // ROWS)
        both = edges.union(edges.select("b", "a")).toDF("node", "near")
        order = lambda c: F.struct(F.xxhash64(F.lit(seed), c), c.alias("to"))  # noqa: E731, B023
        step = both.groupBy("node").agg(F.least(F.min(order(F.col("near"))), order(F.col("node"))).getField("to").alias("to"))
        step = written(step.coalesce(files), "component-step")
        steps.append(step)
        a, b = step.toDF("a", "a2"), step.toDF("b", "b2")
        edges = edges.join(a, "a").join(b, "b").select(F.col("a2").alias("a"), F.col("b2").alias("b")).where("a <> b")
        edges = written(edges.distinct().coalesce(files), "edges")
        seed += 1
    if not steps:
        return edges.toDF("node", "label")
    labels = steps[-1].toDF("node", "label")
    for step in reversed(steps[:-1]):
        labels = step.join(labels.toDF("to", "label"), "to", "left").select("node", F.coalesce("label", "to").alias("label"))
    return written(labels.coalesce(-(-steps[0].count() // ROWS)), "component-labels")


def joined(labels: DataFrame, edges: DataFrame) -> DataFrame:
    """``labels`` (node, label) of ``components`` after more edges (a, b): only the components that these join are contracted."""
    most = edges.count()
    for c in "ab":
        edges = edges.join(labels.toDF(c, "label"), c, "left").withColumn(c, F.coalesce("label", c)).drop("label")
    step = components(edges, most)
    moved = labels.join(step.toDF("label", "to"), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    moved = moved.union(step.join(labels.select("node"), "node", "left_anti"))
    return written(moved.coalesce(-(-(labels.count() + 2 * most) // ROWS) or 1), "component-labels")
