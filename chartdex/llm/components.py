"""Connected components of a table of links, by contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace


def _follow(table: DataFrame, column: str, steps: DataFrame) -> DataFrame:
    """Replace a column's nodes by where ``steps`` (node, to) leads; others stay."""
    step = steps.select(F.col("node").alias("__node"), F.col("to").alias("__to"))
    joined = table.join(step, F.col(column) == F.col("__node"), "left")
    return joined.withColumn(column, F.coalesce("__to", column)).drop("__node", "__to")


def components(work: Workspace, links: DataFrame, name: str) -> DataFrame:
    """(node, to): every node of a link with the smallest node it is connected with.

    Each round sends a node to its smallest neighbour, if that is smaller, and from
    there one step further, and replaces the links by the links between the targets.
    At least every node that is not the smallest around goes away, so the number of
    rounds is logarithmic and the tables shrink; all are written to the shared folder.
    """
    edges, roots, turn = links.select("a", "b").where("a <> b").distinct(), None, 0
    edges = work.cut(edges, f"{name}-edges{turn}")
    while not edges.isEmpty():
        turn += 1
        both = edges.union(edges.select("b", "a"))
        nearest = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("to"))
        steps = work.cut(nearest.withColumn("to", F.least("node", "to")), f"{name}-near{turn}")
        steps = work.cut(_follow(steps, "to", steps), f"{name}-steps{turn}")
        moved = _follow(_follow(edges, "a", steps), "b", steps)
        edges = work.cut(moved.where("a <> b").distinct(), f"{name}-edges{turn}")
        roots = steps if roots is None else work.cut(_follow(roots, "to", steps), f"{name}-roots{turn}")
    return roots if roots is not None else links.select(F.col("a").alias("node"), F.col("b").alias("to")).limit(0)
