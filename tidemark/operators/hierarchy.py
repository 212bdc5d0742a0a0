"""Trees and graphs kept as (parent, child) rows: all ancestors, totals rolled up, cycles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import settled


def closure(edges: DataFrame, parent: str = "parent", child: str = "child") -> DataFrame:
    """(ancestor, descendant, depth): every pair connected downwards, with its least depth.

    Each round joins only the pairs found in the last one with the edges and keeps
    those not known yet, so a round costs what is new, pairs end even where
    there are cycles, and rounds are as many as the tree is deep. Repeated edges
    count once; edges with a null end, as of a root, are left out. A node on a
    cycle is its own descendant. Rounds are written to the shared folder.
    """
    steps = settled(
        edges.select(F.col(parent).alias("ancestor"), F.col(child).alias("descendant"))
        .where("ancestor IS NOT NULL AND descendant IS NOT NULL").distinct()
    )
    fresh = steps.withColumn("depth", F.lit(1))
    found, depth = fresh, 1
    while True:
        depth += 1
        further = fresh.select("ancestor", F.col("descendant").alias("at")).join(
            steps.select(F.col("ancestor").alias("at"), "descendant"), "at"
        )
        pairs = further.select("ancestor", "descendant").distinct()
        fresh = settled(pairs.join(found, ["ancestor", "descendant"], "left_anti").withColumn("depth", F.lit(depth)))
        if fresh.isEmpty():
            return found
        found = found.unionAll(fresh)


def cycle_nodes(pairs: DataFrame) -> DataFrame:
    """(node, length) of the nodes of a ``closure`` that lie on a cycle, with the length of the shortest one through them."""
    return pairs.where("ancestor = descendant").select(F.col("ancestor").alias("node"), F.col("depth").alias("length"))


def rolled_up(pairs: DataFrame, values: DataFrame, node: str, totals: list[str]) -> DataFrame:
    """(node, totals): values of each node and of everything below it; a node reached on several ways counts once.

    Values are summed per node first. Nodes without values below them are not
    listed; values of nodes that are in no pair stand by themselves, null nodes
    are left out.
    """
    own = values.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(*[F.sum(t).alias(t) for t in totals])
    above = pairs.where("ancestor <> descendant").join(own.withColumnRenamed("node", "descendant"), "descendant")
    every = own.unionByName(above.select(F.col("ancestor").alias("node"), *totals))
    return every.groupBy("node").agg(*[F.sum(t).alias(t) for t in totals])
