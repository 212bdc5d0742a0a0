"""Connected components of a link table, by rounds of joins that shrink every component to a star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.session import settled


def _stars(edges: DataFrame) -> DataFrame:
    """One large-star and one small-star step on edges (u, v) with u > v."""
    both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    # Larger neighbours move to the smallest one: the end with many neighbours is on the side that join can split.
    large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
    # Now u has few neighbours, all smaller; they move to the smallest of them.
    ranked = large.withColumn("m", F.min("v").over(W.partitionBy("u")))
    moved = F.when(F.col("v") > F.col("m"), F.struct(F.col("v").alias("u"), F.col("m").alias("v"))).otherwise(F.struct("u", "v"))
    return ranked.select(moved.alias("e")).select("e.u", "e.v")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every id in a link; the component is its smallest id.

    Links to itself or with a null end are left out; repeated links and links in
    both directions count once; no links give no rows. Each round is written to
    the shared folder, and rounds end when nothing changes; their number grows
    with the logarithm of the longest path.
    """
    edges = settled(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    state = None
    while True:
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state or not now[0]:
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component")).unionAll(
                edges.select("v").distinct().select(F.col("v").alias("id"), F.col("v").alias("component"))
            )
        state = tuple(now)
        edges = settled(_stars(edges))
