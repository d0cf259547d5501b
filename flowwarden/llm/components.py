"""Connected components of links between numbered nodes, by alternating large and small stars.

Each step points nodes at the smallest node around them; links are rewritten until none changes.
Minimums are aggregated before the shuffle and joined back, so the neighbours of a hub are never
gathered.  Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.session import durable


def _star(links: DataFrame, large: bool) -> DataFrame:
    """links: (u, v) with u > v; a large star looks at all neighbours, a small one at the smaller ones."""
    both = links.union(links.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else links
    low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = both.join(low, "u")
    if large:
        moved = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        own = low.select("u", F.col("m").alias("v"))
        moved = joined.filter(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v")).union(own)
    return moved.filter(F.col("u") != F.col("v")).distinct()


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): the smallest node that each linked node reaches; nodes without links are left out."""
    current = durable(
        links.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )
    before = None
    while before != (now := _print(current)):
        before = now
        current = durable(_star(_star(current, True), False))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return durable(current.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots))
