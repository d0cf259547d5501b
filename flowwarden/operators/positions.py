"""Exact positions and running totals over any key, without putting a key into one task.

Rows are range-partitioned on (key, order), so a key that holds a third of the data is cut into
many chunks.  Only the first key of a chunk can continue from an earlier chunk, hence the carried
offsets are at most one row per chunk and may be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.session import durable


def ordered_position(
    df: DataFrame,
    order: list[str],
    keys: list[str] | None = None,
    weight: Column | None = None,
    name: str = "position",
    chunks: int | None = None,
) -> DataFrame:
    """Add the running total of `weight` (default 1: the 1-based position) within `keys`.

    `order` has to be a total order inside a key for the result to be unique.
    """
    keys = keys or []
    weighted = df.withColumn("_weight", weight if weight is not None else F.lit(1).cast("bigint"))
    # Without a number the chunks follow spark.sql.shuffle.partitions, fewer for a small table.
    into = weighted.repartitionByRange(*([chunks] if chunks else []), *keys, *order)
    ranged = durable(into.withColumn("_chunk", F.spark_partition_id()))

    totals = ranged.groupBy(*keys, "_chunk").agg(F.sum("_weight").alias("_sum"))
    # At most one row per key and chunk here, and only one row per chunk survives the filter.
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        totals.withColumn("_before", F.sum("_sum").over(earlier))
        .filter(F.col("_before").isNotNull())
        .select("_chunk", *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], "_before")
    )

    inside = Window.partitionBy("_chunk", *keys).orderBy(*order)
    inside = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("_local", F.sum("_weight").over(inside)).withColumnRenamed("_chunk", "_c")
    same = F.col("_c") == F.col("_chunk")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    joined = local.join(F.broadcast(offsets), same, "left")
    position = F.col("_local") + F.coalesce(F.col("_before"), F.lit(0))
    return joined.select(*df.columns, position.alias(name))
