"""Stratified split and class weights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CELLS = 4096
HASH_SPAN = 1 << 40


def hash_mix(*keys: str, seed: int = 42) -> Column:
    """A repeatable pseudo-random order in [0, HASH_SPAN)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys], F.lit(seed)), F.lit(HASH_SPAN))


def stratified_split(
    df: DataFrame,
    label: str,
    key: str,
    test: float = 0.2,
    seed: int = 42,
    mix: Column | None = None,
    span: int = HASH_SPAN,
) -> DataFrame:
    """Add `split` (train/test): the first round(n * test) rows of each label, in the order of
    (`mix`, `key`), go to test.

    A label may hold most of the table, so it is never ranked as one group.  Counts per (label,
    cell of the mix) tell in which cell the cut falls; cells on either side are decided row by
    row, and only that one cell is ranked.
    """
    mixed = df.withColumn("_mix", mix if mix is not None else hash_mix(key, seed=seed))
    cell = F.floor(F.col("_mix") * F.lit(CELLS) / F.lit(span)).cast("bigint")
    celled = mixed.withColumn("_cell", cell)
    per_cell = celled.groupBy(label, "_cell").agg(F.count(F.lit(1)).alias("n"))
    by_label = Window.partitionBy(label)
    upto = F.sum("n").over(by_label.orderBy("_cell").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    quota = F.floor(F.sum("n").over(by_label) * F.lit(test) + 0.5).cast("bigint")
    cuts = per_cell.withColumn("upto", upto).withColumn("quota", quota)
    cuts = cuts.filter(F.col("upto") > F.col("quota")).groupBy(label).agg(
        F.min("_cell").alias("cut"), F.min_by(F.col("quota") - F.col("upto") + F.col("n"), "_cell").alias("left")
    )
    # A label whose quota is all of its rows has no cut.  Execution broadcasts the cuts if they are few.
    known = cuts.withColumnRenamed(label, "_label")
    joined = celled.join(known, F.col(label).eqNullSafe(F.col("_label")), "left")
    at_cut = F.coalesce(F.col("_cell") == F.col("cut"), F.lit(False))
    sure = F.when(F.coalesce(F.col("_cell") < F.col("cut"), F.lit(True)), "test").otherwise("train")
    decided = joined.filter(~at_cut).select(*df.columns, sure.alias("split"))
    rank = F.row_number().over(Window.partitionBy(label, "_cell").orderBy("_mix", key))
    close = joined.filter(at_cut).withColumn("_rank", rank)
    drawn = F.when(F.col("_rank") <= F.col("left"), "test").otherwise("train")
    return decided.unionByName(close.select(*df.columns, drawn.alias("split")))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """Balanced weight n / (classes * n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    everything = Window.partitionBy(F.lit(1))  # one row per class
    total, classes = F.sum("n").over(everything), F.count(F.lit(1)).over(everything)
    return counts.select(label, "n", (total / (classes * F.col("n"))).alias("weight"))


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Attach the balanced weight of a 0/1 target (two constants, no join)."""
    weights = {r[label]: r["weight"] for r in class_weights(df.filter(F.col(label).isin(0, 1)), label).collect()}
    rule = F.when(F.col(label) == 1, F.lit(weights.get(1, 1.0))).otherwise(F.lit(weights.get(0, 1.0)))
    return df.withColumn(out, rule)
