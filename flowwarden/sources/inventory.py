"""File inventories: which files may be taken, which have to go."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S

MIN_CAPTURE_BYTES = 24  # fixed value: size of an empty capture


def file_inventory(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """path, length and modification time of the files in a folder, without reading them."""
    listing = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(folder)
    return listing.select("path", "length", "modificationTime")


def _glob_pattern(glob: str) -> str:
    special = {"*": "[^/]*", "?": "[^/]"}
    return "^" + "".join(special.get(ch, "\\" + ch if not ch.isalnum() and ch != "_" else ch) for ch in glob) + "$"


def expired_files(inventory: DataFrame, now: Column, minutes: int = 30, globs: Sequence[str] = ("*",)) -> DataFrame:
    """Files whose name matches and whose last change is older than the retention."""
    name = S.base_name("path")
    matches = F.lit(False)
    for glob in globs:
        matches = matches | name.rlike(_glob_pattern(glob))
    limit = now - F.make_dt_interval(mins=F.lit(minutes))
    return inventory.filter(matches & (F.col("modificationTime") < limit))


def settled_files(
    inventory: DataFrame,
    now: Column,
    min_age_seconds: int = 5,
    min_size: int = MIN_CAPTURE_BYTES,
    previous: DataFrame | None = None,
) -> DataFrame:
    """Files that are complete: large enough, old enough, followed by a newer file in their folder,
    and of the same size as in the previous inventory where one is given."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    listed = inventory.withColumn("_folder", folder)
    newest = listed.groupBy("_folder").agg(F.max("modificationTime").alias("_newest"))
    old = F.col("modificationTime") <= now - F.make_dt_interval(secs=F.lit(min_age_seconds))
    settled = listed.join(newest, "_folder").filter(
        (F.col("length") >= min_size) & old & (F.col("modificationTime") < F.col("_newest"))
    )
    settled = settled.drop("_folder", "_newest")
    if previous is None:
        return settled
    return settled.join(previous.select("path", "length"), ["path", "length"], "left_semi").select(*inventory.columns)


def unprocessed(files: DataFrame, done: DataFrame, path: str = "path") -> DataFrame:
    """Files that have not been processed yet."""
    return files.join(done.select(path), path, "left_anti")


def left_window(processed: DataFrame, window: DataFrame, file: str = "file") -> DataFrame:
    """Processed files that no window holds any more and that may be archived."""
    return processed.select(file).distinct().join(window.select(file), file, "left_anti")
