"""Archive and retention of files: moves and deletions by tasks, with a journal.

A plan is a table of files with what is to be done.  Tasks carry it out through Arrow's file systems, a file at a time,
and write what happened; a plan that is carried out again finds its files gone and changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import quote, urlsplit

import pyarrow as pa
import pyarrow.fs as pfs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S
from flowwarden.sources.inventory import _glob_pattern

JOURNAL = "path string, length bigint, policy string, action string, target string, outcome string"


@dataclass(frozen=True)
class Policy:
    """Files below `folder` whose name matches one of `globs` go after `minutes`."""

    name: str
    folder: str
    globs: tuple[str, ...] = ("*",)
    minutes: int = 30


def retention_plan(inventory: DataFrame, now: Column, policies: Sequence[Policy]) -> DataFrame:
    """Files that a policy lets go, with its name; the first policy that fits a file decides (also that it stays)."""
    name = S.base_name("path")
    where = F.regexp_replace("path", "^[a-z0-9]+:/*", "/")
    owner, limit = F, F
    for p in policies:
        matches = F.lit(False)
        for glob in p.globs:
            matches = matches | name.rlike(_glob_pattern(glob))
        fits = where.startswith(p.folder.rstrip("/") + "/") & matches
        owner = owner.when(fits, p.name)
        limit = limit.when(fits, now - F.make_dt_interval(mins=F.lit(p.minutes)))
    if not policies:
        owner, limit = F.lit(None).cast("string"), F.lit(None).cast("timestamp")
    planned = inventory.withColumn("policy", owner).filter(F.col("modificationTime") < limit)
    return planned.select("path", "length", "policy", F.lit("delete").alias("action"), F.lit(None).cast("string").alias("target"))


def archive_plan(files: DataFrame, folder: str, policy: str = "processed") -> DataFrame:
    """Files (path, length) that move into a folder and keep their names."""
    target = F.concat(F.lit(folder.rstrip("/") + "/"), S.base_name("path"))
    return files.select("path", "length", F.lit(policy).alias("policy"), F.lit("move").alias("action"), target.alias("target"))


def _place(uri: str) -> tuple[pfs.FileSystem, str]:
    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pfs.LocalFileSystem(), parts.path
    return pfs.FileSystem.from_uri(quote(uri, safe=":/@?&=%"))


def _exists(system: pfs.FileSystem, at: str) -> bool:
    return system.get_file_info(at).type != pfs.FileType.NotFound


def carry_out_one(path: str, action: str, target: str | None) -> str:
    """done, or gone where an earlier run has done it, or what went wrong."""
    try:
        system, at = _place(path)
        if not _exists(system, at):
            return "gone"
        if action == "delete":
            system.delete_file(at)
            return "done"
        other, to = _place(target)
        if type(other) is not type(system):
            return "error: the target is in another store"
        if _exists(other, to):
            return "error: the target exists"
        system.create_dir(to.rsplit("/", 1)[0], recursive=True)
        system.move(at, to)
        return "done"
    except (OSError, pa.ArrowException) as e:
        return f"error: {e}"


def carry_out(plan: DataFrame, journal: str) -> DataFrame:
    """Does what the plan says, and returns the journal: the plan with `outcome` (done, gone or an error).

    The plan is fixed before the first file is touched, so a listing is not read again after files have moved.  A file
    that cannot be moved stays where it is and is in the journal with its error.  Tasks may be repeated: a file
    that the first try has moved is `gone` for the second one.
    """
    spark = plan.sparkSession
    fields = ["path", "length", "policy", "action", "target"]
    plan.select(*fields).write.mode("overwrite").parquet(f"{journal}/plan")
    fixed = spark.read.schema(JOURNAL.rsplit(",", 1)[0]).parquet(f"{journal}/plan")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = batch.to_pydict()
            outcomes = [carry_out_one(*x) for x in zip(table["path"], table["action"], table["target"], strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(outcomes, pa.string())], names=[*fields, "outcome"])

    fixed.repartition(F.xxhash64("path")).mapInArrow(run, JOURNAL).write.mode("overwrite").parquet(f"{journal}/done")
    return spark.read.schema(JOURNAL).parquet(f"{journal}/done")


def sweep_counts(journal: DataFrame) -> DataFrame:
    """Files and bytes per folder, policy, action and outcome."""
    folder = F.regexp_replace("path", "/[^/]*$", "")
    outcome = F.when(F.col("outcome").startswith("error"), "error").otherwise(F.col("outcome"))
    return journal.groupBy(folder.alias("folder"), "policy", "action", outcome.alias("outcome")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
