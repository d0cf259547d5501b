"""Session helpers: durable materialisation and small constant tables."""

from __future__ import annotations

import os
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Largest side that is broadcast without asking the optimiser (rows of a few dozen bytes).
BROADCAST_ROWS = 100_000


def shared_dir(spark: SparkSession) -> str:
    """The shared folder that `spark.checkpoint.dir` names; where it is unset, a folder of the warehouse that all executors reach."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured:
        return configured
    warehouse = spark.conf.get("spark.sql.warehouse.dir", None)
    local = not warehouse or warehouse.startswith(("file:", "/"))
    if not warehouse or (local and not context.master.startswith("local")):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{warehouse.rstrip('/')}/flowwarden-scratch"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so nothing has to be cleared."""
    return os.path.join(shared_dir(spark), f"flowwarden-{name}-{uuid.uuid4().hex}")


def durable(df: DataFrame) -> DataFrame:
    """Materialise `df` in the shared folder, cutting lineage in a way that survives lost executors.

    Used where a value (a range-chunk number) must be the same in every later use of the rows.  The
    table goes away when the session ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "table")
    df.write.parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


def local_column(spark: SparkSession, name: str, values: list) -> DataFrame:
    """A small constant table that the optimiser knows as such (no job, no Python worker)."""
    kind = pa.int64() if values and isinstance(values[0], int) else pa.string()
    return spark.createDataFrame(pa.table({name: pa.array(values, kind)}))
