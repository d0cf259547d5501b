"""Keyed state as bucketed snapshots with a change log.

A batch writes its changes only: one log folder a version, split by bucket, so a bucket that no change
falls into gets no file.  Reading merges a bucket's snapshot with the newer log entries, the newest row of
a key winning.  Compaction rewrites the buckets with the longest logs and leaves the others where they are.  A small
document a version says which snapshot each bucket has; a version that is written again replaces itself.
"""

from __future__ import annotations

import json
import os
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 64
#: Log entries after which a bucket is worth rewriting.
LOG_LIMIT = 8


class StateTable:
    """State below one folder: `log/version=V/bucket=B`, `snapshot/version=V/bucket=B` and `versions/version=V`."""

    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType, key: str = "ip", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets
        self.schema = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    # --- versions -------------------------------------------------------------------------------

    def _versions(self) -> dict[int, dict]:
        """What is known of each version: the snapshot of every bucket, and the buckets that its log holds."""
        try:
            rows = self.spark.read.schema("value string, version bigint").text(self._at("versions")).collect()
        except AnalysisException:
            return {}
        return {r["version"]: json.loads(r["value"]) for r in rows}

    def _upto(self, version: int | None) -> tuple[int, dict[int, int], dict[int, list[int]]]:
        """The newest version, the snapshot of each bucket, and the log versions that follow it."""
        known = {v: about for v, about in self._versions().items() if version is None or v <= version}
        if not known:
            return -1, {}, {}
        newest = max(known)
        snapshots = {int(b): v for b, v in known[newest]["snapshots"].items()}
        logs: dict[int, list[int]] = {}
        for v in sorted(known):
            for b in known[v]["touched"]:
                if v > snapshots.get(b, -1):
                    logs.setdefault(b, []).append(v)
        return newest, snapshots, logs

    def _note(self, version: int, snapshots: dict[int, int], touched: Sequence[int]) -> None:
        text = json.dumps({"snapshots": snapshots, "touched": sorted(touched)})
        one = self.spark.range(1).select(F.lit(text).alias("value"))
        one.coalesce(1).write.mode("overwrite").text(self._at("versions", f"version={version}"))

    # --- writing --------------------------------------------------------------------------------

    def apply(self, version: int, changes: DataFrame | None = None, gone: DataFrame | None = None) -> list[int]:
        """Writes a version: new or replaced rows of `changes`, and keys of `gone` that leave (one row a key in both together).

        Versions rise; the same version may be written again.  Returns the buckets that were written.
        """
        empty = self.spark.createDataFrame([], self.schema)
        rows = (changes if changes is not None else empty).select(*self.schema.names, F.lit(False).alias("_gone"))
        if gone is not None:
            absent = [F.lit(None).cast(f.dataType).alias(f.name) if f.name != self.key else F.col(f.name) for f in self.schema.fields]
            rows = rows.unionByName(gone.select(*absent, F.lit(True).alias("_gone")))
        _, snapshots, _ = self._upto(version - 1)
        target = self._at("log", f"version={version}")
        # Rows of a bucket come together, so a bucket has few files; execution splits a large one.
        rows.withColumn("bucket", self._bucket()).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
        touched = self._partitions(target)
        self._note(version, snapshots, touched)
        return touched

    def _partitions(self, folder: str) -> list[int]:
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(folder)
        listed = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).listStatus(at)
        names = [s.getPath().getName() for s in listed]
        return sorted(int(n.removeprefix("bucket=")) for n in names if n.startswith("bucket="))

    def compact(self, least: int = LOG_LIMIT) -> list[int]:
        """Rewrites the buckets with at least `least` log entries; returns them.  The state does not change."""
        newest, snapshots, logs = self._upto(None)
        heavy = sorted(b for b, versions in logs.items() if len(versions) >= least)
        if not heavy:
            return []
        target = self._at("snapshot", f"version={newest}")
        merged = self._merged(newest, snapshots, {b: logs[b] for b in heavy}, heavy)
        merged.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(target)
        touched = self._versions()[newest]["touched"]
        self._note(newest, snapshots | dict.fromkeys(heavy, newest), touched)
        return heavy

    # --- reading --------------------------------------------------------------------------------

    def _part(self, folder: str, wanted: dict[int, list[int]], extra: str = "") -> DataFrame:
        """Rows of (version, buckets) as a partition filter; nothing else is listed or read."""
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema.fields)
        schema = f"{fields}{extra}, version bigint, bucket int"
        paths = [self._at(folder, f"version={v}") for v in sorted(wanted)]
        # A bucket that compaction left without rows has no folder, and a version may have no bucket at all.
        if not paths:
            return self.spark.createDataFrame([], schema)
        chosen = F.lit(False)
        for v, buckets in wanted.items():
            chosen = chosen | ((F.col("version") == v) & F.col("bucket").isin(buckets))
        return self.spark.read.schema(schema).option("basePath", self._at(folder)).parquet(*paths).filter(chosen)

    def _merged(self, newest: int, snapshots: dict[int, int], logs: dict[int, list[int]], buckets: Sequence[int] | None = None) -> DataFrame:
        def by_version(pairs) -> dict[int, list[int]]:
            out: dict[int, list[int]] = {}
            for b, v in pairs:
                if buckets is None or b in buckets:
                    out.setdefault(v, []).append(b)
            return out

        base = self._part("snapshot", by_version((b, v) for b, v in snapshots.items())).withColumn("_gone", F.lit(False))
        log = self._part("log", by_version((b, v) for b, versions in logs.items() for v in versions), ", _gone boolean")
        record = F.struct(*self.schema.names, "_gone")
        newest_row = base.unionByName(log).groupBy("bucket", self.key).agg(F.max_by(record, "version").alias("r"))
        return newest_row.select("bucket", "r.*").filter(~F.col("_gone")).drop("_gone")

    def read(self, version: int | None = None) -> DataFrame:
        """The state as of a version (the newest by default); empty where nothing was written.

        An older version can be read until a compaction has merged newer changes into its buckets.
        """
        newest, snapshots, logs = self._upto(version)
        return self._merged(newest, snapshots, logs).drop("bucket").select(*self.schema.names)
