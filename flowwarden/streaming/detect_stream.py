"""Detection on streams of flow files.

A window counts files, so one attacker's windows move on with files that do not mention it.  The
stream therefore keeps per-file partials in a table instead of keyed state: each micro-batch adds
its files' partials, reads those of the few files before it, and writes the windows that end in it.
Every write replaces the output of its own batch, so a repeated batch changes nothing.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from flowwarden.functions import scalars as S
from flowwarden.operators import detect as D
from flowwarden.operators import windows as W
from flowwarden.schema import BUCKETS, DetectConfig
from flowwarden.sources.readers import read_table

FILES_SCHEMA = "file string, flow_count bigint, capture_ts timestamp, file_seq bigint, origin bigint"
PARTIALS_SCHEMA = (
    "file string, src_ip string, all_flows bigint, flows bigint, p_sum double, p_min double, p_max double, "
    + ", ".join(f"b{i} bigint" for i in range(len(BUCKETS)))
)


def _file_partials(batch: DataFrame, config: DetectConfig) -> DataFrame:
    """Sums per (file, attacker); a row that is no flow only says that its file is there."""
    is_flow = F.col("is_flow") if "is_flow" in batch.columns else F.lit(True)
    hit = D.hit_predicate(config.threshold) & is_flow
    if config.ssh_only:
        hit = hit & (F.col("dst_port") == config.ssh_port)
    key = S.confidence_bucket("p")
    p = F.when(hit, F.col("p"))
    return batch.groupBy("file", "src_ip").agg(
        F.count_if(is_flow).alias("all_flows"),
        F.count_if(hit).alias("flows"),
        F.sum(p).alias("p_sum"),
        F.min(p).alias("p_min"),
        F.max(p).alias("p_max"),
        *[F.count_if(hit & (key == name)).alias(f"b{i}") for i, (name, _, _) in enumerate(BUCKETS)],
    )


def retire(spark: SparkSession, folder: str, key: str, before: int) -> None:
    """Deletes the subfolders `key`=N with N below a bound; there are few, as each step leaves few behind."""
    at = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = at.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in system.listStatus(at):
        name = status.getPath().getName()
        if name.startswith(f"{key}=") and int(name.split("=", 1)[1]) < before:
            system.delete(status.getPath(), True)


class RollingAlerts:
    """Tables of a running detection below one folder, and the step that a micro-batch takes."""

    def __init__(self, path: str, config: DetectConfig = DetectConfig(), dedupe: bool = False):
        self.path = path
        self.config = config
        self.dedupe = dedupe

    def _at(self, *parts: str) -> str:
        return os.path.join(self.path, *parts)

    def step(self, batch: DataFrame, batch_id: int) -> None:
        spark, n, mode = batch.sparkSession, self.config.window_files, self.config.window_mode
        mine_at = self._at("partials", f"batch_id={batch_id}")
        _file_partials(batch, self.config).write.mode("overwrite").parquet(mine_at)
        mine = read_table(spark, mine_at, PARTIALS_SCHEMA)

        # Each batch leaves the few newest files behind for the next one, so a step costs the same
        # however long the stream has been running.
        known = read_table(spark, self._at("files", f"batch_id={batch_id - 1}"), FILES_SCHEMA)
        last = known.agg(F.max("file_seq").alias("m")).first()["m"] or 0
        counted = mine.groupBy("file").agg(F.sum("all_flows").alias("flow_count"))
        fresh = counted.join(known.select("file"), "file", "left_anti")
        numbered = W.file_sequence(fresh).withColumn("file_seq", F.col("file_seq") + F.lit(last))
        both = known.unionByName(numbered.withColumn("origin", F.lit(batch_id).cast("bigint")))
        files_at = self._at("files", f"batch_id={batch_id}")
        both.filter(F.col("file_seq") > last - max(n - 1, 1)).write.mode("overwrite").parquet(files_at)
        files = read_table(spark, files_at, FILES_SCHEMA).filter(F.col("file_seq") > last - (n - 1))
        # Those files came with this batch or one of the n - 1 before it that brought any.
        origins = sorted(r["origin"] for r in files.select("origin").distinct().collect())
        if batch_id not in origins:
            return
        stored = spark.read.schema(PARTIALS_SCHEMA).parquet(*[self._at("partials", f"batch_id={i}") for i in origins])
        per_file = stored.filter(F.col("flows") > 0)
        first_window = F.lit(last + 1) if mode == "rolling" else W.window_ids("fixed", n, "next")[0]
        windows = W.window_table(files, n, mode).withColumn("next", F.lit(last + 1).cast("bigint"))
        windows = windows.filter(F.col("window_id") >= first_window).drop("next")
        groups = W.rolling_file_window(per_file, files, n, ["src_ip"], mode)
        if self.dedupe and mode == "rolling":
            groups = W.fresh_attackers(groups, per_file, files)
        alerts = D.alerts_from(groups, windows, self.config)
        stats = D.window_stats(W.existing_windows(groups, windows), windows, self.config)
        for rows, name in ((alerts, "alerts"), (stats, "stats")):
            rows.write.mode("overwrite").parquet(self._at(name, f"batch_id={batch_id}"))
        # What a repeat of this batch, or the next one, reads is kept; older partials have left all windows.
        retire(spark, self._at("partials"), "batch_id", origins[0])
        retire(spark, self._at("files"), "batch_id", batch_id - 1)

    def _windows(self, spark, name: str) -> DataFrame:
        """Rows of every window from the last batch that wrote it: a fixed window grows over several batches."""
        stored = spark.read.parquet(self._at(name))
        last = stored.groupBy("window_id").agg(F.max("batch_id").alias("batch_id"))
        return stored.join(last, ["window_id", "batch_id"], "left_semi").drop("batch_id")

    def alerts(self, spark) -> DataFrame:
        return self._windows(spark, "alerts")

    def stats(self, spark) -> DataFrame:
        return self._windows(spark, "stats")


def alert_stream(
    scored: DataFrame,
    path: str,
    checkpoint: str,
    config: DetectConfig = DetectConfig(),
    dedupe: bool = False,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Alerts and statistics per window from a stream of scored flows."""
    target = RollingAlerts(path, config, dedupe)
    writer = scored.writeStream.foreachBatch(target.step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


def time_window_stream(found: DataFrame, ts: str, width: str, late: str, ip: str = "src_ip") -> DataFrame:
    """Attackers per window of event time on a stream; closed windows are final after `late`."""
    timed = found.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, late)  # a stream needs a zoned time
    return W.time_windows(timed, ts, width, ip=ip)


def progress_counters(query: StreamingQuery) -> dict[str, int]:
    """Batches and input rows of a running query, from its own progress reports."""
    reports = query.recentProgress
    return {"batches": len(reports), "rows": sum(r["numInputRows"] for r in reports)}


