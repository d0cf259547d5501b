"""Sinks: alert and statistics documents, block state, history, counters."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S
from flowwarden.sources.readers import read_table

PART_ROWS = 10_000
FILE_DOCS = 500
FILE_ENTRIES = 10_000
COMPRESSION = "gzip"


def alert_documents(alerts: DataFrame, alert_flows: DataFrame, alert_targets: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Nested alert documents.

    `alert_flows` holds one row per (window_id, src_ip, flow) with `flow_index`; `alert_targets` one
    row per (window_id, src_ip, dst_ip, dst_port).  A flood may give an alert any number of flows,
    so an alert with more than `part_rows` of them becomes several documents (`part` 0, 1, ...) of
    about that size; together they hold every flow and target.
    """
    keys = ["window_id", "attacker_ip"]
    parts = F.greatest(F.ceil(F.col("total_flows") / F.lit(part_rows)), F.lit(1)).cast("int")
    sized = alerts.withColumn("parts", parts)
    counts = sized.select(*keys, "parts")
    flow = F.struct(
        F.col("flow_index").cast("bigint").alias("flow_index"),
        S.rounded("p", 4).alias("probability"),
        "src_ip",
        "dst_ip",
        "src_port",
        "dst_port",
        "protocol",
        F.col("flow_ts").alias("timestamp"),
        F.col("duration").alias("flow_duration"),
    )
    flows = (
        alert_flows.withColumn("attacker_ip", F.col("src_ip"))
        .join(counts, keys)
        .withColumn("part", F.pmod(F.xxhash64("flow_index"), F.col("parts")).cast("int"))
        .groupBy(*keys, "part")
        .agg(F.array_sort(F.collect_list(flow)).alias("flows"))
    )
    # First-seen order of the targets inside a document.
    target = F.struct(
        "first_seen", F.struct(F.col("dst_ip").alias("ip"), F.col("dst_port").alias("port"), "flow_count").alias("t")
    )
    targets = (
        alert_targets.withColumnRenamed("src_ip", "attacker_ip")
        .join(counts, keys)
        .withColumn("part", F.pmod(F.xxhash64("dst_ip", "dst_port"), F.col("parts")).cast("int"))
        .groupBy(*keys, "part")
        .agg(F.transform(F.array_sort(F.collect_list(target)), lambda x: x["t"]).alias("targets"))
    )
    spread = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return spread.join(flows, [*keys, "part"], "left").join(targets, [*keys, "part"], "left")


def stats_documents(stats: DataFrame, attackers: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Statistics documents with their attacker -> count map, in parts where it is long."""
    parts = F.greatest(F.ceil(F.col("unique_attackers") / F.lit(part_rows)), F.lit(1)).cast("int")
    sized = stats.withColumn("parts", parts)
    maps = (
        attackers.join(sized.select("window_id", "parts"), "window_id")
        .withColumn("part", F.pmod(F.xxhash64("src_ip"), F.col("parts")).cast("int"))
        .groupBy("window_id", "part")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("src_ip", "flow_count")))).alias("attackers"))
    )
    spread = sized.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    return spread.join(maps, ["window_id", "part"], "left")


def write_alerts(documents: DataFrame, path: str, compression: str = COMPRESSION) -> None:
    """One JSON document a line, in a folder per window; writing a window again replaces it.

    A file has a bounded number of documents, since the reader takes whole files.  Each document repeats its names and
    its window's files, so files are compressed (`none` gives plain text); the readers take both.
    """
    _replace_windows(documents, path, compression)


def write_stats(documents: DataFrame, path: str, compression: str = COMPRESSION) -> None:
    _replace_windows(documents, path, compression)


def _replace_windows(documents: DataFrame, path: str, compression: str) -> None:
    # Rows of a window come together first, so files follow windows, not tasks; execution splits a large one.
    together = documents.hint("rebalance", "window_id")
    writer = together.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_DOCS)
    writer.partitionBy("window_id").json(path, compression=compression)


def append_history(history: DataFrame, path: str, batch: str) -> None:
    """Closed blocks below the month in which they ended; writing a batch again replaces what it wrote."""
    writer = history.withColumn("batch", F.lit(batch)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("month", "batch").parquet(path)


def save_state(blocks: DataFrame, path: str, version: int) -> str:
    """Write the state table as a new version; the previous one stays readable meanwhile."""
    target = os.path.join(path, f"version={version}")
    blocks.write.mode("overwrite").parquet(target)
    return target


def upsert_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """Insert or replace by address (`changes` has one row per address)."""
    kept = state.join(changes.select("ip"), "ip", "left_anti")
    return kept.unionByName(changes.select(*state.columns))


def close_blocks(state: DataFrame, expired: DataFrame) -> DataFrame:
    """State without the blocks that were lifted."""
    return state.join(expired.select("ip"), "ip", "left_anti")


def write_whitelist(entries: DataFrame, path: str, file_entries: int = FILE_ENTRIES) -> None:
    """One JSON object with one entry a line, in files of a bounded number of entries; `read_whitelist` reads the folder.

    Columns besides `entry` (`reason`, `added`, `added_by`) are what is known about it; an entry that is null is left out.
    """
    about = F.struct(*[F.col(c) for c in entries.columns if c != "entry"])
    line = F.to_json(F.create_map("entry", about)).alias("value")
    entries.filter("entry is not null").select(line).write.option("maxRecordsPerFile", file_entries).text(path)


def write_counters(counters: DataFrame, path: str) -> None:
    counters.coalesce(1).write.mode("overwrite").json(path)


def load_state(spark, path: str, version: int, schema) -> DataFrame:
    return read_table(spark, os.path.join(path, f"version={version}"), schema)


def write_flow_csv(flows: DataFrame, path: str) -> None:
    flows.write.option("header", True).mode("overwrite").csv(path)
