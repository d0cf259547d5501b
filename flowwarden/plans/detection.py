"""Scored flows -> everything the detection service reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowwarden.operators import detect as D
from flowwarden.operators import windows as W
from flowwarden.operators.features import align_features
from flowwarden.operators.forest import score
from flowwarden.schema import DetectConfig
from flowwarden.session import durable
from flowwarden.sources import writers

IDENTITY_COLUMNS = ["src_ip", "dst_ip", "src_port", "dst_port", "protocol", "flow_ts", "duration", "file"]


def score_flows(model: PipelineModel, flows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Align, clean and score flow files; works on a batch and on a stream."""
    columns = [*IDENTITY_COLUMNS, *keep]
    return score(model, align_features(flows, keep=columns)).select(*columns, "p", "pred")


@dataclass
class Detection:
    """Results of one detection run, from hits and counts that are written already."""

    files: DataFrame
    windows: DataFrame
    hits: DataFrame
    groups: DataFrame
    alerts: DataFrame
    skips: DataFrame
    stats: DataFrame


def detect(
    scored: DataFrame, config: DetectConfig = DetectConfig(), files: DataFrame | None = None, dedupe: bool = False
) -> Detection:
    """Hits, windows, alerts and statistics.  `files` lists all capture files where some hold no rows;
    `dedupe` keeps, per rolling window, the attackers with hits in its newest file.

    Flows are scored once: hits, and counts per file, are written to the shared folder, and everything else
    is built from those (so jobs run here).
    """
    n, mode = config.window_files, config.window_mode
    found = durable(D.hits(scored, config))
    table = durable(W.file_table(scored, files))
    windows = W.window_table(table, n, mode)
    per_file = durable(D.partials(found, ["file", "src_ip"]))
    groups = W.rolling_file_window(per_file, table, n, ["src_ip"], mode)
    if dedupe and mode == "rolling":
        groups = W.fresh_attackers(groups, per_file, table)
    kept = W.existing_windows(groups, windows)
    return Detection(
        files=table,
        windows=windows,
        hits=found,
        groups=kept,
        alerts=D.alerts_from(groups, windows, config),
        skips=D.alert_skips(kept, config),
        stats=D.window_stats(kept, windows, config),
    )


def write_documents(run: Detection, alerts_path: str, stats_path: str, config: DetectConfig = DetectConfig()) -> None:
    """Nested alert and statistics documents.  The hits carry `row_pos`, their position in the file."""
    n, mode = config.window_files, config.window_mode
    detail = W.flow_index(run.hits, run.files, n, mode)
    targets = W.window_targets(run.hits, run.files, n, "row_pos", mode)
    writers.write_alerts(writers.alert_documents(run.alerts, detail, targets), alerts_path)
    writers.write_stats(writers.stats_documents(run.stats, D.window_attackers(run.groups)), stats_path)


def detect_per_file(scored: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """The other grouping of the same hits: one summary row per file."""
    return D.file_summary(scored, config).withColumn(
        "attack_percentage", F.coalesce(F.try_divide(F.col("attack_flows") * 100.0, F.col("total_flows")), F.lit(0.0))
    )
