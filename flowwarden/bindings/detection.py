"""Queries on hits, windows, alerts and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowwarden.bindings import base as B
from flowwarden.bindings.registry import query, sql_round, sql_ts, text_ts
from flowwarden.functions import scalars as S
from flowwarden.operators import detect as D
from flowwarden.operators import windows as W
from flowwarden.operators.features import ssh_flows
from flowwarden.schema import DetectConfig

CONFIG = DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES)
STRICT = DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES, min_attack_flows=3)


def _windowed(spark, sf, mode="rolling"):
    flows = B.flows(spark, sf)
    files = W.file_table(flows)
    groups = W.window_groups(D.hits(flows, CONFIG), files, B.N_FILES, mode)
    return files, groups, W.window_table(files, B.N_FILES, mode)


BUCKET_SQL = """CASE WHEN p >= 0.5 AND p < 0.6 THEN '0.50-0.60' WHEN p >= 0.6 AND p < 0.7 THEN '0.60-0.70'
  WHEN p >= 0.7 AND p < 0.8 THEN '0.70-0.80' WHEN p >= 0.8 AND p < 0.9 THEN '0.80-0.90'
  WHEN p >= 0.9 AND p <= 1.0 THEN '0.90-1.00' END"""


@query(
    "flow_hits",
    B.with_(B.FLOWS, B.HITS)
    + f"""SELECT event_id, file, src_ip, dst_ip, src_port, dst_port, protocol, flow_ts, duration,
  {sql_round('p', 4)} AS probability, {BUCKET_SQL} AS bucket FROM hits""",
)
def flow_hits(spark, sf):
    found = D.hits(B.flows(spark, sf), CONFIG)
    return D.hit_details(found, keep=["event_id", "file"]).drop("p")


@query("ssh_flows", B.with_(B.FLOWS) + "SELECT event_id, src_ip, dst_ip, dst_port, p FROM flows WHERE dst_port = 22")
def ssh(spark, sf):
    return ssh_flows(B.flows(spark, sf)).select("event_id", "src_ip", "dst_ip", "dst_port", "p")


@query(
    "file_detection_summary",
    B.with_(B.FLOWS)
    + f"""SELECT file, count(*) AS total_flows, count(*) FILTER (WHERE p > 0.5 AND p >= {B.THRESHOLD}) AS attack_flows,
  count(DISTINCT CASE WHEN p > 0.5 AND p >= {B.THRESHOLD} THEN src_ip END) AS unique_attackers
FROM flows GROUP BY file""",
)
def file_detection_summary(spark, sf):
    out = D.file_summary(B.flows(spark, sf), CONFIG)
    return out.select("file", "total_flows", "attack_flows", "unique_attackers")


@query("attacker_counts", B.with_(B.FLOWS, B.HITS) + "SELECT file, src_ip, count(*) AS flow_count FROM hits GROUP BY file, src_ip")
def attacker_counts(spark, sf):
    found = D.hits(B.flows(spark, sf), CONFIG)
    return D.attacker_summary(found, ["file"]).select("file", "src_ip", F.col("total_flows").alias("flow_count"))


@query("file_row_counts", B.with_(B.FLOWS, B.FILES) + "SELECT file, flow_count FROM files")
def file_row_counts(spark, sf):
    return W.file_table(B.flows(spark, sf)).select("file", "flow_count")


def _alerts_sql(slots: str) -> str:
    return (
        B.with_(B.FLOWS, B.HITS, B.FILES, slots, B.WINDOWS)
        + f"""SELECT window_id, 'SSH_BF_' || replace(src_ip, '.', '') || '_' || strftime(window_ts, '%Y%m%d%H%M%S') AS alert_id,
  {sql_ts('window_ts')} AS alert_ts, src_ip AS attacker_ip, 'SSH_BRUTE_FORCE' AS attack_type,
  {B.SEVERITY} AS severity, total_flows, conf_avg, conf_min, conf_max, b0, b1, b2, b3, b4, source_csvs
FROM (SELECT s.window_id, h.src_ip, count(*) AS total_flows, {B.CONFIDENCE}
      FROM hits h JOIN slots s ON h.file = s.file GROUP BY s.window_id, h.src_ip)
JOIN (SELECT window_id, window_ts, source_csvs FROM windows) USING (window_id)"""
    )


def _flat_alerts(alerts):
    return alerts.select(
        "window_id",
        "alert_id",
        text_ts("timestamp").alias("alert_ts"),
        "attacker_ip",
        "attack_type",
        "severity",
        "total_flows",
        *B.flat_confidence(),
        F.array_join("source_csvs", ",").alias("source_csvs"),
    )


@query("rolling_window_alerts", _alerts_sql(B.SLOTS))
def rolling_window_alerts(spark, sf):
    _, groups, windows = _windowed(spark, sf)
    return _flat_alerts(D.alerts_from(groups, windows, CONFIG))


@query("fixed_window_alerts", _alerts_sql(B.FIXED_SLOTS))
def fixed_window_alerts(spark, sf):
    _, groups, windows = _windowed(spark, sf, "fixed")
    return _flat_alerts(D.alerts_from(groups, windows, CONFIG))


@query(
    "time_window_attackers",
    B.with_(B.FLOWS, B.HITS)
    + f"""SELECT {sql_ts("time_bucket(INTERVAL 6 HOURS, ts)")} AS window_start, src_ip, count(*) AS total_flows,
  {B.CONFIDENCE} FROM hits GROUP BY 1, 2""",
)
def time_window_attackers(spark, sf):
    parts = W.time_windows(D.hits(B.flows(spark, sf), CONFIG), "ts", "6 hours")
    shaped = parts.select(
        text_ts("window.start").alias("window_start"), "src_ip", F.col("flows").alias("total_flows"), D.confidence().alias("confidence")
    )
    return shaped.select("window_start", "src_ip", "total_flows", *B.flat_confidence())


@query(
    "window_statistics",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS, B.WINDOWS)
    + f"""SELECT window_id, {sql_ts('window_ts')} AS stats_ts, 'window_' || n_files || '_csvs' AS csv_filename, total_flows,
  attack_flows, {sql_round('attack_flows * 100.0 / total_flows', 2)} AS attack_percentage, unique_attackers,
  conf_avg, conf_min, conf_max, b0, b1, b2, b3, b4, 'RandomForestClassifier' AS model_type, 'rolling' AS window_mode,
  'stats_window_' || n_files || '_csvs_' || strftime(window_ts, '%Y%m%d_%H%M%S') || '.json' AS stats_file
FROM (SELECT s.window_id, count(*) AS attack_flows, count(DISTINCT src_ip) AS unique_attackers, {B.CONFIDENCE}
      FROM hits h JOIN slots s ON h.file = s.file GROUP BY s.window_id)
JOIN windows USING (window_id)""",
)
def window_statistics(spark, sf):
    _, groups, windows = _windowed(spark, sf)
    stats = D.window_stats(groups, windows, CONFIG)
    return stats.select(
        "window_id",
        text_ts("timestamp").alias("stats_ts"),
        "csv_filename",
        "total_flows",
        "attack_flows",
        "attack_percentage",
        "unique_attackers",
        *B.flat_confidence(),
        "model.model_type",
        "model.window_mode",
        "stats_file",
    )


@query(
    "window_sources",
    B.with_(B.FLOWS, B.FILES, B.SLOTS, B.WINDOWS) + "SELECT window_id, n_files, total_flows, source_csvs FROM windows",
)
def window_sources(spark, sf):
    _, _, windows = _windowed(spark, sf)
    return windows.select("window_id", "n_files", "total_flows", F.array_join("source_csvs", ",").alias("source_csvs"))


@query(
    "window_attackers",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS)
    + "SELECT window_id, src_ip, count(*) AS flow_count FROM hits h JOIN slots s ON h.file = s.file GROUP BY window_id, src_ip",
)
def window_attackers(spark, sf):
    _, groups, windows = _windowed(spark, sf)
    return D.window_attackers(W.existing_windows(groups, windows))


@query(
    "alert_targets",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS)
    + """SELECT window_id, src_ip, dst_ip, dst_port, count(*) AS flow_count,
  min({'s': file_seq, 'e': event_id}).s AS first_file, min({'s': file_seq, 'e': event_id}).e AS first_event
FROM hits h JOIN slots s ON h.file = s.file GROUP BY window_id, src_ip, dst_ip, dst_port""",
)
def alert_targets(spark, sf):
    flows = B.flows(spark, sf)
    files = W.file_table(flows)
    found = W.window_targets(D.hits(flows, CONFIG), files, B.N_FILES, "event_id")
    kept = W.existing_windows(found, W.window_table(files, B.N_FILES))
    return kept.select(
        "window_id",
        "src_ip",
        "dst_ip",
        "dst_port",
        "flow_count",
        F.col("first_seen.file_seq").alias("first_file"),
        F.col("first_seen.first_seen").alias("first_event"),
    )


@query(
    "confidence_histogram",
    B.with_(B.FLOWS, B.HITS)
    + """, keys(bucket) AS (VALUES ('0.50-0.60'), ('0.60-0.70'), ('0.70-0.80'), ('0.80-0.90'), ('0.90-1.00'))
SELECT f.file, k.bucket, count(h.event_id) AS flows
FROM (SELECT DISTINCT file FROM hits) f CROSS JOIN keys k
LEFT JOIN hits h ON h.file = f.file AND k.bucket = """.replace(", keys", ",\nkeys", 1)
    + BUCKET_SQL.replace("p ", "h.p ")
    + " GROUP BY f.file, k.bucket",
)
def confidence_histogram(spark, sf):
    return D.confidence_histogram(D.hits(B.flows(spark, sf), CONFIG), ["file"])


@query(
    "alert_skips",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS)
    + """SELECT window_id, count(*) FILTER (WHERE n >= 3) AS generated, count(*) FILTER (WHERE n < 3) AS skipped
FROM (SELECT window_id, src_ip, count(*) AS n FROM hits h JOIN slots s ON h.file = s.file GROUP BY window_id, src_ip)
GROUP BY window_id""",
)
def alert_skips(spark, sf):
    _, groups, windows = _windowed(spark, sf)
    return D.alert_skips(W.existing_windows(groups, windows), STRICT)


@query(
    "service_stats",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS, B.WINDOWS)
    + """, g AS (SELECT window_id, src_ip, count(*) AS n FROM hits h JOIN slots s ON h.file = s.file GROUP BY window_id, src_ip)
SELECT (SELECT count(*) FROM files) AS total_processed, (SELECT count(*) FROM windows) AS total_window_detections,
  CAST((SELECT sum(n) FROM g) AS BIGINT) AS total_attacks_detected,
  (SELECT count(*) FROM g WHERE n >= 3) AS total_alerts_generated, (SELECT count(*) FROM g WHERE n < 3) AS total_alerts_skipped,
  (SELECT arg_max(n_files, window_id) FROM windows) AS current_window_size, CAST(2592000 AS BIGINT) AS uptime_seconds""",
)
def service_stats(spark, sf):
    _, groups, windows = _windowed(spark, sf)
    started, now = F.to_timestamp(F.lit("2024-01-01 00:00:00")), F.to_timestamp(F.lit("2024-01-31 00:00:00"))
    return D.service_stats(W.existing_windows(groups, windows), windows, STRICT, started, now)


@query(
    "flow_positions",
    B.with_(B.FLOWS, B.FILES, B.SLOTS)
    + """, offsets AS (
  SELECT window_id, file, coalesce(sum(flow_count) OVER (PARTITION BY window_id ORDER BY file_seq
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM slots),
placed AS (SELECT event_id, file, row_number() OVER (PARTITION BY file ORDER BY event_id) - 1 AS row_pos FROM flows)
SELECT window_id, event_id, CAST(before + row_pos AS BIGINT) AS flow_index FROM placed JOIN offsets USING (file)""",
)
def flow_positions(spark, sf):
    from flowwarden.operators.positions import ordered_position

    flows = B.flows(spark, sf).select("event_id", "file")
    files = W.file_table(flows)
    placed = ordered_position(flows, ["event_id"], ["file"], name="row_pos").withColumn("row_pos", F.col("row_pos") - 1)
    return W.flow_index(placed, files, B.N_FILES).select("window_id", "event_id", "flow_index")


@query(
    "file_sequence",
    B.with_(B.FLOWS, B.FILES)
    + f"""SELECT file, {sql_ts('capture_ts')} AS capture_ts, file_seq, flow_count,
  replace(file, '.csv', '') AS stem, replace(file, '_Flow.csv', '') AS capture FROM files""",
)
def file_sequence(spark, sf):
    files = W.file_table(B.flows(spark, sf))
    return files.select(
        "file",
        text_ts("capture_ts").alias("capture_ts"),
        "file_seq",
        "flow_count",
        S.stem("file").alias("stem"),
        F.regexp_replace(S.base_name("file"), "_Flow\\.csv$", "").alias("capture"),
    )


@query(
    "alert_names",
    B.with_(B.FLOWS, B.HITS)
    + """SELECT event_id, 'SSH_BF_' || replace(src_ip, '.', '') || '_' || strftime(ts, '%Y%m%d%H%M%S') AS alert_id,
  'alert_' || replace(src_ip, '.', '_') || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS alert_file,
  'stats_' || replace(file, '.csv', '') || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS stats_file,
  strftime(ts, '%Y-%m-%dT%H:%M:%S') || CASE WHEN strftime(ts, '%f') = '000000' THEN '' ELSE '.' || strftime(ts, '%f') END AS iso
FROM hits""",
)
def alert_names(spark, sf):
    found = D.hits(B.flows(spark, sf), CONFIG)
    return found.select(
        "event_id",
        S.alert_id("src_ip", "ts").alias("alert_id"),
        S.alert_filename("src_ip", "ts").alias("alert_file"),
        S.stats_filename("file", "ts").alias("stats_file"),
        S.iso_format("ts").alias("iso"),
    )


@query(
    "severity_by_attacker",
    B.with_(B.FLOWS, B.HITS)
    + f"""SELECT src_ip, total_flows, {B.SEVERITY} AS severity, conf_avg, conf_min, conf_max, b0, b1, b2, b3, b4
FROM (SELECT src_ip, count(*) AS total_flows, {B.CONFIDENCE} FROM hits GROUP BY src_ip)""",
)
def severity_by_attacker(spark, sf):
    out = D.attacker_summary(D.hits(B.flows(spark, sf), CONFIG))
    return out.select("src_ip", "total_flows", S.severity("total_flows").alias("severity"), *B.flat_confidence())
