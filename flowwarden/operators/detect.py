"""From scored flows to attacker groups, alerts and window statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S
from flowwarden.operators.features import side_by_side
from flowwarden.schema import ATTACK_TYPE, BUCKETS, DetectConfig

# Sum, extremes and histogram of a group of probabilities: every one can be merged again.
PARTIALS = ["flows", "p_sum", "p_min", "p_max"] + [f"b{i}" for i in range(len(BUCKETS))]


def hit_predicate(threshold: float, p: str = "p") -> Column:
    """Predicted class 1 (a tie goes to class 0) and probable enough."""
    return (F.col(p) > 0.5) & (F.col(p) >= threshold)


def hits(scored: DataFrame, config: DetectConfig = DetectConfig(), p: str = "p") -> DataFrame:
    kept = scored.filter(hit_predicate(config.threshold, p))
    return kept.filter(F.col("dst_port") == config.ssh_port) if config.ssh_only else kept


def hit_details(found: DataFrame, p: str = "p", keep: Sequence[str] = ()) -> DataFrame:
    """Hit columns with the defaults of absent values, and the probability's histogram key."""
    return found.select(
        *keep,
        S.or_default("src_ip", "unknown").alias("src_ip"),
        S.or_default("dst_ip", "unknown").alias("dst_ip"),
        S.or_default("src_port", 0).cast("int").alias("src_port"),
        S.or_default("dst_port", 0).cast("int").alias("dst_port"),
        S.or_default("protocol", 0).cast("int").alias("protocol"),
        S.or_default("flow_ts", "").alias("flow_ts"),
        S.or_default("duration", 0.0).cast("double").alias("duration"),
        F.col(p).alias("p"),
        S.rounded(p, 4).alias("probability"),
        S.confidence_bucket(p).alias("bucket"),
    )


def partials(found: DataFrame, by: Sequence[str], p: str = "p") -> DataFrame:
    """Mergeable summary of hits per group; a hot group collapses before the shuffle."""
    key = S.confidence_bucket(p)
    return found.groupBy(*by).agg(
        F.count(F.lit(1)).alias("flows"),
        F.sum(p).alias("p_sum"),
        F.min(p).alias("p_min"),
        F.max(p).alias("p_max"),
        *[F.count_if(key == name).alias(f"b{i}") for i, (name, _, _) in enumerate(BUCKETS)],
    )


def merge_partials(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by).agg(
        F.sum("flows").alias("flows"),
        F.sum("p_sum").alias("p_sum"),
        F.min("p_min").alias("p_min"),
        F.max("p_max").alias("p_max"),
        *[F.sum(f"b{i}").alias(f"b{i}") for i in range(len(BUCKETS))],
    )


def breakdown() -> Column:
    """Histogram map with all keys, from merged partials."""
    return F.map_from_arrays(
        F.array(*[F.lit(name) for name, _, _ in BUCKETS]),
        F.array(*[F.coalesce(F.col(f"b{i}"), F.lit(0)).cast("bigint") for i in range(len(BUCKETS))]),
    )


def confidence() -> Column:
    """The confidence block of alerts and statistics; zeros for an empty group."""
    mean = F.try_divide(F.col("p_sum"), F.col("flows").cast("double"))
    return F.struct(
        F.coalesce(S.rounded(mean, 4), F.lit(0.0)).alias("average"),
        F.coalesce(S.rounded("p_min", 4), F.lit(0.0)).alias("min"),
        F.coalesce(S.rounded("p_max", 4), F.lit(0.0)).alias("max"),
        breakdown().alias("breakdown"),
    )


def attacker_summary(found: DataFrame, by: Sequence[str] = (), ip: str = "src_ip") -> DataFrame:
    """Flow count and confidence block per attacker."""
    keys = [*by, ip]
    return partials(found, keys).select(*keys, F.col("flows").alias("total_flows"), confidence().alias("confidence"))


def confidence_histogram(found: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per histogram key (also the empty ones) and group."""
    merged = partials(found, by)
    pairs = [
        F.struct(F.lit(name).alias("bucket"), F.col(f"b{i}").alias("flows"))
        for i, (name, _, _) in enumerate(BUCKETS)
    ]
    return merged.select(*by, F.inline(F.array(*pairs)))


def flag_alerts(groups: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """Mark attacker groups that carry enough flows for an alert; the others are counted as skipped."""
    enough = F.col("flows") >= config.min_attack_flows
    return groups.withColumn("status", F.when(enough, "generated").otherwise("skipped"))


def alerts_from(groups: DataFrame, windows: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """Alert rows: merged partials per (window, attacker) plus what the window table knows."""
    kept = flag_alerts(groups, config).filter(F.col("status") == "generated")
    joined = kept.join(windows.select("window_id", "window_ts", "source_csvs"), "window_id")
    return joined.select(
        "window_id",
        S.alert_id("src_ip", "window_ts").alias("alert_id"),
        F.col("window_ts").alias("timestamp"),
        F.col("src_ip").alias("attacker_ip"),
        F.lit(ATTACK_TYPE).alias("attack_type"),
        S.severity("flows").alias("severity"),
        F.col("flows").alias("total_flows"),
        confidence().alias("confidence"),
        "source_csvs",
        S.alert_filename("src_ip", "window_ts").alias("alert_file"),
    )


def alert_skips(groups: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """Alerts generated and skipped per window."""
    flagged = flag_alerts(groups, config)
    return flagged.groupBy("window_id").agg(
        F.count_if(F.col("status") == "generated").alias("generated"),
        F.count_if(F.col("status") == "skipped").alias("skipped"),
    )


def targets(found: DataFrame, by: Sequence[str], seen: str) -> DataFrame:
    """Distinct (address, port) an attacker hit, with counts and the first sighting.

    Rows, not an array: an attacker may reach any number of targets.
    """
    return found.groupBy(*by, "dst_ip", "dst_port").agg(
        F.count(F.lit(1)).alias("flow_count"), F.min(seen).alias("first_seen")
    )


def merge_targets(parts: DataFrame, by: Sequence[str]) -> DataFrame:
    return parts.groupBy(*by, "dst_ip", "dst_port").agg(
        F.sum("flow_count").alias("flow_count"), F.min("first_seen").alias("first_seen")
    )


def window_attackers(groups: DataFrame) -> DataFrame:
    """The attacker -> flow count map of each window, as rows."""
    return groups.select("window_id", "src_ip", F.col("flows").alias("flow_count"))


def model_info(config: DetectConfig = DetectConfig()) -> Column:
    return F.struct(
        F.lit(config.model_type).alias("model_type"),
        F.lit(config.threshold).cast("double").alias("threshold"),
        F.lit(config.min_attack_flows).alias("min_attack_flows"),
        F.lit(config.window_mode).alias("window_mode"),
        F.lit(config.window_files).alias("window_size_minutes"),
    )


def window_stats(groups: DataFrame, windows: DataFrame, config: DetectConfig = DetectConfig()) -> DataFrame:
    """One statistics row per window with any hit, attackers below the alert minimum included."""
    counted = groups.withColumn("one", F.lit(1).cast("bigint"))
    merged = counted.groupBy("window_id").agg(
        F.sum("flows").alias("flows"),
        F.sum("p_sum").alias("p_sum"),
        F.min("p_min").alias("p_min"),
        F.max("p_max").alias("p_max"),
        *[F.sum(f"b{i}").alias(f"b{i}") for i in range(len(BUCKETS))],
        F.sum("one").alias("unique_attackers"),
    )
    joined = merged.join(windows, "window_id")
    name = F.concat(F.lit("window_"), F.size("source_csvs").cast("string"), F.lit("_csvs"))
    return joined.select(
        "window_id",
        F.col("window_ts").alias("timestamp"),
        name.alias("csv_filename"),
        "total_flows",
        F.col("flows").alias("attack_flows"),
        S.percent("flows", "total_flows").alias("attack_percentage"),
        "unique_attackers",
        confidence().alias("confidence"),
        model_info(config).alias("model"),
        "source_csvs",
        S.stats_filename(name, "window_ts").alias("stats_file"),
    )


def file_summary(flows: DataFrame, config: DetectConfig = DetectConfig(), by: str = "file") -> DataFrame:
    """Per file: flows, hits and distinct attackers, files without hits included."""
    hit = hit_predicate(config.threshold)
    # Group by attacker first, so that counting distinct attackers needs no second copy of the rows.
    per_attacker = flows.groupBy(by, "src_ip").agg(
        F.count(F.lit(1)).alias("flows"), F.count_if(hit).alias("hits")
    )
    return per_attacker.groupBy(by).agg(
        F.sum("flows").alias("total_flows"),
        F.sum("hits").alias("attack_flows"),
        F.count_if(F.col("hits") > 0).alias("unique_attackers"),
    )


def service_stats(
    groups: DataFrame, windows: DataFrame, config: DetectConfig, started: Column, now: Column
) -> DataFrame:
    """Counters of the detection service, one row."""
    per_window = windows.agg(
        F.count(F.lit(1)).alias("total_window_detections"),
        F.max("window_id").alias("last_window"),
        F.max_by("n_files", "window_id").alias("current_window_size"),
    )
    flagged = flag_alerts(groups, config).agg(
        F.coalesce(F.sum("flows"), F.lit(0)).alias("total_attacks_detected"),
        F.count_if(F.col("status") == "generated").alias("total_alerts_generated"),
        F.count_if(F.col("status") == "skipped").alias("total_alerts_skipped"),
    )
    both = side_by_side(per_window, flagged)
    processed = F.col("last_window") if config.window_mode == "rolling" else F.col("total_window_detections")
    return both.select(
        processed.cast("bigint").alias("total_processed"),
        "total_window_detections",
        "total_attacks_detected",
        "total_alerts_generated",
        "total_alerts_skipped",
        F.col("current_window_size").cast("bigint").alias("current_window_size"),
        S.elapsed_seconds(started, now).alias("uptime_seconds"),
    )
