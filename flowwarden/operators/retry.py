"""Retry queue of failed blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.operators.whitelist import flag_whitelisted
from flowwarden.schema import RetryConfig


def _later(now: Column, config: RetryConfig) -> Column:
    return now + F.make_dt_interval(secs=F.lit(config.interval_seconds))


def enqueue(queue: DataFrame, failed: DataFrame, now: Column, config: RetryConfig = RetryConfig()) -> DataFrame:
    """Put failed blocks into the queue; an address that is queued already is replaced.

    `failed` holds ip, tier, alias, confidence, flows, alert_file and ts; of several failures of
    one address the last one counts (a map-side max, so a hot address costs nothing extra).
    """
    record = F.struct("tier", "alias", "confidence", "flows", "alert_file")
    newest = failed.groupBy("ip").agg(F.max_by(record, F.struct("ts", "alert_file")).alias("r"))
    fresh = newest.select(
        "ip",
        "r.*",
        now.alias("blocked_at"),
        F.lit(1).alias("attempts"),
        now.alias("last_attempt"),
        _later(now, config).alias("next_retry"),
    )
    kept = queue.join(fresh.select("ip"), "ip", "left_anti")
    return kept.unionByName(fresh)


def retry_step(
    queue: DataFrame,
    outcomes: DataFrame,
    now: Column,
    config: RetryConfig = RetryConfig(),
    whitelist: DataFrame | None = None,
) -> DataFrame:
    """One pass over the queue.  `outcomes` (ip, success) tells how this pass's attempts went.

    `result` is waiting, gave_up, whitelisted, blocked or requeued; rows that are waiting or
    requeued form the next queue.
    """
    if whitelist is not None:
        queue = flag_whitelisted(queue, whitelist)
    else:
        queue = queue.withColumn("whitelisted", F.lit(False))
    joined = queue.join(outcomes.select("ip", "success"), "ip", "left")
    result = (
        F.when(F.col("next_retry") > now, "waiting")
        .when(F.col("attempts") >= config.max_attempts, "gave_up")
        .when(F.col("whitelisted"), "whitelisted")
        .when(F.coalesce("success", F.lit(False)), "blocked")
        .otherwise("requeued")
    )
    tried = F.col("result") == "requeued"
    return (
        joined.withColumn("result", result)
        .withColumn("attempts", F.when(tried, F.col("attempts") + 1).otherwise(F.col("attempts")))
        .withColumn("last_attempt", F.when(tried, now).otherwise(F.col("last_attempt")))
        .withColumn("next_retry", F.when(tried, _later(now, config)).otherwise(F.col("next_retry")))
        .drop("whitelisted", "success")
    )


def next_queue(step: DataFrame) -> DataFrame:
    return step.filter(F.col("result").isin("waiting", "requeued")).drop("result")
