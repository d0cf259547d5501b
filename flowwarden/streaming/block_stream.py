"""Block policy on streams of alerts.

Two steps.  Intake judges each alert against a whitelist that is read anew for every micro-batch,
logs the verdicts, and sums accepted alerts up per (address, slice of time).  The block step keeps
one record per address in the state store and works through those sums, so a flood of alerts from
one address reaches its state as a few rows.
"""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from flowwarden.functions import scalars as S
from flowwarden.operators.blocks import _slice, alert_intake
from flowwarden.schema import CONFIDENCE_FLOOR, TIERS, Tier
from flowwarden.sources.readers import read_table
from flowwarden.streaming.detect_stream import retire

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

SLICE_FIELDS = (
    "ip string, slice bigint, alerts bigint, first_ts timestamp, first_id {id}, first_tier string, first_confidence double, "
    "first_flows bigint, first_file string, last_ts timestamp, last_tier string, source_batch bigint, clock timestamp"
)
# Inside the state machine a time is its microseconds, which knows no time zone.
ACTION_FIELDS = (
    "ip string, episode bigint, action string, ts bigint, alerts bigint, attempt_count bigint, tier string, alias string, "
    "blocked_at bigint, unblock_at bigint, last_attempt bigint, confidence_avg double, total_flows bigint, "
    "alert_id {id}, alert_file string"
)
TIMES = ("ts", "blocked_at", "unblock_at", "last_attempt")


def accepted_slices(accepted: DataFrame, tiers: Iterable[Tier] = TIERS, floor: float = CONFIDENCE_FLOOR) -> DataFrame:
    """Accepted alerts summed up per (address, slice)."""
    tiers = tuple(tiers)
    tiered = accepted.withColumn("tier", S.tier_of("confidence", tiers, floor)).filter(F.col("tier").isNotNull())
    order = F.struct("ts", "alert_id")
    opening = F.struct("ts", "alert_id", "tier", "confidence", "total_flows", "alert_file")
    sums = tiered.groupBy("ip", _slice("ts", tiers).alias("slice")).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min_by(opening, order).alias("f"),
        F.max_by(F.struct("ts", "tier"), order).alias("l"),
    )
    return sums.select(
        "ip", "slice", "alerts", F.col("f.ts").alias("first_ts"), F.col("f.alert_id").alias("first_id"),
        F.col("f.tier").alias("first_tier"), F.col("f.confidence").alias("first_confidence"),
        F.col("f.total_flows").alias("first_flows"), F.col("f.alert_file").alias("first_file"),
        F.col("l.ts").alias("last_ts"), F.col("l.tier").alias("last_tier"),
    )


def verdicts(spark: SparkSession, path: str, alerts: T.StructType) -> DataFrame:
    """The logged verdicts of an intake whose alerts have the given schema."""
    schema = T.StructType([*alerts.fields, T.StructField("status", T.StringType())])
    return spark.read.schema(schema).parquet(os.path.join(path, "verdicts"))


class Intake:
    """Tables of the intake step below one folder: `verdicts` and `slices`."""

    def __init__(
        self, path: str, whitelist: Callable[[SparkSession], DataFrame], tiers: Iterable[Tier] = TIERS, floor: float = CONFIDENCE_FLOOR,
        parsed_only: bool = True,
    ):
        self.path = path
        self.whitelist = whitelist
        self.tiers = tuple(tiers)
        self.floor = floor
        self.parsed_only = parsed_only

    def step(self, batch: DataFrame, batch_id: int) -> None:
        verdicts = os.path.join(self.path, "verdicts", f"batch_id={batch_id}")
        judged = alert_intake(batch, self.whitelist(batch.sparkSession), self.floor, parsed_only=self.parsed_only)
        judged.write.mode("overwrite").parquet(verdicts)
        stored = batch.sparkSession.read.schema(judged.schema).parquet(verdicts)
        accepted = stored.filter(F.col("status") == "accepted")
        sums = accepted_slices(accepted, self.tiers, self.floor).withColumn("source_batch", F.lit(batch_id).cast("bigint"))
        # All rows of an address go to one file, so the block step takes a batch's share as a whole.
        whole = sums.withColumn("clock", F.timestamp_micros(F.lit(self._clock(accepted, batch_id)).cast("bigint"))).repartition("ip")
        whole.write.mode("overwrite").parquet(os.path.join(self.path, "slices", f"batch_id={batch_id}"))

    def _clock(self, accepted: DataFrame, batch_id: int) -> int | None:
        """Newest alert time of this batch and all before it, in microseconds.

        It never goes back, so the block step can take it for event time: however late an alert
        arrives, its row is not late for the engine and is not dropped.
        """
        spark = accepted.sparkSession
        schema = "micros bigint"
        before = read_table(spark, os.path.join(self.path, "clock", f"batch_id={batch_id - 1}"), schema)
        newest = before.unionByName(accepted.select(F.unix_micros("ts").alias("micros"))).agg(F.max("micros").alias("micros"))
        at = os.path.join(self.path, "clock", f"batch_id={batch_id}")
        newest.coalesce(1).write.mode("overwrite").parquet(at)
        retire(spark, os.path.join(self.path, "clock"), "batch_id", batch_id - 1)
        return spark.read.schema(schema).parquet(at).first()["micros"]


def intake_stream(
    alerts: DataFrame,
    path: str,
    checkpoint: str,
    whitelist: Callable[[SparkSession], DataFrame],
    tiers: Iterable[Tier] = TIERS,
    trigger: dict | None = None,
    floor: float = CONFIDENCE_FLOOR,
    parsed_only: bool = True,
) -> StreamingQuery:
    """Judge a stream of alerts (ip, ts, alert_id, confidence, total_flows, alert_file); `parsed_only` as in `alert_intake`."""
    target = Intake(path, whitelist, tiers, floor, parsed_only)
    writer = alerts.writeStream.foreachBatch(target.step).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"availableNow": True})).start()


class BlockMachine(StatefulProcessor):
    """Block, reset and unblock per address, with an event-time timer at the end of a block."""

    def __init__(self, tiers: Iterable[Tier], id_type: str):
        self.seconds = {t.name: t.seconds for t in tiers}
        self.alias = {t.name: t.alias for t in tiers}
        self.id_type = id_type

    def init(self, handle) -> None:
        self.handle = handle
        id_type = T.LongType() if self.id_type == "bigint" else T.StringType()
        fields = [
            ("is_open", T.BooleanType()), ("episode", T.LongType()), ("source_batch", T.LongType()), ("attempts", T.LongType()),
            ("tier", T.StringType()), ("blocked_at", T.LongType()), ("unblock_at", T.LongType()),
            ("last_us", T.LongType()), ("confidence", T.DoubleType()), ("flows", T.LongType()), ("alert_id", id_type),
            ("alert_file", T.StringType()),
        ]
        self.names = [n for n, _ in fields]
        self.state = handle.getValueState("block", T.StructType([T.StructField(n, t, True) for n, t in fields]))

    def _load(self) -> dict:
        if self.state.exists():
            return dict(zip(self.names, self.state.get()))
        empty = dict.fromkeys(self.names)
        return {**empty, "is_open": False, "episode": 0, "source_batch": -1}

    def _end(self, at: int, tier: str) -> int | None:
        seconds = self.seconds[tier]
        return None if seconds is None else at + seconds * 1_000_000

    def _ends(self, s: dict) -> bool:
        """The block has an end (one that opened as permanent never does)."""
        return s["is_open"] and self.seconds[s["tier"]] is not None and s["unblock_at"] is not None

    def _action(self, ip: str, s: dict, action: str, ts: int, alerts: int, last: int | None) -> Row:
        return Row(
            ip=ip, episode=s["episode"], action=action, ts=ts, alerts=alerts, attempt_count=s["attempts"], tier=s["tier"],
            alias=self.alias[s["tier"]], blocked_at=s["blocked_at"], unblock_at=s["unblock_at"], last_attempt=last,
            confidence_avg=s["confidence"], total_flows=s["flows"], alert_id=s["alert_id"], alert_file=s["alert_file"],
        )

    def _unblock(self, ip: str, s: dict) -> Row:
        last = s["last_us"] if s["attempts"] > 1 else None
        s["is_open"] = False
        return self._action(ip, s, "unblock", s["unblock_at"], 0, last)

    def handleInputRows(self, key, rows, timerValues):
        ip, s = key[0], self._load()
        # A batch that intake wrote twice is taken once.
        fresh = [r for r in rows if r.source_batch > s["source_batch"]]
        for r in sorted(fresh, key=lambda r: (r.source_batch, r.slice)):
            s["source_batch"] = max(s["source_batch"], r.source_batch)
            if self._ends(s) and r.first_us >= s["unblock_at"]:
                yield self._unblock(ip, s)
            resets = r.alerts
            if not s["is_open"]:
                s.update(
                    is_open=True, episode=s["episode"] + 1, attempts=1, tier=r.first_tier, blocked_at=r.first_us,
                    unblock_at=self._end(r.first_us, r.first_tier), last_us=r.first_us, confidence=r.first_confidence,
                    flows=r.first_flows, alert_id=r.first_id, alert_file=r.first_file,
                )
                yield self._action(ip, s, "block", r.first_us, 1, None)
                resets -= 1
            if resets:
                s["attempts"] += resets
                if r.last_us >= s["last_us"]:
                    s["last_us"], s["unblock_at"] = r.last_us, self._end(r.last_us, r.last_tier)
                yield self._action(ip, s, "reset", r.last_us, resets, s["last_us"])
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if self._ends(s):
            self.handle.registerTimer(s["unblock_at"] // 1000 + 1)
        self.state.update(tuple(s[n] for n in self.names))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        s = self._load()
        if self._ends(s):
            yield self._unblock(key[0], s)
            self.state.update(tuple(s[n] for n in self.names))

    def close(self) -> None:
        pass


def stream_slices(spark: SparkSession, path: str, id_type: str = "string") -> DataFrame:
    """The sums that intake writes, as a stream."""
    schema = SLICE_FIELDS.format(id=id_type) + ", batch_id bigint"
    return spark.readStream.schema(schema).parquet(os.path.join(path, "slices"))


def block_stream(
    slices: DataFrame,
    out: str,
    checkpoint: str,
    tiers: Iterable[Tier] = TIERS,
    late: str = "1 hour",
    id_type: str = "string",
    trigger: dict | None = None,
) -> StreamingQuery:
    """The action log (block, reset, unblock) as an exactly-once file sink.

    `late` only delays the `unblock` rows; their time is the end of the block itself.  It should
    cover how far alerts arrive out of order: an alert from before the end of a block that has
    been closed already opens the next one.
    """
    spark = slices.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = slices.withColumn("first_us", F.unix_micros("first_ts")).withColumn("last_us", F.unix_micros("last_ts"))
    actions = (
        timed.withWatermark("clock", late)
        .groupBy("ip")
        .transformWithState(
            statefulProcessor=BlockMachine(tuple(tiers), id_type),
            outputStructType=ACTION_FIELDS.format(id=id_type),
            outputMode="Append",
            timeMode="EventTime",
        )
    )
    actions = actions.withColumns({c: F.timestamp_micros(c) for c in TIMES})
    writer = actions.writeStream.format("parquet").outputMode("append").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def episodes_from_actions(actions: DataFrame) -> DataFrame:
    """State of every episode in an action log: its newest row (one address and episode at a time)."""
    rank = F.when(F.col("action") == "unblock", 1).otherwise(0)
    newest = F.struct("attempt_count", rank)
    record = F.struct(*[c for c in actions.columns if c not in ("ip", "episode", "action", "ts", "alerts")], "action")
    merged = actions.groupBy("ip", "episode").agg(F.max_by(record, newest).alias("r"))
    return merged.select("ip", "episode", "r.*")


def history_from_actions(actions: DataFrame) -> DataFrame:
    """Closed blocks of an action log with the month in which they ended."""
    return actions.filter(F.col("action") == "unblock").select(
        S.month_key("unblock_at").alias("month"), "ip", "blocked_at", F.col("unblock_at").alias("unblocked_at"), "tier",
        "confidence_avg", "total_flows", F.col("attempt_count").alias("attempts"),
    )
