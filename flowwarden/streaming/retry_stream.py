"""Retry of failed blocks on a stream.

One record per address waits in the state store with an event-time timer at its next attempt.  When the
clock passes that time the attempt is made; it succeeds, is put off by the interval, or the address is
given up at the limit.  Attempts happen at their due times, in the order of the address's events, so the
log does not depend on how events fall into micro-batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from flowwarden.schema import RetryConfig
from flowwarden.streaming.block_stream import ROCKSDB

#: Input: what happened to an address.  A failed block waits for a retry; a block from elsewhere or a new entry of the
#: whitelist ends the wait; a tick is nothing but the time.
KINDS = ("failed", "blocked", "whitelisted", "tick")
EVENT_COLUMNS = ["ip", "kind", "ts", "tier", "alias", "confidence", "flows", "alert_file"]
LOG_FIELDS = (
    "ip string, result string, attempts bigint, ts bigint, tier string, alias string, confidence double, flows bigint, "
    "alert_file string, next_retry bigint"
)
RECORD = [("tier", T.StringType()), ("alias", T.StringType()), ("confidence", T.DoubleType()), ("flows", T.LongType()), ("alert_file", T.StringType())]


class RetryMachine(StatefulProcessor):
    """Queue of one address: at most one failed block, its attempts and the time of the next one (microseconds)."""

    def __init__(self, attempt: Callable[[dict], bool], config: RetryConfig):
        self.attempt = attempt
        self.limit = config.max_attempts
        self.interval = config.interval_seconds * 1_000_000

    def init(self, handle) -> None:
        self.handle = handle
        fields = [*RECORD, ("attempts", T.LongType()), ("next_us", T.LongType())]
        self.names = [n for n, _ in fields]
        self.state = handle.getValueState("queued", T.StructType([T.StructField(n, t, True) for n, t in fields]))

    def _load(self) -> dict | None:
        return dict(zip(self.names, self.state.get(), strict=True)) if self.state.exists() else None

    def _row(self, ip: str, s: dict, result: str, at: int) -> Row:
        known = {n: s[n] for n, _ in RECORD}
        waits = s["next_us"] if result in ("queued", "requeued") else None
        return Row(ip=ip, result=result, attempts=s["attempts"], ts=at, **known, next_retry=waits)

    def _work(self, ip: str, s: dict | None, until: int) -> Iterator[Row | dict | None]:
        """Rows of all attempts due up to a time, then what is left of the record."""
        while s is not None and s["next_us"] <= until:
            at = s["next_us"]
            if s["attempts"] >= self.limit:
                yield self._row(ip, s, "gave_up", at)
                s = None
            elif self.attempt({"ip": ip, **s}):
                yield self._row(ip, s, "blocked", at)
                s = None
            else:
                s = {**s, "attempts": s["attempts"] + 1, "next_us": at + self.interval}
                yield self._row(ip, s, "requeued", at)
        self.left = s

    def _save(self, s: dict | None) -> None:
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)
        if s is None:
            self.state.clear()
        else:
            self.state.update(tuple(s[n] for n in self.names))
            self.handle.registerTimer(s["next_us"] // 1000 + 1)

    def handleInputRows(self, key, rows, timerValues):
        ip, s = key[0], self._load()
        for r in sorted(rows, key=lambda r: (r.ts_us, KINDS.index(r.kind), r.alert_file or "")):
            yield from self._work(ip, s, r.ts_us)  # what was due before it
            s = self.left
            if r.kind == "tick":
                continue
            if s is not None:
                yield self._row(ip, s, "replaced" if r.kind == "failed" else r.kind, r.ts_us)
                s = None
            if r.kind == "failed":
                s = {**{n: getattr(r, n) for n, _ in RECORD}, "attempts": 1, "next_us": r.ts_us + self.interval}
                yield self._row(ip, s, "queued", r.ts_us)
        self._save(s)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        yield from self._work(key[0], self._load(), now * 1000)
        self._save(self.left)

    def close(self) -> None:
        pass


def retry_stream(
    events: DataFrame,
    attempt: Callable[[dict], bool],
    out: str,
    checkpoint: str,
    config: RetryConfig = RetryConfig(),
    late: str = "1 hour",
    clock: str = "ts",
    trigger: dict | None = None,
) -> StreamingQuery:
    """The retry log of a stream of events, as an exactly-once file sink.

    `events` holds ip, kind (failed, blocked, whitelisted, tick), ts and the record of a failed block.  `attempt` gets
    ip, tier, alias, confidence, flows, alert_file and attempts, and says whether the block went through; it runs in
    the tasks and may run again for a batch that is repeated, so it should not mind a second call.

    `result` is queued, requeued, blocked, gave_up, replaced (a newer failure of the address) or whitelisted; rows that
    are queued or requeued have a `next_retry`.  `late` delays attempts, whose `ts` is the due time itself; it should
    cover how far events arrive out of order: one behind the watermark of `clock` is dropped by the engine.
    """
    events.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    timed = events.withColumn("ts_us", F.unix_micros(F.col("ts").cast("timestamp"))).withColumn("flows", F.col("flows").cast("bigint"))
    log = (
        timed.withWatermark(clock, late)
        .groupBy("ip")
        .transformWithState(
            statefulProcessor=RetryMachine(attempt, config), outputStructType=LOG_FIELDS, outputMode="Append", timeMode="EventTime"
        )
    )
    log = log.withColumns({c: F.timestamp_micros(c) for c in ("ts", "next_retry")})
    writer = log.writeStream.format("parquet").outputMode("append").option("path", out)
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def queue_from_log(log: DataFrame) -> DataFrame:
    """Addresses that still wait: the newest row of each, where it is queued or requeued."""
    rank = F.when(F.col("result").isin("queued", "requeued"), 1).otherwise(0)
    record = F.struct(*[c for c in log.columns if c != "ip"])
    newest = log.groupBy("ip").agg(F.max_by(record, F.struct("ts", rank, "attempts")).alias("r"))
    return newest.select("ip", "r.*").filter(F.col("result").isin("queued", "requeued")).drop("result")
