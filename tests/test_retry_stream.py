import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowwarden.schema import RetryConfig
from flowwarden.streaming import retry_stream as RS
from tests.conftest import rows

T0 = datetime(2025, 1, 1)
SCHEMA = "ip string, kind string, ts timestamp, tier string, alias string, confidence double, flows bigint, alert_file string"
CONFIG = RetryConfig(interval_seconds=60, max_attempts=4)
END = T0 + timedelta(days=30)


# A lambda is sent by value, so workers need not import the tests.
goes_through = lambda record: (record["flows"] * 7 + record["attempts"]) % 5 == 0


def events(seed, n=150, ips=9):
    rng = random.Random(seed)
    out, clock = [], T0
    for i in range(n):
        clock += timedelta(seconds=rng.choice([1, 10, 40, 60, 200]))
        kind = rng.choice(["failed"] * 6 + ["blocked", "whitelisted", "tick"])
        out.append((f"10.0.0.{rng.randrange(ips)}", kind, clock, "30min", "a", 0.7, i, f"f{i:03}"))
    return out


def simulated(data, end):
    """The log, event by event, without any engine."""
    log, queue = [], {}

    def work(ip, until):
        while ip in queue and queue[ip][2] <= until:
            event, attempts, due = queue[ip]
            if attempts >= CONFIG.max_attempts:
                log.append((ip, "gave_up", attempts, due, event[7], None))
                del queue[ip]
            elif goes_through({"flows": event[6], "attempts": attempts}):
                log.append((ip, "blocked", attempts, due, event[7], None))
                del queue[ip]
            else:
                queue[ip] = (event, attempts + 1, due + timedelta(seconds=60))
                log.append((ip, "requeued", attempts + 1, due, event[7], due + timedelta(seconds=60)))

    for e in data:
        ip, kind, ts = e[:3]
        work(ip, ts)
        if kind == "tick":
            continue
        if ip in queue:
            old, attempts, _ = queue.pop(ip)
            log.append((ip, "replaced" if kind == "failed" else kind, attempts, ts, old[7], None))
        if kind == "failed":
            queue[ip] = (e, 1, ts + timedelta(seconds=60))
            log.append((ip, "queued", 1, ts, e[7], ts + timedelta(seconds=60)))
    for ip in list(queue):
        work(ip, end)
    return sorted(log, key=repr)


@pytest.mark.parametrize("cuts", [(), (40, 41, 90)])
def test_the_log_does_not_depend_on_the_batches(spark, tmp_path, cuts):
    data = events(3)
    inbox, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    bounds = [0, *cuts, len(data)]
    tick = ("0.0.0.0", "tick", END, None, None, None, None, None)
    for part in [*(data[a:b] for a, b in zip(bounds, bounds[1:])), [tick]]:
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(SCHEMA).parquet(inbox)
        RS.retry_stream(stream, goes_through, out, mark, CONFIG, late="0 seconds").awaitTermination()
    log = spark.read.parquet(out)
    got = rows(log.select("ip", "result", "attempts", "ts", "alert_file", "next_retry"))
    assert got == simulated(data, END)
    assert {r[1] for r in got} == {"queued", "requeued", "blocked", "gave_up", "replaced", "whitelisted"}
    assert RS.queue_from_log(log).count() == 0


def test_what_waits_at_the_end(spark, tmp_path):
    data = [(f"10.0.0.{i}", "failed", T0 + timedelta(seconds=i), "30min", "a", 0.7, i, f"f{i}") for i in range(3)]
    inbox, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    spark.createDataFrame(data, SCHEMA).write.parquet(inbox)
    stream = spark.readStream.schema(SCHEMA).parquet(inbox)
    RS.retry_stream(stream, goes_through, out, mark, CONFIG).awaitTermination()
    waits = RS.queue_from_log(spark.read.parquet(out))
    assert rows(waits.select("ip", "attempts")) == [(f"10.0.0.{i}", 1) for i in range(3)]
    assert waits.filter(F.col("next_retry") != F.col("ts") + F.expr("INTERVAL 60 SECONDS")).count() == 0
