import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowwarden.operators import blocks as K
from flowwarden.operators import retry as R
from flowwarden.plans.blocking import block
from flowwarden.schema import TIERS, RetryConfig
from tests.conftest import rows

T0 = datetime(2025, 3, 1)
SECONDS = {t.name: t.seconds for t in TIERS}
SCHEMA = "ip string, ts timestamp, alert_id string, confidence double, total_flows bigint, alert_file string"


def tier(c):
    return "30min" if c < 0.75 else "8hours" if c < 0.85 else "24hours" if c < 0.95 else "permanent"


def step_by_step(alerts, as_of=None):
    """The policy, one alert after the other."""
    blocks, actions = [], []
    by_ip = {}
    for ip, ts, aid, c, flows, file in sorted(alerts, key=lambda a: (a[1], a[2])):
        if as_of and ts > as_of:
            continue
        t = tier(c)
        end = None if SECONDS[t] is None else ts + timedelta(seconds=SECONDS[t])
        b = by_ip.get(ip)
        if b and b["tier"] != "permanent" and b["end"] and b["end"] <= ts:
            b["status"], b = "closed", None
        if b is None:
            b = dict(ip=ip, at=ts, end=end, tier=t, conf=c, flows=flows, id=aid, n=1, last=None, status="active")
            by_ip[ip] = b
            blocks.append(b)
        else:
            b.update(end=end, n=b["n"] + 1, last=ts)
        actions.append((ip, aid, "block" if b["n"] == 1 else "reset", b["n"]))
    for b in blocks:
        if b["tier"] != "permanent" and b["end"] and (as_of is None or b["end"] <= as_of):
            b["status"] = "closed"
    return blocks, actions


def as_rows(blocks):
    return sorted(
        ((b["ip"], b["at"], b["end"], b["tier"], b["conf"], b["flows"], b["id"], b["n"], b["last"], b["status"]) for b in blocks), key=repr)


def spark_rows(df):
    return rows(df.select("ip", "blocked_at", "unblock_at", "tier", "confidence_avg", "total_flows", "alert_id", "attempt_count", "last_attempt", "status"))


def random_alerts(seed, ips=60, permanent=True):
    rng = random.Random(seed)
    out = []
    for i in range(ips):
        ts = T0 + timedelta(seconds=rng.randint(0, 7200))
        for j in range(rng.choice([1, 3, 10, 40])):
            top = 1.0 if permanent and rng.random() < 0.1 else 0.9499
            out.append((f"10.0.0.{i}", ts, f"a{i}_{j:03d}", round(rng.uniform(0.7, top), 4), rng.randint(1, 200), f"f{j}"))
            ts += timedelta(seconds=rng.choice([0, 1, 60, 1799, 1800, 1801, 28800, 86399, 86400, 90000, rng.randint(0, 100000)]))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_episodes_and_actions_against_the_model(spark, seed):
    alerts = random_alerts(seed)
    df = spark.createDataFrame(alerts, SCHEMA).repartition(seed * 3)
    blocks, actions = step_by_step(alerts)
    assert spark_rows(K.block_episodes(df)) == as_rows(blocks)
    assert rows(K.block_actions(df).select("ip", "alert_id", "action", "attempt_count")) == sorted(actions, key=repr)
    as_of = T0 + timedelta(days=3)
    blocks, _ = step_by_step(alerts, as_of)
    assert spark_rows(K.block_episodes(df, as_of=F.lit(as_of))) == as_rows(blocks)


def episodes(spark, *alerts, **kw):
    data = [("1.1.1.1", T0 + timedelta(seconds=s), f"a{i}", c, 1, "f") for i, (s, c) in enumerate(alerts)]
    return K.block_episodes(spark.createDataFrame(data, SCHEMA), **kw).orderBy("episode").collect()


def test_expiry_edges(spark):
    assert len(episodes(spark, (0, 0.7), (1800, 0.7))) == 2  # exactly at the end: a new block
    assert len(episodes(spark, (0, 0.7), (1799, 0.7))) == 1  # one second before: a reset
    assert len(episodes(spark, (0, 0.7), (1830, 0.7), tick_seconds=60)) == 2
    assert len(episodes(spark, (30, 0.7), (1850, 0.7), tick_seconds=60)) == 1  # ends at the tick of 1860


def test_weaker_alert_shortens_a_block(spark):
    e = episodes(spark, (0, 0.9), (60, 0.7))
    assert len(e) == 1 and e[0]["tier"] == "24hours" and e[0]["unblock_at"] == T0 + timedelta(seconds=1860)


def test_permanent_reset_on_a_temporary_block(spark):
    e = episodes(spark, (0, 0.7), (60, 0.99), (10**6, 0.7))
    assert len(e) == 1 and e[0]["attempt_count"] == 3 and e[0]["unblock_at"] == T0 + timedelta(seconds=10**6 + 1800)


def test_permanent_block_never_ends(spark):
    e = episodes(spark, (0, 0.99), (60, 0.7), (10**6, 0.7))
    assert len(e) == 1 and e[0]["status"] == "active" and e[0]["tier"] == "permanent"


def test_many_alerts_of_one_address_reach_the_sequence_rule_as_few_rows(spark):
    start = F.lit(T0)
    alerts = spark.range(20000).select(
        F.lit("9.9.9.9").alias("ip"), (start + F.make_dt_interval(secs=F.col("id") % 3600)).alias("ts"), F.col("id").alias("alert_id"),
        F.lit(0.8).alias("confidence"), F.lit(1).cast("bigint").alias("total_flows"), F.lit("f").alias("alert_file"))
    assert K.episode_slices(alerts).count() == 2
    assert K.block_episodes(alerts).first()["attempt_count"] == 20000


def test_state_history_and_counters(spark):
    alerts = random_alerts(7)
    low = [("10.0.0.1", T0, "low", 0.69, 1, "f"), (None, T0, "none", 0.9, 1, "f"), ("bad", T0, "bad", 0.9, 1, "f"),
           ("10.0.0.1", T0, "nullc", None, 1, "f"), ("172.16.0.9", T0, "wl", 0.9, 1, "f")]
    as_of = T0 + timedelta(days=4)
    df = spark.createDataFrame(alerts + low, SCHEMA)
    wl = spark.createDataFrame([("172.16.0.0/16",)], "entry string")
    run = block(df, wl, F.lit(as_of), F.lit(T0))
    blocks, _ = step_by_step(alerts, as_of)
    closed = [b for b in blocks if b["status"] == "closed"]
    active = [b for b in blocks if b["status"] == "active"]
    c = run.counters.first()
    assert c["total_blocks"] == len(blocks) and c["total_unblocks"] == len(closed) and c["currently_blocked"] == len(active)
    assert c["block_timer_resets"] == sum(b["n"] - 1 for b in blocks)
    assert c["active_permanent"] == sum(b["tier"] == "permanent" for b in active)
    assert (c["skipped_whitelisted"], c["skipped_below_threshold"], c["skipped_invalid"]) == (1, 1, 3)
    assert c["uptime_seconds"] == 4 * 86400
    assert run.history.count() == len(closed)
    nested = K.history_per_ip(run.history)
    assert sum(len(r["blocks"]) for r in nested.collect()) == len(closed)
    assert all(r["month"] == "202503" for r in run.history.collect())
    listed = {ip for r in run.aliases.collect() for ip in r["content"].split("\n")}
    assert listed == {b["ip"] for b in active}
    parts = K.alias_contents(run.active, max_entries=3).collect()
    assert sorted(ip for r in parts for ip in r["content"].split("\n")) == sorted(listed)
    assert len(parts) > len({r["alias"] for r in parts})
    top = max(b["n"] for b in blocks)
    assert {r["ip"] for r in K.persistent_attackers(run.episodes, top - 1).collect()} == {b["ip"] for b in blocks if b["n"] == top}


def test_alias_diff(spark):
    want = spark.createDataFrame([("t", "1"), ("t", "2")], "alias string, ip string")
    have = spark.createDataFrame([("t", "2"), ("u", "1")], "alias string, ip string")
    assert rows(K.alias_diff(want, have)) == [("t", "1", "add"), ("u", "1", "remove")]
    assert K.missing_aliases(want).count() == 4


def test_retry(spark):
    now = T0 + timedelta(hours=1)
    at = lambda s: now + timedelta(seconds=s)
    data = [("1.0.0.1", 1, at(0)), ("1.0.0.2", 4, at(-5)), ("1.0.0.3", 5, at(0)), ("1.0.0.4", 1, at(1)), ("1.0.0.5", 1, at(0)), ("1.0.0.6", 2, at(0))]
    queue = spark.createDataFrame(
        [(ip, "30min", "ssh_block_30min", 0.7, 1, "f", T0, n, T0, due) for ip, n, due in data],
        "ip string, tier string, alias string, confidence double, flows bigint, alert_file string, blocked_at timestamp, attempts int, "
        "last_attempt timestamp, next_retry timestamp")
    outcomes = spark.createDataFrame([("1.0.0.5", True), ("1.0.0.1", False)], "ip string, success boolean")
    wl = spark.createDataFrame([("1.0.0.6",)], "entry string")
    step = R.retry_step(queue, outcomes, F.lit(now), RetryConfig(), wl)
    got = {r["ip"]: (r["result"], r["attempts"], r["next_retry"]) for r in step.collect()}
    assert got["1.0.0.1"] == ("requeued", 2, at(30)) and got["1.0.0.2"] == ("requeued", 5, at(30))
    assert got["1.0.0.3"][0] == "gave_up" and got["1.0.0.4"] == ("waiting", 1, at(1))
    assert got["1.0.0.5"][0] == "blocked" and got["1.0.0.6"][0] == "whitelisted"
    assert {r["ip"] for r in R.next_queue(step).collect()} == {"1.0.0.1", "1.0.0.2", "1.0.0.4"}
    failed = spark.createDataFrame([("1.0.0.4", "8hours", "a", 0.8, 3, "g", T0), ("1.0.0.4", "24hours", "b", 0.9, 4, "h", now)],
                                   "ip string, tier string, alias string, confidence double, flows bigint, alert_file string, ts timestamp")
    grown = {r["ip"]: r for r in R.enqueue(queue, failed, F.lit(now)).collect()}
    assert len(grown) == 6 and grown["1.0.0.4"]["tier"] == "24hours" and grown["1.0.0.4"]["attempts"] == 1


def test_expired(spark):
    data = [("a", "30min", T0), ("b", "30min", T0 + timedelta(seconds=1)), ("c", "permanent", T0), ("d", "8hours", None)]
    df = spark.createDataFrame(data, "ip string, tier string, unblock_at timestamp")
    assert rows(K.expired_blocks(df, F.lit(T0)).select("ip")) == [("a",)]
