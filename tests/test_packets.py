import random
import re
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowwarden import schema
from flowwarden.operators import packets as N
from flowwarden.operators.features import align_features, validate_schema
from tests.conftest import rows

T0 = datetime(2025, 1, 1)


def make(spark, seed=1, n=600):
    rng = random.Random(seed)
    out, clock = [], {}
    for _ in range(n):
        pair = rng.choice([0, 0, 0, 1, 2])  # one pair of endpoints carries most packets
        clock[pair] = clock.get(pair, 0) + rng.choice([1000, 200_000, 900_000, 1_500_000, 7_000_000, 130_000_000])
        a, b = ("10.0.0.1", 1000 + pair), ("10.0.0.2", 22)
        src, dst = (a, b) if rng.random() < 0.6 else (b, a)
        payload = rng.randint(0, 1000)
        out.append((T0 + timedelta(microseconds=clock[pair]), *src, *dst, 6, payload + 40, 20, payload, rng.randint(0, 255), rng.randint(0, 9999)))
    return out, spark.createDataFrame(out, schema.PACKET_SCHEMA).repartition(5)


def brute(data, gap=120.0, active=5.0, bulk=1.0, least=4):
    by_pair = {}
    for p in sorted(data):
        by_pair.setdefault(frozenset([(p[1], p[2]), (p[3], p[4])]), []).append(p)
    flows = []
    for packets in by_pair.values():
        flow = []
        for p in packets:
            if flow and (p[0] - flow[-1][0]).total_seconds() > gap:
                flows.append(flow)
                flow = []
            flow.append(p)
        flows.append(flow)
    out = {}
    for f in flows:
        us = [int((p[0] - T0).total_seconds() * 1e6 + 0.5) for p in f]
        gaps = [b - a for a, b in zip(us, us[1:])]
        fwd = [p for p in f if p[1:3] == f[0][1:3]]
        bwd = [p for p in f if p[1:3] != f[0][1:3]]
        fus = [u for u, p in zip(us, f) if p[1:3] == f[0][1:3]]
        fgaps = [b - a for a, b in zip(fus, fus[1:])]
        runs, idle, start = [], [], us[0]
        for a, b in zip(us, us[1:]):
            if b - a > active * 1e6:
                runs.append(a - start)
                idle.append(b - a)
                start = b
        runs = [r for r in [*runs, us[-1] - start] if r > 0]
        pauses = sum(g > 1e6 for g in gaps)
        std = lambda xs: statistics.stdev(xs) if len(xs) > 1 else 0.0
        mean = lambda xs: statistics.mean(xs) if xs else 0.0
        lens = [p[8] for p in f]
        sent, bursts = [(u, p[1:3] == f[0][1:3], p[8]) for u, p in zip(us, f) if p[8] > 0], []
        for i, (u, side, size) in enumerate(sent):
            if i and sent[i - 1][1] == side and u - sent[i - 1][0] <= bulk * 1e6:
                bursts[-1].append((u, side, size))
            else:
                bursts.append([(u, side, size)])
        bulks = {d: [b for b in bursts if b[0][1] == d and len(b) >= least] for d in (True, False)}
        size = {d: sum(x[2] for b in bulks[d] for x in b) for d in bulks}
        lasted = {d: sum(b[-1][0] - b[0][0] for b in bulks[d]) for d in bulks}
        bulk_columns = {}
        for name, d in (("Fwd", True), ("Bwd", False)):
            bulk_columns[f"{name} Byts/b Avg"] = size[d] // len(bulks[d]) if bulks[d] else 0
            bulk_columns[f"{name} Pkts/b Avg"] = sum(map(len, bulks[d])) // len(bulks[d]) if bulks[d] else 0
            bulk_columns[f"{name} Blk Rate Avg"] = size[d] * 1_000_000 // lasted[d] if lasted[d] else 0
        out[(f[0][1], f[0][2], us[0])] = {
            "Flow Duration": us[-1] - us[0], "Tot Fwd Pkts": len(fwd), "Tot Bwd Pkts": len(bwd),
            "TotLen Fwd Pkts": sum(p[8] for p in fwd), "Fwd Pkt Len Std": std([p[8] for p in fwd]),
            "Bwd Pkt Len Max": max([p[8] for p in bwd], default=0), "Bwd Pkt Len Mean": mean([p[8] for p in bwd]),
            "Flow IAT Mean": mean(gaps), "Flow IAT Std": std(gaps), "Flow IAT Max": max(gaps, default=0), "Flow IAT Min": min(gaps, default=0),
            "Fwd IAT Tot": sum(fgaps), "Fwd IAT Std": std(fgaps), "Fwd IAT Max": max(fgaps, default=0), "Fwd IAT Min": min(fgaps, default=0),
            "Pkt Len Var": statistics.variance(lens) if len(lens) > 1 else 0.0, "Pkt Size Avg": sum(lens) / len(f),
            "SYN Flag Cnt": sum(p[9] & 2 > 0 for p in f), "Bwd PSH Flags": sum(p[9] & 8 > 0 for p in bwd),
            "Init Fwd Win Byts": fwd[0][10], "Init Bwd Win Byts": bwd[0][10] if bwd else 0, "Fwd Header Len": 20 * len(fwd),
            "Active Mean": mean(runs), "Active Std": std(runs), "Active Max": max(runs, default=0),
            "Idle Mean": mean(idle), "Idle Min": min(idle, default=0), "Idle Std": std(idle),
            "Subflow Fwd Pkts": len(fwd) // pauses if pauses else 0, "Down/Up Ratio": len(bwd) / len(fwd),
            **bulk_columns,
            "Flow Pkts/s": len(f) * 1e6 / (us[-1] - us[0]) if us[-1] > us[0] else 0.0, "Fwd Act Data Pkts": sum(p[8] > 0 for p in fwd),
        }
    return out


@pytest.mark.parametrize("slice_seconds", [1.0, 5.0])
def test_flow_features_against_the_packets(spark, slice_seconds):
    data, df = make(spark)
    want = brute(data)
    got = N.flows_from_packets(df, slice_seconds=slice_seconds).collect()
    assert len(got) == len(want)
    for r in got:
        start = int((datetime.fromisoformat(r["Timestamp"]) - T0).total_seconds() * 1e6 + 0.5)
        for name, value in want[(r["Src IP"], r["Src Port"], start)].items():
            assert r[name] == pytest.approx(value, rel=1e-6, abs=1e-3), name


@pytest.mark.parametrize("slice_seconds, bulk, least", [(1.0, 1.0, 4), (0.25, 2.0, 2), (5.0, 10.0, 3)])
def test_bulks_against_the_packets(spark, slice_seconds, bulk, least):
    data, df = make(spark, seed=5, n=900)
    want = brute(data, bulk=bulk, least=least)
    got = N.flows_from_packets(df, slice_seconds=slice_seconds, bulk_seconds=bulk, bulk_packets=least).collect()
    names = [f"{d} {c} Avg" for d in ("Fwd", "Bwd") for c in ("Byts/b", "Pkts/b", "Blk Rate")]
    assert len(got) == len(want)
    for r in got:
        start = int((datetime.fromisoformat(r["Timestamp"]) - T0).total_seconds() * 1e6 + 0.5)
        assert [r[n] for n in names] == [want[(r["Src IP"], r["Src Port"], start)][n] for n in names]
    assert all(sum(r[n] > 0 for r in got) > 3 for n in names)


def test_flows_feed_the_feature_mapping(spark):
    _, df = make(spark, n=50)
    flows = N.flows_from_packets(df)
    missing = {s for s, _ in schema.FEATURE_MAP if s not in schema.REREAD and s not in flows.columns}
    assert missing == {"Label"}
    assert validate_schema(align_features(flows, canonical=True)) == []


def test_sessions_and_gaps(spark):
    times = [0, 10, 100, 100, 5000, 8600.5, 12200.5]
    df = spark.createDataFrame([("k", T0 + timedelta(seconds=s), 1) for s in times], "k string, ts timestamp, v int")
    s = N.session_flows(df, ["k"], "ts", 3600.0, ["v"], slice_seconds=50.0).orderBy("session").collect()
    assert [(r["session"], r["events"], r["duration"], r["v"]) for r in s] == [(1, 4, 100.0, 4), (2, 1, 0.0, 1), (3, 2, 3600.0, 2)]
    i = N.iat_stats(df, ["k"], "ts", slice_seconds=60.0).first()
    gaps = [b - a for a, b in zip(times, times[1:])]
    assert i["events"] == 7 and i["iat_mean"] == pytest.approx(statistics.mean(gaps)) and i["iat_std"] == pytest.approx(statistics.stdev(gaps))
    assert (i["iat_max"], i["iat_min"]) == (max(gaps), 0.0)
    built_in = N.time_sessions(df, ["k"], "ts", "3600 seconds")
    assert sorted(r["events"] for r in built_in.collect()) == [1, 2, 4]


def test_one_packet(spark):
    data, df = make(spark, n=1)
    r = N.flows_from_packets(df).first()
    assert r["Flow Duration"] == 0.0 and r["Flow Byts/s"] == 0.0 and r["Flow IAT Std"] == 0.0 and r["Active Mean"] == 0.0


def test_slicing_does_not_change_the_result(spark):
    _, df = make(spark, seed=9, n=200)
    names = ["Src IP", "Src Port", "Timestamp", "Tot Fwd Pkts", "Flow IAT Max", "Idle Max", "Bwd IAT Tot"]
    out = [rows(N.flows_from_packets(df.repartition(k), slice_seconds=s).select(*[F.col(f"`{c}`") for c in names])) for k, s in ((1, 0.5), (7, 5.0))]
    assert out[0] == out[1]


def test_partitions_follow_the_packets(spark, monkeypatch):
    """A task sorts about `TASK_ROWS` rows, however many packets there are; a constant protocol does not undo that."""
    _, df = make(spark, seed=9, n=300)
    df = df.withColumn("protocol", F.lit(6))
    want = rows(N.flows_from_packets(df))
    monkeypatch.setattr(N, "TASK_ROWS", 10)
    flows = N.flows_from_packets(df)
    plan = flows._jdf.queryExecution().executedPlan().toString()
    sliced = re.findall(r"hashpartitioning\(end_a#\d+, end_b#\d+(?:, slice#\d+L)?, (\d+)\)", plan)
    assert set(sliced) == {"30"}
    assert rows(flows) == want
