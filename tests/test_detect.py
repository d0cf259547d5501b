import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from flowwarden.operators import detect as D
from flowwarden.operators import windows as W
from flowwarden.plans.detection import detect, detect_per_file
from flowwarden.schema import DetectConfig
from tests.conftest import rows


def name(i):
    return f"capture_202501{1 + i // 3:02d}_{i % 3:02d}0000.pcap_Flow.csv"


def make_flows(spark, n_files=9, seed=1, silent=(4,)):
    rng = random.Random(seed)
    data = []
    for f in range(n_files):
        for pos in range(rng.randint(3, 12)):
            p = 0.1 if f in silent else round(rng.random(), 4)
            data.append((name(f), pos, f"10.0.0.{rng.randint(1, 4)}", f"192.168.0.{rng.randint(1, 2)}", rng.choice([22, 80]), p))
    data.append((name(0), 99, "10.0.0.9", "192.168.0.1", 22, 0.99))  # an attacker of the oldest file only
    schema = "file string, row_pos int, src_ip string, dst_ip string, dst_port int, p double"
    return data, spark.createDataFrame(data, schema).repartition(3)


def brute_windows(n_files, n, mode):
    if mode == "rolling":
        return {k + 1: range(max(0, k - n + 1), k + 1) for k in range(n_files)}
    out = defaultdict(list)
    for f in range(n_files):
        out[f // n + 1].append(f)
    return dict(out)


@pytest.mark.parametrize("mode", ["rolling", "fixed"])
@pytest.mark.parametrize("n", [1, 4, 9, 10])
def test_windows_against_recompute(spark, mode, n):
    data, flows = make_flows(spark)
    config = DetectConfig(window_files=n, window_mode=mode, min_attack_flows=2)
    run = detect(flows, config)
    want_alerts, want_stats, want_skips = {}, {}, {}
    for wid, members in brute_windows(9, n, mode).items():
        files = [name(i) for i in members]
        inside = [r for r in data if r[0] in files]
        found = [r for r in inside if r[5] > 0.5 and r[5] >= 0.7]
        by_ip = defaultdict(list)
        for r in found:
            by_ip[r[2]].append(r[5])
        for ip, ps in by_ip.items():
            if len(ps) >= 2:
                want_alerts[(wid, ip)] = (len(ps), files)
        if found:
            want_stats[wid] = (len(inside), len(found), len(by_ip), len(files))
            want_skips[wid] = (sum(len(p) >= 2 for p in by_ip.values()), sum(len(p) < 2 for p in by_ip.values()))
    got = {(r["window_id"], r["attacker_ip"]): (r["total_flows"], r["source_csvs"]) for r in run.alerts.collect()}
    assert got == want_alerts
    got = {r["window_id"]: (r["total_flows"], r["attack_flows"], r["unique_attackers"], len(r["source_csvs"])) for r in run.stats.collect()}
    assert got == want_stats  # statistics count attackers below the alert minimum as well
    assert {r["window_id"]: (r["generated"], r["skipped"]) for r in run.skips.collect()} == want_skips


def test_files_without_rows_take_a_slot(spark):
    _, flows = make_flows(spark, n_files=4, silent=())
    listing = spark.createDataFrame([(name(i),) for i in range(6)], "file string")
    table = W.file_table(flows, listing)
    assert {(r["file"], r["file_seq"], r["flow_count"] == 0) for r in table.collect()} == {(name(i), i + 1, i > 3) for i in range(6)}
    windows = {r["window_id"]: r["n_files"] for r in W.window_table(table, 2).collect()}
    assert windows == {1: 1, 2: 2, 3: 2, 4: 2, 5: 2, 6: 2}


def test_files_without_capture_time_come_last(spark):
    df = spark.createDataFrame([("b.csv",), (name(0),), ("a.csv",)], "file string")
    assert [r["file"] for r in W.file_sequence(df).orderBy("file_seq").collect()] == [name(0), "a.csv", "b.csv"]


def test_dedupe_keeps_attackers_of_the_newest_file(spark):
    data, flows = make_flows(spark, silent=())
    run = detect(flows, DetectConfig(), dedupe=True)
    fresh = {(int(i) + 1, r[2]) for i in range(9) for r in data if r[0] == name(i) and r[5] >= 0.7}
    assert {(r["window_id"], r["attacker_ip"]) for r in run.alerts.collect()} == fresh


def test_hit_edges(spark):
    df = spark.createDataFrame([(p,) for p in (0.5, 0.5001, 0.6999, 0.7, 1.0)], "p double")
    assert [r[0] for r in D.hits(df, DetectConfig()).collect()] == [0.7, 1.0]
    assert [r[0] for r in D.hits(df, DetectConfig(threshold=0.3)).collect()] == [0.5001, 0.6999, 0.7, 1.0]
    ports = df.withColumn("dst_port", F.when(F.col("p") == 1.0, 22).otherwise(80))
    assert D.hits(ports, DetectConfig(ssh_only=True)).count() == 1


def test_targets_in_first_seen_order(spark):
    data, flows = make_flows(spark)
    files = W.file_table(flows)
    found = D.hits(flows)
    got = W.window_targets(found, files, 5, "row_pos").filter("window_id = 5")
    want = {}
    for r in sorted((r for r in data if r[5] >= 0.7 and r[0] <= name(4)), key=lambda r: (r[0], r[1])):
        want.setdefault(r[2], {}).setdefault((r[3], r[4]), 0)
        want[r[2]][(r[3], r[4])] += 1
    seen = defaultdict(dict)
    for r in got.orderBy("first_seen").collect():
        seen[r["src_ip"]][(r["dst_ip"], r["dst_port"])] = r["flow_count"]
    assert {k: list(v.items()) for k, v in seen.items()} == {k: list(v.items()) for k, v in want.items()}


def test_flow_index_is_the_position_in_the_window(spark):
    data, _ = make_flows(spark, n_files=4)
    dense = []
    for f in range(4):
        for i, r in enumerate(sorted((r for r in data if r[0] == name(f)), key=lambda r: r[1])):
            dense.append((r[0], i, r[2]))
    flows = spark.createDataFrame(dense, "file string, row_pos int, src_ip string")
    got = W.flow_index(flows, W.file_table(flows), 3)
    for wid in range(1, 5):
        inside = got.filter(F.col("window_id") == wid).orderBy("file", "row_pos").collect()
        assert [r["flow_index"] for r in inside] == list(range(len(inside)))


def test_empty_input_gives_empty_output(spark):
    _, flows = make_flows(spark)
    run = detect(flows.limit(0))
    assert run.alerts.count() == 0 and run.stats.count() == 0 and run.files.count() == 0


def test_file_summary(spark):
    data, flows = make_flows(spark)
    got = {r["file"]: (r["total_flows"], r["attack_flows"], r["unique_attackers"]) for r in detect_per_file(flows).collect()}
    for f in range(9):
        mine = [r for r in data if r[0] == name(f)]
        hits = [r for r in mine if r[5] >= 0.7]
        assert got[name(f)] == (len(mine), len(hits), len({r[2] for r in hits}))


def test_result_does_not_depend_on_partitioning(spark):
    _, flows = make_flows(spark, seed=3)
    results = [rows(detect(flows.repartition(k)).alerts.drop("confidence").withColumn("a", F.lit(1))) for k in (1, 4, 17)]
    assert results[0] == results[1] == results[2]
    means = [rows(detect(flows.repartition(k)).alerts.select("window_id", "attacker_ip", "confidence.average")) for k in (1, 17)]
    assert means[0] == means[1]


def test_histogram_lists_every_key(spark):
    df = spark.createDataFrame([(0.75,), (1.0,), (0.3,)], "p double")
    assert rows(D.confidence_histogram(df)) == [
        ("0.50-0.60", 0), ("0.60-0.70", 0), ("0.70-0.80", 1), ("0.80-0.90", 0), ("0.90-1.00", 1)]
