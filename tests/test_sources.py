import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowwarden import schema
from flowwarden.operators import windows as W
from flowwarden.operators.features import align_features, clean_numeric
from flowwarden.plans.detection import detect, write_documents
from flowwarden.schema import BLOCK_SCHEMA, HISTORY_SCHEMA, DetectConfig
from flowwarden.sources import headers as Hd
from flowwarden.sources import inventory as I
from flowwarden.sources import readers as Rd
from flowwarden.sources import writers as Wr
from tests.conftest import rows

T0 = datetime(2025, 1, 1)


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_flow_file_with_infinities(spark, tmp_path):
    header = "Flow ID,Src IP,Dst IP,Src Port,Dst Port,Protocol,Timestamp,Flow Duration,Flow Byts/s"
    lines = ["x,1.1.1.1,2.2.2.2,50000,22,6,27/10/2025 03:32:21 PM,12.5,inf", "y,1.1.1.1,2.2.2.2,,22,6,t,Infinity,NaN", "z,,2.2.2.2,1,80,17,t,-1,3"]
    name = "capture_20251027_153221.pcap_Flow.csv"
    path = put(str(tmp_path / "in"), name, "\n".join([header, *lines]))
    put(str(tmp_path / "in"), "notes.txt", "ignored")
    assert Rd.read_header(spark, path) == header.split(",")
    flows = Rd.read_flows(spark, str(tmp_path / "in"), header=header.split(","))
    got = [(r["src_ip"], r["src_port"], r["dst_port"], os.path.basename(r["file"])) for r in flows.orderBy("Flow ID").collect()]
    assert got == [("1.1.1.1", 50000, 22, name), ("1.1.1.1", 0, 22, name), ("unknown", 1, 80, name)]
    aligned = align_features(flows)
    assert aligned.filter(F.col("flow_bytes_per_s") == float("inf")).count() == 1
    clean = clean_numeric(aligned, schema.FEATURES).select("flow_duration", "flow_bytes_per_s", "idle_mean")
    assert rows(clean) == [(-1.0, 3.0, 0.0), (0.0, 0.0, 0.0), (12.5, 0.0, 0.0)]
    pos = Rd.with_row_position(spark.read.schema(schema.raw_flow_schema(header.split(","))).option("header", True).csv(path))
    assert rows(pos.select("Flow ID", "row_pos")) == [("x", 0), ("y", 1), ("z", 2)]


def test_files_are_read_by_their_own_header(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "capture_20250101_000000.pcap_Flow.csv", "Src IP,Dst Port,Flow Duration,Extra\n1.1.1.1,22,80,x\n1.1.1.2,23,81,y\n")
    put(folder, "capture_20250101_000100.pcap_Flow.csv", "Flow Duration,Src IP,Dst Port\n90,2.2.2.2,24\n")
    put(os.path.join(folder, "other"), "capture_20250101_000100.pcap_Flow.csv", "Dst Port,Src IP\n25,3.3.3.3\n")
    put(folder, "empty.csv", "")
    flows = Rd.read_flows(spark, f"{folder}/{{*.csv,other/*.csv}}", position=True)
    got = flows.select("src_ip", "dst_port", "duration", "row_pos", "Extra")
    assert rows(got) == sorted([("1.1.1.1", 22, 80.0, 0, "x"), ("1.1.1.2", 23, 81.0, 1, "y"), ("2.2.2.2", 24, 90.0, 0, None), ("3.3.3.3", 25, 0.0, 0, None)], key=repr)
    # Two sensors' files of one name are two files, shown by their base names.
    files = W.file_table(flows)
    assert sorted(r["flow_count"] for r in files.collect()) == [1, 1, 2]
    last = W.window_table(files, 3).orderBy("window_id").collect()[-1]
    assert last["source_csvs"][1:] == ["capture_20250101_000100.pcap_Flow.csv"] * 2
    with pytest.raises(ValueError, match="Flow Duration"):
        Rd.read_flows(spark, f"{folder}/{{*.csv,other/*.csv}}", required=["Flow Duration"])
    with pytest.raises(Exception, match="(?i)header"):
        Rd.read_flows(spark, folder, header=["Dst Port", "Src IP", "Flow Duration", "Extra"]).collect()
    assert Rd.read_flows(spark, put(str(tmp_path), "none.csv", ""), position=True).count() == 0


HEAD = "Src IP,Dst Port,Flow Duration,Note"


def test_a_header_is_the_first_line_alone(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "a.csv", f"{HEAD}\n1.1.1.1,22,80,Protocol\n1.1.1.2,23,81,\"Src IP, or \"\"x\"\"\"\n")
    put(folder, "b.csv", "\ufeff" + '"Flow Duration"," Src IP ","Dst Port"\n"90","2.2.2.2",24\n')
    put(folder, "c.csv", "Dst Port,Src IP,Src IP,v1.0\n25,3.3.3.3,again,z\n")
    got = Rd.read_flows(spark, folder, position=True).select("src_ip", "dst_port", "duration", "Note", "row_pos")
    assert rows(got) == [("1.1.1.1", 22, 80.0, "Protocol", 0), ("1.1.1.2", 23, 81.0, 'Src IP, or "x"', 1), ("2.2.2.2", 24, 90.0, None, 0), ("3.3.3.3", 25, 0.0, None, 0)]


def test_an_unknown_header_is_an_error(spark, tmp_path):
    folder = str(tmp_path / "in")
    put(folder, "good.csv", f"{HEAD}\n1.1.1.1,22,80,x\n")
    bad = put(folder, "strange.csv", "one,two\n1,2\n")
    with pytest.raises(ValueError, match="strange.csv"):
        Rd.read_flows(spark, folder)
    with pytest.warns(UserWarning, match="strange.csv"):
        assert Rd.read_flows(spark, folder, unknown="skip").count() == 1
    stream = Rd.stream_flows(spark, folder)
    writer = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "mark"))
    with pytest.raises(Exception, match="no known header"):
        writer.trigger(availableNow=True).start().awaitTermination()
    assert os.path.exists(bad)


def test_only_first_lines_are_read_for_the_headers(spark, tmp_path):
    folder = str(tmp_path / "in")
    for i in range(3):
        put(folder, f"f{i}.csv", HEAD + "\n" + "1.1.1.1,22,80,x\n" * 200_000)
    groups = Hd.header_groups(spark, folder)
    assert {k: len(v) for k, v in groups.items()} == {tuple(HEAD.split(",")): 3}
    with open(f"{folder}/f0.csv", "rb") as f:
        whole = len(f.read())
    assert Hd.first_line(f"file:{folder}/f0.csv") == HEAD and whole > 20 * Hd.FIRST_BYTES
    # A place that Arrow does not know is read through Hadoop's file system.
    assert list(Hd._first_lines_by_hadoop(spark, [f"file:{folder}/f{i}.csv" for i in range(3)])) == [HEAD] * 3


def test_streamed_files_by_their_own_header(spark, tmp_path):
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    put(folder, "a.csv", f"{HEAD}\n1.1.1.1,22,80,Protocol\n1.1.1.2,23\n1.1.1.3,24,82,x,more\n\n")
    put(folder, "b b.csv", "\ufeff" + 'Dst Port,"Src IP"\r\n25,3.3.3.3\r\n')
    put(folder, "header.csv", HEAD + "\n")
    put(folder, "nothing.csv", "")
    stream = Rd.stream_flows(spark, folder, extra=["Note"])
    writer = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "mark"))
    writer.trigger(availableNow=True).start().awaitTermination()
    back = spark.read.schema(stream.schema).parquet(out).withColumn("name", F.element_at(F.split("file", "/"), -1))
    flows = rows(back.filter("is_flow").select("src_ip", "dst_port", "duration", "Note"))
    assert flows == sorted([("1.1.1.1", 22, 80.0, "Protocol"), ("1.1.1.2", 23, 0.0, None), ("1.1.1.3", 24, 82.0, "x"), ("3.3.3.3", 25, 0.0, None)], key=repr)
    assert rows(back.filter("not is_flow").select("name")) == [("a.csv",), ("b%20b.csv",), ("header.csv",)]


def test_a_long_alert_counts_once(spark, tmp_path):
    from flowwarden.operators.blocks import to_block_alerts

    run = _run(spark)
    detail, targets = W.flow_index(run.hits, run.files, 2), W.window_targets(run.hits, run.files, 2, "row_pos")
    path = str(tmp_path / "alerts")
    Wr.write_alerts(Wr.alert_documents(run.alerts, detail, targets, 2), path)
    back = Rd.read_alerts(spark, path)
    assert back.count() > run.alerts.count()
    want = rows(run.alerts.select("alert_id", "attacker_ip", "total_flows", "alert_file"))
    assert rows(to_block_alerts(back).select("alert_id", "ip", "total_flows", "alert_file")) == want


def test_labelled_files(spark, tmp_path):
    header = ",".join(Rd.labelled_header())
    assert len(Rd.labelled_header()) == 79 and header.count(" Fwd Header Length,") == 2
    row = ",".join(["7"] * 77 + ["Infinity", "SSH-Patator"])
    a, b = put(str(tmp_path), "mon.csv", f"{header}\n{row}\n"), put(str(tmp_path), "tue.csv", f"{header}\n{row.replace('SSH-Patator', 'BENIGN')}\n")
    df = Rd.read_labelled(spark, [a, b])
    assert df.columns == list(schema.INTERNAL) and sorted(r["label"] for r in df.collect()) == ["BENIGN", "SSH-Patator"]
    assert df.first()["fwd_header_length_1"] == 7.0
    with pytest.raises(ValueError, match="header"):
        Rd.read_labelled(spark, [put(str(tmp_path), "odd.csv", header.replace(" Label", "Label") + "\n" + row)])
    with pytest.raises(FileNotFoundError):
        Rd.read_labelled(spark, [a, str(tmp_path / "wed.csv")])


def test_whitelist_file(spark, tmp_path):
    doc = {"1.1.1.1": {"reason": "r", "added": "2025-11-03T12:40:00", "added_by": "admin"}, "10.0.0.0/8": {}}
    path = put(str(tmp_path), "whitelist.json", json.dumps(doc, indent=2))
    got = {r["entry"]: (r["reason"], r["added"]) for r in Rd.read_whitelist(spark, path).collect()}
    assert got == {"1.1.1.1": ("r", datetime(2025, 11, 3, 12, 40)), "10.0.0.0/8": (None, None)}
    assert Rd.read_whitelist(spark, str(tmp_path / "none.json")).count() == 0


def test_whitelist_in_many_documents(spark, tmp_path):
    entries = [(f"10.0.{i}.0/24", None if i % 3 else f'r "{i}"\n{{}}') for i in range(40)] + [("10.0.0.0/24", "again"), (None, "x")]
    df = spark.createDataFrame(entries, "entry string, reason string")
    path = str(tmp_path / "list")
    Wr.write_whitelist(df, path, file_entries=4)
    files = [open(os.path.join(path, n)).read().splitlines() for n in os.listdir(path) if n.startswith("part")]
    assert len(files) >= 11 and max(map(len, files)) <= 4 and all(len(json.loads(line)) == 1 for f in files for line in f)
    put(path, "more.json", json.dumps({"1.1.1.1": {"added": "2025-11-03T12:40:00"}, "2.2.2.2": {}}, indent=2))
    got = Rd.read_whitelist(spark, path)
    assert rows(got.select("entry", "reason")) == sorted([*entries[:-1], ("1.1.1.1", None), ("2.2.2.2", None)], key=repr)
    Wr.write_whitelist(df.limit(0), str(tmp_path / "empty"))
    assert Rd.read_whitelist(spark, str(tmp_path / "empty")).count() == 0


def test_alert_documents_one_per_file(spark, tmp_path):
    doc = {
        "alert_id": "A", "timestamp": "2025-10-27T15:33:22.123456", "attacker_ip": "1.1.1.1", "attack_type": "SSH_BRUTE_FORCE",
        "severity": "LOW", "total_flows": 1,
        "confidence": {"average": 0.8, "min": 0.8, "max": 0.8, "breakdown": {"0.80-0.90": 1}},
        "flows": [{"flow_index": 0, "probability": 0.8, "src_ip": "1.1.1.1", "dst_ip": "2.2.2.2", "src_port": 1, "dst_port": 22,
                   "protocol": 6, "timestamp": "t", "flow_duration": 1.5}],
        "source_csvs": ["a.csv"], "targets": [{"ip": "2.2.2.2", "port": 22, "flow_count": 1}],
    }
    put(str(tmp_path), "alert_1_1_1_1_x.json", json.dumps(doc, indent=2))
    r = Rd.read_alerts(spark, str(tmp_path)).first()
    assert r["alert_file"] == "alert_1_1_1_1_x.json" and r["timestamp"] == datetime(2025, 10, 27, 15, 33, 22, 123456)
    assert r["confidence"]["breakdown"] == {"0.80-0.90": 1} and r["targets"][0]["port"] == 22


def _run(spark):
    from tests.test_detect import make_flows

    _, flows = make_flows(spark, n_files=3, silent=())
    flows = flows.withColumn("src_port", F.lit(1)).withColumn("protocol", F.lit(6)).withColumn("flow_ts", F.lit("t")).withColumn("duration", F.lit(1.0))
    return detect(flows, DetectConfig(window_files=2))


@pytest.mark.parametrize("part_rows", [10_000, 2])
def test_documents_hold_every_flow_and_target(spark, part_rows):
    run = _run(spark)
    detail = W.flow_index(run.hits, run.files, 2)
    targets = W.window_targets(run.hits, run.files, 2, "row_pos")
    docs = Wr.alert_documents(run.alerts, detail, targets, part_rows).collect()
    flows = sum(len(d["flows"] or []) for d in docs)
    assert flows == run.alerts.agg(F.sum("total_flows")).first()[0] == detail.count()
    assert sum(t["flow_count"] for d in docs for t in d["targets"] or []) == flows
    if part_rows == 10_000:
        assert len(docs) == run.alerts.count()
        assert all(len(d["flows"]) == d["total_flows"] for d in docs)
    stats = Wr.stats_documents(run.stats, run.groups.select("window_id", "src_ip", F.col("flows").alias("flow_count")), part_rows).collect()
    assert sum(n for d in stats for n in (d["attackers"] or {}).values()) == sum({d["window_id"]: d["attack_flows"] for d in stats}.values())


def test_writing_a_window_again_replaces_it(spark, tmp_path):
    run = _run(spark)
    a, s = str(tmp_path / "alerts"), str(tmp_path / "stats")
    for _ in range(2):
        write_documents(run, a, s, DetectConfig(window_files=2))
    assert Rd.read_alerts(spark, a).count() == run.alerts.count()
    assert spark.read.json(s).count() == run.stats.count()


def test_documents_are_compressed(spark, tmp_path):
    run = _run(spark)
    documents = Wr.alert_documents(run.alerts, W.flow_index(run.hits, run.files, 2), W.window_targets(run.hits, run.files, 2, "row_pos"), 2)
    many = documents.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(200)))).drop("copy")
    default, plain = str(tmp_path / "default"), str(tmp_path / "plain")
    Wr.write_alerts(many, default)
    Wr.write_alerts(many, plain, compression="none")

    def size(path):
        return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names if n.startswith("part"))

    assert size(default) * 5 < size(plain)
    want = rows(Rd.read_alerts(spark, plain).select(F.to_json(F.struct("*"))))
    assert len(want) == many.count() > 0 and rows(Rd.read_alerts(spark, default).select(F.to_json(F.struct("*")))) == want
    for at, by_line in ((default, True), (default, False), (plain, True)):
        out, mark = str(tmp_path / f"out{by_line}{at[-1]}"), str(tmp_path / f"mark{by_line}{at[-1]}")
        stream = Rd.stream_alerts(spark, f"{at}/*", by_line=by_line)
        stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", mark).trigger(availableNow=True).start().awaitTermination()
        assert rows(spark.read.schema(stream.schema).parquet(out).select(F.to_json(F.struct("*")))) == want


def test_state_history_and_tables(spark, tmp_path):
    now = datetime(2025, 1, 31, 23, 0)
    one = (("1.1.1.1", now, now + timedelta(hours=2), "30min", "a", 0.7, 1, "id", "f", "active", 1, None))
    state = spark.createDataFrame([one], BLOCK_SCHEMA)
    path = str(tmp_path / "state")
    assert Wr.load_state(spark, path, 1, BLOCK_SCHEMA).count() == 0
    Wr.save_state(state, path, 1)
    change = state.withColumn("attempt_count", F.lit(2).cast("bigint")).union(state.withColumn("ip", F.lit("2.2.2.2")))
    grown = Wr.upsert_state(Wr.load_state(spark, path, 1, BLOCK_SCHEMA), change)
    assert sorted((r["ip"], r["attempt_count"]) for r in grown.collect()) == [("1.1.1.1", 2), ("2.2.2.2", 1)]
    assert Wr.close_blocks(grown, change.limit(1)).count() == 1
    history = spark.createDataFrame([("1.1.1.1", now, now + timedelta(hours=2), "30min", 0.7, 1, 1, "202502")], HISTORY_SCHEMA)
    for _ in range(2):
        Wr.append_history(history, str(tmp_path / "history"), "run-1")
    back = Rd.read_table(spark, str(tmp_path / "history"), HISTORY_SCHEMA)
    assert back.filter("month = '202502'").count() == 1
    Wr.write_counters(spark.range(1), str(tmp_path / "counters"))
    assert spark.read.json(str(tmp_path / "counters")).count() == 1


def test_inventories(spark, tmp_path):
    now = T0 + timedelta(hours=1)
    data = [("/a/x.pcap", 100, T0), ("/a/y.pcap", 10, T0), ("/a/z.pcap", 100, now - timedelta(seconds=4)), ("/b/q.csv", 100, now - timedelta(minutes=30)),
            ("/a/w.pcap", 24, now - timedelta(seconds=5)), ("/c/only.pcap", 100, T0)]
    inv = spark.createDataFrame(data, schema.INVENTORY_SCHEMA)
    at = F.lit(now)
    assert rows(I.settled_files(inv, at).select("path")) == [("/a/w.pcap",), ("/a/x.pcap",)]
    grown = inv.withColumn("length", F.when(F.col("path") == "/a/x.pcap", 99).otherwise(F.col("length")))
    assert rows(I.settled_files(inv, at, previous=grown).select("path")) == [("/a/w.pcap",)]
    assert rows(I.expired_files(inv, at, 30, ["*.pcap"]).select("path")) == [("/a/x.pcap",), ("/a/y.pcap",), ("/c/only.pcap",)]
    assert I.expired_files(inv, at, 30, ["?.csv"]).count() == 0  # exactly at the limit stays
    assert I.expired_files(inv, at, 29, ["?.csv"]).count() == 1
    assert rows(I.unprocessed(inv.select("path"), inv.limit(5).select("path"))) == [("/c/only.pcap",)]
    files = spark.createDataFrame([("a",), ("b",)], "file string")
    assert rows(I.left_window(files, files.limit(1))) == [("b",)]
    put(str(tmp_path), "f.csv", "12345")
    assert I.file_inventory(spark, str(tmp_path), "*.csv").first()["length"] == 5
