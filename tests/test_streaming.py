import json
import os
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from flowwarden.bindings import ORACLES, QUERIES
from flowwarden.operators import blocks as K
from flowwarden.operators.forest import train_forest
from flowwarden.plans.detection import detect, score_flows
from flowwarden.schema import FEATURES, DetectConfig, ForestConfig
from flowwarden.sources import readers as Rd
from flowwarden.streaming import block_stream as BS
from flowwarden.streaming import detect_stream as DS
from tests.conftest import rows
from tests.test_blocks import SCHEMA, T0, random_alerts
from tests.test_detect import make_flows


def flat(alerts):
    return rows(alerts.select("window_id", "attacker_ip", "total_flows", "severity", "confidence.average", F.array_join("source_csvs", ",")))


@pytest.mark.parametrize("mode, dedupe", [("rolling", False), ("rolling", True), ("fixed", False)])
def test_streamed_windows_equal_the_batch(spark, tmp_path, mode, dedupe):
    _, flows = make_flows(spark)
    config = DetectConfig(window_files=4, window_mode=mode)
    inbox, out, mark = (str(tmp_path / x) for x in ("in", "out", "mark"))
    files = [r["file"] for r in flows.select("file").distinct().orderBy("file").collect()]
    for group in (files[:2], files[2:3], files[3:]):  # a restart from the checkpoint after each
        flows.filter(F.col("file").isin(group)).coalesce(1).write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(flows.schema).option("maxFilesPerTrigger", 1).parquet(inbox)
        DS.alert_stream(stream, out, mark, config, dedupe).awaitTermination()
    want = detect(flows, config, dedupe=dedupe)
    target = DS.RollingAlerts(out, config, dedupe)
    assert flat(target.alerts(spark)) == flat(want.alerts)
    if not dedupe:
        assert rows(target.stats(spark).select("window_id", "total_flows", "attack_flows")) == rows(want.stats.select("window_id", "total_flows", "attack_flows"))
    # Taking the last batch once more changes nothing.
    target.step(flows.filter(F.col("file").isin(files[3:])), 2)
    assert flat(target.alerts(spark)) == flat(want.alerts)


def closed(df):
    return rows(df.select("ip", "blocked_at", "unblock_at", "tier", "attempt_count", "confidence_avg"))


def test_streamed_blocks_equal_the_batch(spark, tmp_path):
    alerts = [a for a in random_alerts(11, ips=25)]
    df = spark.createDataFrame(alerts, SCHEMA)
    listed = str(tmp_path / "whitelist.json")
    with open(listed, "w") as f:
        json.dump({"10.0.0.3": {}}, f)
    inbox, mid, out = (str(tmp_path / x) for x in ("in", "mid", "out"))
    cut = F.lit(T0) + F.expr("INTERVAL 1 DAY")
    late = F.col("ip") == "10.0.0.7"  # all alerts of this address arrive after everything else
    for part in (df.filter(~late & (F.col("ts") < cut)), df.filter(~late & (F.col("ts") >= cut)), df.filter(late)):
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(df.schema).parquet(inbox)
        BS.intake_stream(stream, mid, str(tmp_path / "c1"), lambda s: Rd.read_whitelist(s, listed)).awaitTermination()
        BS.block_stream(BS.stream_slices(spark, mid), out, str(tmp_path / "c2")).awaitTermination()
        with open(listed, "w") as f:  # the next micro-batch sees the new list
            json.dump({"10.0.0.3": {}, "10.0.0.4": {}}, f)
    actions = spark.read.parquet(out)
    kept = df.filter("ip <> '10.0.0.3'").filter((F.col("ip") != "10.0.0.4") | (F.col("ts") < cut))
    want = K.block_episodes(kept)
    assert closed(BS.episodes_from_actions(actions)) == closed(want)
    n = actions.groupBy("action").agg(F.sum("alerts").alias("n"), F.count("*").alias("rows")).collect()
    got = {r["action"]: r for r in n}
    assert got["block"]["n"] + got["reset"]["n"] == kept.count()
    # Timers have closed what ended well before the newest alert; no block is closed twice.
    history = BS.history_from_actions(actions)
    newest = df.agg(F.max("ts")).first()[0]
    due = want.filter((F.col("status") == "closed") & (F.col("unblock_at") < F.lit(newest) - F.expr("INTERVAL 2 HOURS")))
    assert history.count() == history.select("ip", "blocked_at").distinct().count()
    missing = due.select("ip", "blocked_at").exceptAll(history.select("ip", "blocked_at"))
    assert missing.count() == 0
    verdicts = spark.read.parquet(os.path.join(mid, "verdicts"))
    assert verdicts.filter("status = 'whitelisted'").count() == df.count() - kept.count()


def test_scoring_a_stream_equals_scoring_a_batch(spark, tmp_path):
    header = ["Src IP", "Dst IP", "Src Port", "Dst Port", "Protocol", "Timestamp", "Flow Duration", "Tot Fwd Pkts"]
    inbox = str(tmp_path / "in")
    data = [("1.1.1.1", "2.2.2.2", "1", "22", "6", "t", str(i), "inf" if i % 7 == 0 else str(i * 10)) for i in range(60)]
    spark.createDataFrame(data, ", ".join(f"`{h}` string" for h in header)).coalesce(2).write.option("header", True).csv(inbox)
    batch = Rd.read_flows(spark, inbox, header)
    train = spark.range(60).select(*[(F.col("id") if f == "flow_duration" else F.lit(0)).cast("double").alias(f) for f in FEATURES],
                                   (F.col("id") >= 30).cast("int").alias("target"))
    model = train_forest(train, FEATURES, config=ForestConfig(trees=3, depth=3))
    want = rows(score_flows(model, batch).select("duration", "p", "pred"))
    q = (score_flows(model, Rd.stream_flows(spark, inbox, header)).writeStream.format("parquet").option("path", str(tmp_path / "out"))
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert rows(spark.read.parquet(str(tmp_path / "out")).select("duration", "p", "pred")) == want
    assert DS.progress_counters(q)["rows"] == 60


def test_time_windows_on_a_stream(spark, tmp_path):
    df = spark.range(100).select((F.lit(T0) + F.make_dt_interval(mins=F.col("id"))).alias("ts"), F.lit("1.1.1.1").alias("src_ip"), F.lit(0.9).alias("p"))
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = (DS.time_window_stream(stream, "ts", "10 minutes", "0 seconds").select("window.start", "flows").writeStream.format("parquet")
         .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == 9 and {r["flows"] for r in got.collect()} == {10}  # the last window is still open


def test_stream_of_alert_documents(spark, tmp_path):
    with open(tmp_path / "alert_a.json", "w") as f:
        json.dump({"alert_id": "A", "timestamp": "2025-01-01T00:00:00", "attacker_ip": "1.1.1.1", "total_flows": 3,
                   "confidence": {"average": 0.8}}, f, indent=2)
    docs = K.to_block_alerts(Rd.stream_alerts(spark, str(tmp_path)))
    q = docs.writeStream.format("memory").queryName("docs").trigger(availableNow=True).start()
    q.awaitTermination()
    r = spark.table("docs").first()
    assert (r["ip"], r["confidence"], r["alert_file"]) == ("1.1.1.1", 0.8, "alert_a.json")


@pytest.fixture(scope="module")
def far_users(spark, tmp_path_factory):
    """Events of users whose number does not fit an address: some of their `10.0.x.y` do not parse."""
    sf = str(tmp_path_factory.mktemp("far"))
    user = F.when(F.col("id") % 3 == 0, 5).otherwise(65530 + F.col("id") % 40)  # 5 is on the whitelist
    ts = F.to_timestamp(F.lit("2024-01-02")) + F.make_dt_interval(mins=F.col("id") * 97)
    events = spark.range(400).select(F.col("id").alias("event_id"), ts.cast("timestamp_ntz").alias("ts"), user.alias("user_id"),
                                     F.lit("click").alias("event_type"), F.col("id").cast("double").alias("value"))
    events.write.parquet(f"{sf}/events.parquet")
    return sf


@pytest.mark.parametrize("name", ["stream_blocks", "stream_unblocks", "stream_whitelist_change"])
def test_streams_take_addresses_that_do_not_parse_as_their_sql_does(spark, far_users, name):
    got = QUERIES[name](spark, far_users)
    columns = ", ".join(f'"{c}"' for c in got.columns)
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW events AS SELECT * FROM '{far_users}/events.parquet/*.parquet'")
        want = duck.execute(f"SELECT {columns} FROM ({ORACLES[name]})").fetchall()
    assert any(re.search(r"10\.0\.256\.", str(r)) for r in want)
    assert rows(got) == sorted(want, key=repr)
