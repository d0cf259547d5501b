from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowwarden import schema
from flowwarden.functions import scalars as S


def values(spark, items, ddl, expr):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {ddl}")
    return [r[0] for r in df.select(expr("x"), "i").orderBy("i").collect()]


def test_feature_table():
    assert len(schema.FEATURE_MAP) == 79 and len(set(schema.INTERNAL)) == 79
    assert sum(c.startswith(" ") for c in schema.CANONICAL) == 65
    assert len(schema.FEATURES) == 78 and schema.INTERNAL[-1] == "label"
    assert schema.internal_name("Flow Bytes/s") == "flow_bytes_per_s"
    assert schema.internal_name(" Fwd Header Length.1") == "fwd_header_length_1"


def test_severity_edges(spark):
    got = values(spark, [1, 9, 10, 49, 50, 99, 100], "int", S.severity)
    assert got == ["LOW", "LOW", "MEDIUM", "MEDIUM", "HIGH", "HIGH", "CRITICAL"]


def test_tier_edges(spark):
    got = values(spark, [0.6999, 0.70, 0.7499, 0.75, 0.8499, 0.85, 0.9499, 0.95, 1.0, None], "double", S.tier_of)
    assert got == [None, "30min", "30min", "8hours", "8hours", "24hours", "24hours", "permanent", "permanent", None]


def test_bucket_edges(spark):
    p = [0.4999, 0.5, 0.5999, 0.6, 0.6999, 0.7, 0.7999, 0.8, 0.8999, 0.9, 1.0, 1.0001]
    got = values(spark, p, "double", S.confidence_bucket)
    names = [b[0] for b in schema.BUCKETS]
    assert got == [None, *[n for n in names for _ in range(2)], None]


def test_names_and_times(spark):
    ts = datetime(2025, 10, 27, 15, 33, 22, 123456)
    df = spark.createDataFrame([("192.168.10.50", ts)], "ip string, ts timestamp")
    r = df.select(
        S.alert_id("ip", "ts"), S.alert_filename("ip", "ts"), S.stats_filename(F.lit("a/window_3_csvs"), "ts"), S.iso_format("ts"),
        S.iso_format(F.date_trunc("second", "ts")), S.month_key("ts"), S.elapsed_seconds(F.date_trunc("hour", "ts"), "ts"),
        S.iso_parse(S.iso_format("ts")),
    ).first()
    assert list(r) == [
        "SSH_BF_1921681050_20251027153322", "alert_192_168_10_50_20251027_153322.json", "stats_window_3_csvs_20251027_153322.json",
        "2025-10-27T15:33:22.123456", "2025-10-27T15:33:22", "202510", 2002, ts,
    ]


def test_paths(spark):
    p = ["/d/capture_20251027_153221.pcap_Flow.csv", "capture_20251027_153221.pcap", "x.csv", ".hidden", "a.b.c"]
    assert values(spark, p, "string", S.capture_ts)[:3] == [datetime(2025, 10, 27, 15, 32, 21)] * 2 + [None]
    assert values(spark, p, "string", S.stem) == ["capture_20251027_153221.pcap_Flow", "capture_20251027_153221", "x", ".hidden", "a.b"]
    assert values(spark, p[1:2], "string", S.flow_file_name) == ["capture_20251027_153221.pcap_Flow.csv"]


def test_unblock_and_tick(spark):
    ts = datetime(2025, 1, 1, 0, 0, 30)
    df = spark.createDataFrame([(ts, t.name) for t in schema.TIERS], "ts timestamp, tier string")
    exact = [r[0] for r in df.select(S.unblock_at("ts", "tier")).collect()]
    assert exact == [datetime(2025, 1, 1, 0, 30, 30), datetime(2025, 1, 1, 8, 0, 30), datetime(2025, 1, 2, 0, 0, 30), None]
    tick = [r[0] for r in df.select(S.unblock_at("ts", "tier", tick_seconds=60)).collect()]
    assert tick[0] == datetime(2025, 1, 1, 0, 31) and tick[3] is None


def test_alias_text(spark):
    df = spark.createDataFrame([(" 1.1.1.1 \n\n2.2.2.2",), ("",), (None,)], "x string")
    added = [r[0] for r in df.select(S.alias_add("x", F.lit("2.2.2.2"))).collect()]
    assert added == ["1.1.1.1\n2.2.2.2", "2.2.2.2", "2.2.2.2"]
    gone = [r[0] for r in df.select(S.alias_remove("x", F.lit("1.1.1.1"))).collect()]
    assert gone == ["2.2.2.2", "", ""]


def test_numbers(spark):
    df = spark.createDataFrame([(0, 0), (47, 140)], "a int, b int")
    assert [r[0] for r in df.select(S.percent("a", "b")).collect()] == [0.0, 33.57]
    assert values(spark, [0.12345, 0.12344999999999998], "double", lambda x: S.rounded(x, 4)) == [0.1235, 0.1235]
    text = values(spark, [0.8734], "double", lambda x: S.block_description(x, F.lit(47)))
    assert text == ["Blocked by ML: 87.34% confidence, 47 flows"]
    assert values(spark, [22], "int", lambda x: S.target_key(F.lit("1.2.3.4"), x)) == ["1.2.3.4:22"]
    assert values(spark, ["SSH-Patator", "BENIGN"], "string", lambda x: S.binary_label(x, "SSH-Patator")) == [1, 0]


@pytest.mark.parametrize("mode", ["hopping"])
def test_unknown_window_mode(spark, mode):
    from flowwarden.operators.windows import window_ids

    with pytest.raises(ValueError):
        window_ids(mode, 5)
