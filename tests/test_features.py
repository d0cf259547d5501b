import math

from pyspark.sql import functions as F

from flowwarden import schema
from flowwarden.operators import features as C
from flowwarden.operators.scaling import Scaler, fit_scaler
from tests.conftest import rows

SOURCES = [s for s, _ in schema.FEATURE_MAP if s not in schema.REREAD]


def raw(spark, names, n=2):
    data = [tuple(str(i * 100 + j) for j in range(len(names))) for i in range(n)]
    return spark.createDataFrame(data, ", ".join(f"`{c}` string" for c in names))


def test_all_columns(spark):
    out = C.align_features(raw(spark, SOURCES), canonical=True)
    assert C.validate_schema(out) == []
    first = out.first()
    assert first[" Fwd Header Length"] == first[" Fwd Header Length.1"] == float(SOURCES.index("Fwd Header Len"))
    assert first[" Destination Port"] == 0.0 and first["Idle Mean"] == float(SOURCES.index("Idle Mean"))
    assert C.feature_columns() == list(schema.FEATURES) and len(C.feature_columns(out)) == 78


def test_missing_extra_and_shuffled(spark):
    names = ["Extra", *reversed([s for s in SOURCES if s not in ("Dst Port", "Fwd Header Len")])]
    out = C.align_features(raw(spark, names))
    assert out.columns == list(schema.INTERNAL)
    r = out.first()
    assert r["destination_port"] == 0.0 and r["fwd_header_length"] == 0.0 and r["fwd_header_length_1"] == 0.0
    assert r["flow_duration"] == float(names.index("Flow Duration"))


def test_schema_differences(spark):
    out = C.align_features(raw(spark, SOURCES), canonical=True)
    assert C.validate_schema(out.drop(" Label")) == [(78, " Label", None)]
    names = out.columns
    swapped = out.select(*[C.quoted(c) for c in [names[1], names[0], *names[2:]]])
    assert C.validate_schema(swapped) == [(0, names[0], names[1]), (1, names[1], names[0])]
    assert C.validate_schema(swapped.withColumn("more", F.lit(1)))[-1] == (79, None, "more")


def test_cleaning(spark):
    data = [("1.5",), ("inf",), ("-Infinity",), ("NaN",), (None,), ("text",), ("Infinity",)]
    df = spark.createDataFrame(data, "x string").select(F.col("x").try_cast("double").alias("x"))
    assert [r[0] for r in C.clean_numeric(df, ["x"]).collect()] == [1.5, 0, 0, 0, 0, 0, 0]
    assert C.nonfinite_count(df, ["x"]).first()[0] == 6
    assert rows(C.nonfinite_count(df.withColumn("y", F.lit(1.0)), ["x", "y"], per_column=True)) == [("x", 6), ("y", 0)]


def test_identity_defaults(spark):
    df = spark.createDataFrame([("1.1.1.1", None, "x")], "`Src IP` string, `Dst Port` string, `Protocol` string")
    r = C.with_identity(df).first()
    assert (r["src_ip"], r["dst_ip"], r["src_port"], r["dst_port"], r["protocol"], r["flow_ts"], r["duration"]) == (
        "1.1.1.1", "unknown", 0, 0, 0, "", 0.0)


def test_ssh_filter(spark):
    df = spark.createDataFrame([(22,), (80,)], "dst_port int")
    assert C.ssh_flows(df).count() == 1 and C.ssh_flows(df.withColumnRenamed("dst_port", "x")).count() == 2


def test_training_frame(spark):
    df = spark.createDataFrame([(1, "SSH-Patator", "inf"), (2, "BENIGN", "3"), (3, "DDoS", "4")], "id int, label string, f string")
    assert rows(C.training_frame(df, ["f"], keep=["id"])) == [(1, 0.0, 1), (2, 3.0, 0)]


def test_union(spark):
    a = spark.createDataFrame([(1, "x")], "a int, b string")
    b = spark.createDataFrame([("y", 2.0)], "b string, c double")
    assert rows(C.union_by_name(a, b)) == [(1, "x", None), (None, "y", 2.0)]


def test_scaler(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    assert rows(fit_scaler(df, ["a", "b"])) == [("a", 2.0, 1.0), ("b", 5.0, 0.0)]
    assert rows(Scaler.fit(df, ["a", "b"]).transform(df)) == [(-1.0, 0.0), (1.0, 0.0)]
    one = df.limit(1)
    assert all(math.isfinite(v) for v in Scaler.fit(one, ["a"]).transform(one).first())
