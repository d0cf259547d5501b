import random

import pytest
from pyspark.sql import functions as F

from flowwarden.operators.positions import ordered_position


def brute(data):
    out, seen = {}, {}
    for k, o, w in sorted(data, key=lambda r: (str(r[0]), r[1])):
        seen[k] = seen.get(k, 0) + w
        out[(k, o)] = seen[k]
    return out


@pytest.mark.parametrize("chunks", [1, 4, 17])
def test_hot_key_and_null_key(spark, chunks):
    rng = random.Random(chunks)
    # One key holds most rows, one key is null, the rest are small.
    data = [(rng.choice(["hot"] * 6 + ["a", "b", None, None]), i, rng.randint(0, 3)) for i in range(2000)]
    df = spark.createDataFrame(data, "k string, o int, w int").repartition(5)
    got = ordered_position(df, ["o"], ["k"], weight=F.col("w"), name="t", chunks=chunks)
    assert {(r["k"], r["o"]): r["t"] for r in got.collect()} == brute(data)


def test_without_keys(spark):
    df = spark.range(1000).repartition(7)
    got = ordered_position(df, ["id"], chunks=6)
    assert all(r["position"] == r["id"] + 1 for r in got.collect())


def test_empty(spark):
    assert ordered_position(spark.range(0), ["id"]).count() == 0
