import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm import whitening as W

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


def vectors(n=200, dim=6, seed=3):
    rng = np.random.default_rng(seed)
    scale = np.array([3.0, 2.0, 1.2, 0.7, 0.4, 0.2])[:dim]
    return (rng.normal(size=(n, dim)) * scale).astype(np.float32)


def plain(x, weights):
    """Mean, covariance, and eigenvectors by falling eigenvalue of weighted whole-number vectors."""
    n = weights.sum()
    s = (x * weights[:, None]).sum(0)
    z = x - s / n
    values, basis = np.linalg.eigh((z * weights[:, None]).T @ z / n)
    return n, s, values[::-1], basis[:, ::-1]


@pytest.mark.parametrize("weights", ["one", "count"])
def test_whitening_equals_numpy(spark, weights):
    c = vectors()
    rows = [(i, v.tolist()) for i, v in enumerate(c)]
    rows += [(1000 + i, c[7].tolist()) for i in range(100)]  # a third of the rows are one vector
    rows += [(2000, None), (2001, []), (2002, [1.0] * 5), (2003, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2004, [math.nan] * 6), (2005, [math.inf] + [0.0] * 5)]
    rows += [(2006, [3e38] + [0.0] * 5), (None, c[3].tolist()), (3, c[3].tolist())]
    kept = [(i, v) for i, v in rows if not (i and 2000 <= i < 2010)]
    x = np.floor(256 * np.array([v for _, v in kept])).astype(np.int64)
    distinct, counts = np.unique(x, axis=0, return_counts=True)
    n, s, values, basis = plain(distinct, counts if weights == "count" else np.ones(len(distinct), np.int64))
    out = W.whiten(frame(spark, rows), weights=weights).collect()
    assert sorted(map(repr, (r["vec_id"] for r in out))) == sorted(repr(i) for i, _ in kept)
    for r in out:
        v = np.floor(256 * np.array(r["embedding"])).astype(np.int64)
        assert r["n"] == n and r["deviation"] == sum((int(n) * int(a) - int(b)) ** 2 for a, b in zip(v, s))
        want = (v - s / n) @ basis[:, :4] / np.sqrt(values[:4])
        assert np.abs(np.abs(r["whitened"]) - np.abs(want)).max() < 1e-9
        assert r["explained"] == pytest.approx((values[:4] / values.sum()).tolist(), rel=1e-9)
        assert r["identity_error"] < 1e-9
    # One sign for all rows.
    table = np.array([r["whitened"] for r in out])
    want = (np.floor(256 * np.array([r["embedding"] for r in out])) - s / n) @ basis[:, :4] / np.sqrt(values[:4])
    assert (np.abs((table * want).sum(0)) == pytest.approx((want**2).sum(0)))


def test_no_variance_and_no_rows(spark):
    assert W.whiten(frame(spark, [])).count() == 0
    assert W.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    same = W.whiten(frame(spark, [(i, [0.5, 0.25]) for i in range(4)])).collect()
    assert len(same) == 4 and all((r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) == (1, 0, [None, None], [0.0, 0.0], None) for r in same)
    # Two vectors differ in one direction only.
    two = W.whiten(frame(spark, [(1, [0.0, 0.0, 0.0]), (2, [1.0, 1.0, 0.0])])).orderBy("vec_id").collect()
    assert [abs(r["whitened"][0]) for r in two] == pytest.approx([1.0, 1.0]) and all(r["whitened"][1:] == [None, None] for r in two)
    assert two[0]["explained"] == pytest.approx([1.0, 0.0, 0.0]) and two[0]["identity_error"] < 1e-12
    single = W.whiten(frame(spark, [(i, [float(i)]) for i in range(9)])).collect()
    assert all(len(r["whitened"]) == 1 for r in single)


def test_large_entries_stay_exact(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(1 << 40) / 1.0, -float(rng.randrange(1 << 20))]) for i in range(50)]
    out = W.whiten(frame(spark, rows)).collect()
    x = {r["vec_id"]: [math.floor(256 * float(v)) for v in r["embedding"]] for r in out}
    distinct = {tuple(v) for v in x.values()}
    n, s = len(distinct), [sum(v[j] for v in distinct) for j in range(2)]
    exact = {i: sum((n * a - b) ** 2 for a, b in zip(v, s)) for i, v in x.items()}
    assert all(r["deviation"] == (exact[r["vec_id"]] if exact[r["vec_id"]] < 1 << 63 else None) for r in out)
    assert any(r["deviation"] is None for r in out) and out[0]["identity_error"] < 1e-6


def test_names_and_parameters(spark):
    df = frame(spark, [(i, v.tolist()) for i, v in enumerate(vectors(30))])
    more = df.withColumn("n", F.lit("mine")).withColumn("key", F.lit(1)).withColumn("weight", F.lit(2)).withColumn("_key", F.lit(3)).withColumn("whitened", F.lit(4))
    out = W.whiten(more, components=2)
    assert out.columns == [*more.columns, "n_", "deviation", "whitened_", "explained", "identity_error"]
    r = out.first()
    assert (r["n"], r["_key"], r["whitened"]) == ("mine", 3, 4) and len(r["whitened_"]) == 2
    with pytest.raises(ValueError, match="weights"):
        W.whiten(df, weights="many")


def test_packing(spark):
    x = np.array([[1, -1], [32767, -32768], [32768, 0], [-(2**62), 5]])
    import pyarrow as pa

    packed = W.pack_rows(x)
    assert [len(b) for b in packed] == [4, 4, 16, 16]
    assert (W.unpack_rows(pa.array(packed, pa.binary()), 2) == x).all()
