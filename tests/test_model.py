import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowwarden.operators import forest
from flowwarden.operators import metrics as M
from flowwarden.operators import sampling as P
from flowwarden.operators import smote as O
from flowwarden.operators.forest import load_model, model_features, score
from flowwarden.plans.training import train
from flowwarden.schema import ForestConfig
from flowwarden.session import scratch_path
from tests.conftest import rows


def brute_auc(data):
    pos = [s for label, s in data if label == 1]
    neg = [s for label, s in data if label == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("levels", [3, 10_000])
def test_auc_against_all_pairs(spark, levels):
    rng = random.Random(levels)
    data = [(rng.randint(0, 1), rng.randint(0, levels) / levels) for _ in range(400)]
    df = spark.createDataFrame(data, "label int, score double").repartition(5)
    assert M.roc_auc(df).first()[0] == pytest.approx(brute_auc(data), abs=1e-12)


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.2)], "label int, pred int, score double")
    assert M.roc_auc(df).first()[0] is None
    m = M.binary_metrics(df).first()
    assert (m["accuracy"], m["precision"], m["recall"], m["f1"]) == (1.0, 0.0, 0.0, 0.0)
    assert rows(M.confusion_matrix(df)) == [(0, 2, 0)]


def test_report(spark):
    df = spark.createDataFrame([(1, 1)] * 3 + [(1, 0)] + [(0, 1)] * 2 + [(0, 0)] * 4, "label int, pred int")
    r = {x["class"]: x for x in M.classification_report(df).collect()}
    assert r["1"]["precision"] == pytest.approx(0.6) and r["1"]["recall"] == pytest.approx(0.75)
    assert r["0"]["precision"] == pytest.approx(0.8) and r["0"]["recall"] == pytest.approx(4 / 6)
    assert r["accuracy"]["f1"] == pytest.approx(0.7) and r["macro avg"]["precision"] == pytest.approx(0.7)
    assert r["weighted avg"]["recall"] == pytest.approx((0.75 * 4 + 4 / 6 * 6) / 10) and r["weighted avg"]["support"] == 10


def test_split_is_exact_and_repeatable(spark):
    data = [(i, "a" if i % 3 else ("b" if i % 2 else None)) for i in range(1000)] + [(2000, "single")]
    df = spark.createDataFrame(data, "id int, label string")
    first = rows(P.stratified_split(df.repartition(1), "label", "id"))
    assert first == rows(P.stratified_split(df.repartition(9), "label", "id"))
    assert len(first) == 1001
    for label in ("a", "b", None):
        n = sum(r[1] == label for r in first)
        assert sum(r[1] == label and r[2] == "test" for r in first) == int(n * 0.2 + 0.5)


def test_split_with_everything_in_one_cell(spark):
    df = spark.range(100).withColumn("label", F.lit(1))
    out = P.stratified_split(df, "label", "id", mix=F.lit(0), span=10)
    assert sorted(r["id"] for r in out.filter("split = 'test'").collect()) == list(range(20))
    assert P.stratified_split(df, "label", "id", test=1.0).filter("split = 'test'").count() == 100


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "target int")
    assert {r["target"]: r["weight"] for r in P.class_weights(df, "target").collect()} == {0: pytest.approx(2 / 3), 1: 2.0}
    assert P.with_class_weight(df, "target").filter("weight = 2.0").count() == 1


def points(n, seed, copies=0):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 1) + (i % 3) * 4, rng.gauss(0, 1), rng.randint(0, 2) * 1.0]) for i in range(n)]
    return out + [(n + i, out[0][1]) for i in range(copies)]


@pytest.mark.parametrize("block_rows", [8, 4096])
@pytest.mark.parametrize("copies", [0, 40])
def test_neighbours_against_brute_force(spark, block_rows, copies):
    data = points(80, 5, copies)
    df = spark.createDataFrame(data, "id bigint, vec array<double>").repartition(3)
    got = {(r["id"], r["rank"]): (r["neighbour_id"], round(r["distance"], 9)) for r in O.nearest_neighbours(df, "id", "vec", 4, block_rows).collect()}
    want = {}
    for i, v in data:
        near = sorted((sum((a - b) ** 2 for a, b in zip(v, w)) ** 0.5, j) for j, w in data if j != i)[:4]
        for rank, (d, j) in enumerate(near, 1):
            want[(i, rank)] = (j, round(d, 9))
    assert got == want


def test_blocks_stay_few(spark):
    """Each row travels once for each block, so small blocks may not make many of them."""
    df = spark.createDataFrame(points(600, 5), "vid bigint, vec array<double>")
    _, lows, _ = O._blocked(df, 8)
    assert 1 < len(lows) <= O.BLOCKS


@pytest.mark.parametrize("shift", [0.0, 1e6])
def test_nearest_rows_in_exact_order(shift):
    """Far from the origin products lose all digits that tell neighbours apart; grid points have many equal distances."""
    rng = np.random.default_rng(3)
    vectors = np.concatenate([rng.normal(0, 1e-3, (300, 5)), rng.integers(0, 2, (300, 5))]) + shift
    frame = pd.DataFrame({"vid": rng.permutation(600), "vec": list(vectors)})
    row, other, dist = O._nearest(frame, frame, 4)
    assert len(row) == 4 * 600
    ids = frame["vid"].to_numpy()
    for r in range(600):
        exact = np.sqrt(np.einsum("jk,jk->j", vectors[r] - vectors, vectors[r] - vectors))
        want = sorted((d, i) for d, i in zip(exact, ids) if i != ids[r])[:4]
        assert list(zip(dist[row == r], other[row == r])) == want


def test_nearest_rows_of_parts():
    """Blocks met one after another, each with the limits that the earlier ones left, ids in the order of the points; half the points are ties."""
    rng = np.random.default_rng(5)
    vectors = np.concatenate([np.sort(rng.normal(0, 1e4, (1800, 1)), axis=0), rng.integers(0, 3, (700, 1)) * 1e5])
    ids, k = np.arange(2500), 3
    whole = O._closest(ids, vectors, ids, vectors, k, np.full(2500, np.inf))
    limit, parts = np.full(2500, np.inf), []
    for part in (slice(0, 1100), slice(1100, 1102), slice(1102, 2500)):
        new = O._closest(ids, vectors, ids[part], vectors[part], k, limit)
        limit = np.fmin(limit, O._kth(new[0], new[2], k, limit))
        parts += zip(*new)
    got, want = {}, {}
    for i, j, d in parts:
        got.setdefault(i, []).append((d, j))
    for i in ids:
        gap = np.abs(vectors[:, 0] - vectors[i, 0])
        want[i] = sorted((d, j) for d, j in zip(gap, ids) if j != i)[:k]
    assert {i: sorted(x)[:k] for i, x in got.items()} == want
    assert list(zip(*whole)) == [(i, j, d) for i in ids for d, j in want[i]]


def test_fewer_points_than_neighbours(spark):
    df = spark.createDataFrame(points(3, 1), "id bigint, vec array<double>")
    assert O.nearest_neighbours(df, "id", "vec", 5).count() == 6


def test_smote(spark):
    data = [(i, v, 1) for i, v in points(12, 2)] + [(100 + i, v, 0) for i, v in points(50, 3)]
    df = spark.createDataFrame(data, "id bigint, vec array<double>, target int")
    out = [rows(O.smote(df.repartition(k), "id", "vec", "target", k=3)) for k in (1, 6)]
    assert out[0] == out[1]
    made = [r for r in out[0] if r[2]]
    assert len(made) == 38 and sum(r[1] == 1 for r in out[0]) == sum(r[1] == 0 for r in out[0]) == 50
    minority = [v for _, v, t in data if t == 1]

    def on_a_segment(x):
        for a in minority:
            for b in minority:
                span = [q - p for p, q in zip(a, b)]
                base = max(span, key=abs)
                if base == 0:
                    continue
                u = (x[span.index(base)] - a[span.index(base)]) / base
                if -1e-9 <= u <= 1 + 1e-9 and all(abs(p + u * s - y) < 1e-9 for p, s, y in zip(a, span, x)):
                    return True
        return False

    assert all(on_a_segment(r[0]) for r in made)


def test_every_minority_row_is_a_base(spark):
    """However many they are, all rows of the minority are drawn from, each with its own neighbours."""
    few = 104_000
    df = spark.range(3 * few).selectExpr("id", "array(double(id)) AS vec", "int(id < %d) AS target" % few)
    made = O.smote(df, "id", "vec", "target", k=2, parents=True).filter("synthetic").select(F.col("base")[0].alias("b"), F.col("other")[0].alias("o"))
    beyond = ~F.abs(F.col("b") - F.col("o")).isin(1.0, 2.0)  # at the ends the second neighbour is two away
    seen = made.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("b").alias("bases"), F.count_if(beyond).alias("beyond")).first()
    assert (seen["n"], seen["bases"], seen["beyond"]) == (few, few, 0)


@pytest.mark.parametrize("parts", [1, 40])
def test_a_forest_is_fitted_in_parts_over_few_even_partitions(spark, monkeypatch, parts):
    """Each partition costs a histogram a node of the fit, also without rows."""
    fits, fit = [], forest.RandomForestClassifier.fit

    def seen(self, df):
        sizes = df.groupBy(F.spark_partition_id()).count().collect()
        fits.append((df.rdd.getNumPartitions(), sorted(r["count"] for r in sizes), self.getCacheNodeIds()))
        return fit(self, df)

    monkeypatch.setattr(forest.RandomForestClassifier, "fit", seen)
    df = spark.range(4000, numPartitions=parts).selectExpr("id % 2 AS target", "double(id % 2) AS f")
    model = forest.train_forest(df, ["f"], config=ForestConfig(trees=10, depth=2))
    cores = spark.sparkContext.defaultParallelism
    assert len(fits) == forest.PARTS and spark.sparkContext.getCheckpointDir()
    for number, sizes, kept in fits:
        assert kept and len(sizes) == number == -(-cores // forest.PARTS) and max(sizes) < 2 * min(sizes) and sum(sizes) == 4000
    assert sum(s.getNumTrees for s in model.stages[2:]) == 10
    assert score(model, df).filter("pred = target AND p = target").count() == 4000


def test_training_end_to_end(spark):
    rng = random.Random(4)
    data = [(i, rng.gauss(0, 1), rng.gauss(0, 1), "BENIGN") for i in range(300)]
    data += [(1000 + i, rng.gauss(5, 1), rng.gauss(5, 1), "SSH-Patator") for i in range(60)]
    data += [(2000 + i, 0.0, 0.0, "DDoS") for i in range(40)]
    df = spark.createDataFrame(data, "id bigint, f double, g double, label string")
    path = scratch_path(spark, "model")
    for oversample in (True, False):
        run = train(df, ["f", "g"], "id", config=ForestConfig(trees=10, depth=5), oversample=oversample, path=path)
        e = run.evaluation.first()
        assert e["roc_auc"] > 0.99 and e["accuracy"] > 0.97
        assert run.train_accuracy.first()[0] > 0.97 and run.report.count() == 5 and run.confusion.count() == 2
    back = load_model(path, ["f", "g"])
    assert model_features(back) == ["f", "g"]
    assert rows(score(back, df).select("id", "p", "pred")) == rows(score(run.model, df).select("id", "p", "pred"))
    with pytest.raises(ValueError):
        load_model(path, ["g", "f"])
    names = spark.read.json(path + "/feature_names").first()
    assert names["count"] == 2 and names["features"] == ["f", "g"]
