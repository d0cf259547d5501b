"""Queries on splitting, evaluation, oversampling and the forest."""

from __future__ import annotations

import os

import pyarrow as pa
from pyspark.sql import functions as F

from flowwarden.bindings import base as B
from flowwarden.bindings.registry import query, sql_round, table
from flowwarden.functions.scalars import rounded
from flowwarden.operators import metrics as M
from flowwarden.operators import sampling as P
from flowwarden.operators import smote as O
from flowwarden.operators.detect import hit_predicate
from flowwarden.operators.features import align_features, clean_numeric, feature_columns, validate_schema
from flowwarden.operators.forest import load_model, save_model, score, train_forest
from flowwarden.plans.detection import score_flows
from flowwarden.schema import INTERNAL, DetectConfig, ForestConfig
from flowwarden.session import durable, scratch_path
from flowwarden.sources import readers


@query("class_distribution", "SELECT quality, count(*) AS n FROM labels GROUP BY quality")
def class_distribution(spark, sf):
    return M.class_distribution(table(spark, sf, "labels"), "quality")


@query(
    "class_weights",
    f"""SELECT quality, n, {sql_round('CAST(t AS DOUBLE) / (k * n)', 6)} AS weight
FROM (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS t, count(*) OVER () AS k FROM labels GROUP BY quality)""",
)
def class_weights(spark, sf):
    return P.class_weights(table(spark, sf, "labels"), "quality").select("quality", "n", rounded("weight", 6).alias("weight"))


@query(
    "stratified_split",
    """SELECT doc_id, quality, CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, row_number() OVER (PARTITION BY quality ORDER BY doc_id * 7919 % 10007, doc_id) AS rn,
             count(*) OVER (PARTITION BY quality) AS n FROM labels)""",
)
def stratified_split(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return P.stratified_split(labels, "quality", "doc_id", mix=F.col("doc_id") * 7919 % 10007, span=10007)


SCORED = """scored AS (
  SELECT doc_id, quality AS label, (doc_id * 31 % 97) / 97.0::DOUBLE AS score, CASE WHEN doc_id * 31 % 97 >= 49 THEN 1 ELSE 0 END AS pred
  FROM labels)"""


def _scored(spark, sf):
    units = F.col("doc_id") * 31 % 97
    return table(spark, sf, "labels").select(
        "doc_id", F.col("quality").alias("label"), (units / F.lit(97.0)).alias("score"), (units >= 49).cast("int").alias("pred")
    )


OUTCOMES = """outcomes AS (
  SELECT count(*) FILTER (WHERE label = 1 AND pred = 1)::DOUBLE AS tp, count(*) FILTER (WHERE label = 0 AND pred = 1)::DOUBLE AS fp,
         count(*) FILTER (WHERE label = 1 AND pred = 0)::DOUBLE AS fn, count(*) FILTER (WHERE label = 0 AND pred = 0)::DOUBLE AS tn
  FROM scored)"""


@query(
    "confusion_matrix",
    f"WITH {SCORED} SELECT label, count(*) FILTER (WHERE pred = 0) AS pred_0, count(*) FILTER (WHERE pred = 1) AS pred_1 FROM scored GROUP BY label",
)
def confusion_matrix(spark, sf):
    return M.confusion_matrix(_scored(spark, sf))


@query(
    "binary_metrics",
    f"""WITH {SCORED}, {OUTCOMES} SELECT {sql_round('(tp + tn) / (tp + fp + fn + tn)', 6)} AS accuracy,
  {sql_round('tp / (tp + fp)', 6)} AS "precision", {sql_round('tp / (tp + fn)', 6)} AS recall,
  {sql_round('2 * tp / (2 * tp + fp + fn)', 6)} AS f1 FROM outcomes""",
)
def binary_metrics(spark, sf):
    m = M.binary_metrics(_scored(spark, sf))
    return m.select(*[rounded(c, 6).alias(c) for c in m.columns])


@query(
    "classification_report",
    f"""WITH {SCORED}, {OUTCOMES}, parts AS (
  SELECT tp / (tp + fp) AS p1, tp / (tp + fn) AS r1, 2 * tp / (2 * tp + fp + fn) AS f1, tp + fn AS n1,
         tn / (tn + fn) AS p0, tn / (tn + fp) AS r0, 2 * tn / (2 * tn + fp + fn) AS f0, tn + fp AS n0,
         (tp + tn) / (tp + fp + fn + tn) AS acc FROM outcomes),
rows AS (
  SELECT '0' AS class, p0 AS p, r0 AS r, f0 AS f, n0 AS n FROM parts
  UNION ALL SELECT '1', p1, r1, f1, n1 FROM parts
  UNION ALL SELECT 'accuracy', acc, acc, acc, n0 + n1 FROM parts
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n0 + n1 FROM parts
  UNION ALL SELECT 'weighted avg', (p0 * n0 + p1 * n1) / (n0 + n1), (r0 * n0 + r1 * n1) / (n0 + n1), (f0 * n0 + f1 * n1) / (n0 + n1), n0 + n1
  FROM parts)
SELECT class, {sql_round('p', 6)} AS "precision", {sql_round('r', 6)} AS recall, {sql_round('f', 6)} AS f1, CAST(n AS BIGINT) AS support FROM rows""",
)
def classification_report(spark, sf):
    r = M.classification_report(_scored(spark, sf))
    return r.select("class", *[rounded(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "roc_auc",
    f"""WITH {SCORED}, ranked AS (
  SELECT label, avg(rn) OVER (PARTITION BY score) AS r FROM (SELECT *, row_number() OVER (ORDER BY score) AS rn FROM scored)),
s AS (SELECT sum(r) FILTER (WHERE label = 1) AS r1, count(*) FILTER (WHERE label = 1)::DOUBLE AS n1,
             count(*) FILTER (WHERE label = 0)::DOUBLE AS n0 FROM ranked)
SELECT {sql_round('(r1 - n1 * (n1 + 1) / 2) / (n0 * n1)', 6)} AS roc_auc FROM s""",
)
def roc_auc(spark, sf):
    return M.roc_auc(_scored(spark, sf)).select(rounded("roc_auc", 6).alias("roc_auc"))


MINORITY = 5


@query(
    "minority_neighbours",
    f"""WITH m AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE label = {MINORITY}),
d AS (SELECT a.vec_id AS id, b.vec_id AS neighbour_id, list_distance(a.v, b.v) AS distance FROM m a JOIN m b ON a.vec_id <> b.vec_id)
SELECT id, neighbour_id, {sql_round('distance', 4)} AS distance, CAST(rn AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY distance, neighbour_id) AS rn FROM d) WHERE rn <= 5""",
)
def minority_neighbours(spark, sf):
    minority = table(spark, sf, "embeddings").filter(F.col("label") == MINORITY)
    near = O.nearest_neighbours(minority, "vec_id", "embedding", k=5, block_rows=64)
    return near.select("id", "neighbour_id", rounded("distance", 4).alias("distance"), "rank")


def _labelled_vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    return e.select("vec_id", F.col("embedding").cast("array<double>").alias("embedding"), (F.col("label") == MINORITY).cast("int").alias("target"))


@query(
    "smote_counts",
    f"""WITH c AS (SELECT count(*) FILTER (WHERE label = {MINORITY}) AS few, count(*) FILTER (WHERE label <> {MINORITY}) AS many FROM embeddings)
SELECT 0 AS target, many AS n, CAST(0 AS BIGINT) AS synthetic FROM c
UNION ALL SELECT 1, greatest(few, many), greatest(many - few, 0) FROM c""",
)
def smote_counts(spark, sf):
    grown = O.smote(_labelled_vectors(spark, sf), "vec_id", "embedding", "target")
    return grown.groupBy("target").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("synthetic")).alias("synthetic")
    )


@query(
    "smote_rows",
    f"""WITH c AS (SELECT count(*) FILTER (WHERE label = {MINORITY}) AS few, count(*) FILTER (WHERE label <> {MINORITY}) AS many FROM embeddings)
SELECT greatest(many - few, 0) AS synthetic, greatest(many - few, 0) AS on_segment FROM c""",
)
def smote_rows(spark, sf):
    """Synthetic rows, and those that lie on the segment between their two parents."""
    grown = O.smote(_labelled_vectors(spark, sf), "vec_id", "embedding", "target", block_rows=16, parents=True)
    line = F.zip_with("base", "other", lambda a, b: a + F.col("u") * (b - a))
    off = F.aggregate(F.zip_with("embedding", line, lambda x, y: F.abs(x - y)), F.lit(0.0), lambda a, x: F.greatest(a, x))
    fine = (off < 1e-9) & F.col("u").between(0, 1)
    return grown.agg(F.count_if("synthetic").alias("synthetic"), F.count_if(F.col("synthetic") & fine).alias("on_segment"))


@query(
    "forest_scores",
    f"""SELECT vec_id, CAST(label = {MINORITY} AS INTEGER) AS target,
  CASE WHEN rn <= floor(n * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split, true AS p_in_range, true AS pred_fits_p, true AS beats_majority
FROM (SELECT *, row_number() OVER (PARTITION BY label = {MINORITY} ORDER BY vec_id * 7919 % 10007, vec_id) AS rn,
             count(*) OVER (PARTITION BY label = {MINORITY}) AS n FROM embeddings)""",
)
def forest_scores(spark, sf):
    """Split and checks of the forest's scores for every row: probability, class, and accuracy on the test part."""
    vectors = _labelled_vectors(spark, sf)
    parts = P.stratified_split(vectors, "target", "vec_id", mix=F.col("vec_id") * 7919 % 10007, span=10007)
    width = vectors.agg(F.max(F.size("embedding"))).first()[0] or 0
    features = [f"f{i}" for i in range(width)]
    wide = parts.select("vec_id", "target", "split", *[F.col("embedding")[i].alias(f) for i, f in enumerate(features)])
    wide = durable(wide.repartition(spark.sparkContext.defaultParallelism))  # few large files would be scored by as few tasks
    train = P.with_class_weight(wide.filter(F.col("split") == "train"), "target")
    model = train_forest(train, features, weight="weight", config=ForestConfig())
    scored = durable(score(model, wide).select("vec_id", "target", "split", "p", "pred"))
    test = scored.filter(F.col("split") == "test")
    share = F.avg((F.col("pred") == F.col("target")).cast("double"))
    majority = F.greatest(F.avg("target"), 1 - F.avg("target"))
    better = test.agg((share >= majority).alias("beats_majority"))
    fits = F.col("pred").cast("int") == (F.col("p") > 0.5).cast("int")
    return scored.select(
        "vec_id", F.col("target").cast("int").alias("target"), "split", F.col("p").between(0, 1).alias("p_in_range"), fits.alias("pred_fits_p")
    ).withColumn("beats_majority", better.scalar())


# A flow to port 22 is an attack here, so what a forest should say is known in SQL as well.
RULE_FEATURES = ["destination_port", "flow_duration", "total_fwd_packets"]
RULE_FOREST = ForestConfig(trees=20, depth=6, min_leaf=1)
RULE_HEADER = {"src_ip": "Src IP", "dst_ip": "Dst IP", "dst_port": "Dst Port", "protocol": "Protocol", "duration": "Flow Duration", "event_id": "Tot Fwd Pkts"}


def _rule_flows(spark, sf):
    return B.flows(spark, sf).select(*[F.col(k).alias(v) for k, v in RULE_HEADER.items()], "file")


def _rule_model(spark, sf):
    """A forest fitted on the even events, saved and loaded again; also the one in memory."""
    aligned = align_features(_rule_flows(spark, sf), keep=["Tot Fwd Pkts"])
    fit = aligned.filter(F.col("`Tot Fwd Pkts`") % 2 == 0).withColumn("target", (F.col("destination_port") == 22).cast("int"))
    model = train_forest(clean_numeric(fit, RULE_FEATURES), RULE_FEATURES, config=RULE_FOREST)
    path = scratch_path(spark, "model")
    save_model(model, path)
    return model, load_model(path, RULE_FEATURES)


@query(
    "model_roundtrip",
    B.with_(B.FLOWS)
    + """SELECT CASE WHEN dst_port = 22 THEN 1 ELSE 0 END AS target, CASE WHEN dst_port = 22 THEN 1 ELSE 0 END AS pred, count(*) AS n,
  count(*) AS same_p, CAST(78 AS BIGINT) AS features, CAST(0 AS BIGINT) AS out_of_place FROM flows GROUP BY 1, 2""",
)
def model_roundtrip(spark, sf):
    """Confusion counts of a forest that was saved and loaded, its scores against the one in memory, and the feature checks."""
    model, loaded = _rule_model(spark, sf)
    flows = _rule_flows(spark, sf)
    aligned = align_features(flows, keep=["Tot Fwd Pkts"], canonical=False)
    rows = aligned.withColumn("target", (F.col("destination_port") == 22).cast("int"))
    both = score(loaded, score(model, rows).withColumnsRenamed({"p": "p0", "pred": "pred0"}))
    shown = align_features(flows, canonical=True)
    counts = both.groupBy("target", "pred").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("p0")).alias("same_p"))
    return counts.select(
        "target", "pred", "n", "same_p", F.lit(len(feature_columns(shown))).cast("bigint").alias("features"),
        F.lit(len(validate_schema(shown))).cast("bigint").alias("out_of_place"),
    )


@query(
    "stream_model_scores",
    B.with_(B.FLOWS)
    + """SELECT src_ip, count(*) AS flows, count(*) FILTER (WHERE dst_port = 22) AS hits, count(*) FILTER (WHERE dst_port = 22) AS alarms FROM flows GROUP BY src_ip""",
)
def stream_model_scores(spark, sf):
    """Flow files stream in, each by its own header, and a forest that was saved and loaded scores them."""
    _, loaded = _rule_model(spark, sf)
    root = scratch_path(spark, "scores")
    inbox, out, mark = (os.path.join(root, x) for x in ("inbox", "out", "checkpoint"))
    names = list(RULE_HEADER.values())
    flows = _rule_flows(spark, sf)
    for part, order in enumerate((names, names[::-1])):
        mine = flows.filter(F.col("`Tot Fwd Pkts`") % 2 == part).select(*order)
        mine.write.option("header", True).csv(f"{inbox}/{part}")
    stream = readers.stream_flows(spark, f"{inbox}/*").filter("is_flow")
    writer = score_flows(loaded, stream).writeStream.format("parquet").option("path", out).option("checkpointLocation", mark)
    writer.trigger(availableNow=True).start().awaitTermination()
    scored = spark.read.parquet(out)
    hit = hit_predicate(DetectConfig().threshold)
    return scored.groupBy("src_ip").agg(
        F.count(F.lit(1)).alias("flows"), F.count_if(hit).alias("hits"), F.count_if(F.col("pred") == 1).alias("alarms")
    )


LABELLED_SQL = """SELECT CASE WHEN event_id % 5 = 0 THEN 'SSH-Patator' WHEN event_id % 5 = 1 THEN 'FTP-Patator' ELSE 'BENIGN' END AS label, count(*) AS n,
  CAST(sum(event_id % 1000) AS DOUBLE) AS fwd_packets, CAST(sum(event_id % 65536) AS DOUBLE) AS port FROM events GROUP BY 1"""


@query("labelled_scan", LABELLED_SQL)
def labelled_scan(spark, sf):
    """Two labelled files in the training format, one of its names twice, written and read back by position."""
    e = table(spark, sf, "events").select("event_id")
    label = F.when(F.col("event_id") % 5 == 0, "SSH-Patator").when(F.col("event_id") % 5 == 1, "FTP-Patator").otherwise("BENIGN")
    known = {"total_fwd_packets": F.col("event_id") % 1000, "destination_port": F.col("event_id") % 65536, "label": label}
    root = scratch_path(spark, "labelled")
    header = ",".join(readers.labelled_header())
    line = F.concat_ws(",", *[known.get(n, F.lit(0)).cast("string") for n in INTERNAL]).alias("value")

    def headed(batches):
        # The repeated name cannot be a column, so every file of lines begins with the header as one of them.
        for values in ([header], *(batch.column(0).to_pylist() for batch in batches)):
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.string())], names=["value"])

    paths = []
    for day in range(2):
        paths.append(f"{root}/day{day}")
        e.filter(F.col("event_id") % 2 == day).select(line).mapInArrow(headed, "value string").write.text(paths[-1])
    back = readers.read_labelled(spark, paths)
    return back.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("total_fwd_packets").alias("fwd_packets"), F.sum("destination_port").alias("port")
    )
