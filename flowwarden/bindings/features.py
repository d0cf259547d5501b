"""Queries on alignment, cleaning, scaling and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowwarden.bindings.registry import query, sql_round, table
from flowwarden.functions.scalars import rounded
from flowwarden.operators import features as C
from flowwarden.operators.scaling import Scaler, fit_scaler
from flowwarden.schema import FEATURE_MAP, LABEL, REREAD, internal_name

RENAMED = {
    "l_partkey": "Dst Port",
    "l_extendedprice": "Flow Duration",
    "l_quantity": "Tot Fwd Pkts",
    "l_discount": "Flow Byts/s",
    "l_tax": "Fwd Header Len",
    "l_suppkey": "Pkt Len Max",
}


def _aligned_sql() -> str:
    back = {v: k for k, v in RENAMED.items()}
    cols = []
    for source, target in FEATURE_MAP:
        name, real = internal_name(target), back.get(REREAD.get(source, source))
        if name == LABEL:
            cols.append(f"'0' AS {name}")
        else:
            cols.append(f"CAST({real or 0} AS DOUBLE) AS {name}")
    return f"SELECT l_orderkey, l_linenumber, {', '.join(cols)} FROM lineitem"


@query("aligned_features", _aligned_sql())
def aligned_features(spark, sf):
    raw = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *[F.col(k).alias(v) for k, v in RENAMED.items()])
    return C.align_features(raw, keep=["l_orderkey", "l_linenumber"])


NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]

DIRTY = """dirty AS (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_orderkey % 7 = 0 THEN CAST('Infinity' AS DOUBLE) ELSE l_quantity END AS l_quantity,
    CASE WHEN l_orderkey % 11 = 0 THEN CAST('NaN' AS DOUBLE) ELSE l_extendedprice END AS l_extendedprice,
    CASE WHEN l_orderkey % 13 = 0 THEN CAST('-Infinity' AS DOUBLE) ELSE l_discount END AS l_discount,
    CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_tax END AS l_tax
  FROM lineitem)"""


def _dirty(spark, sf):
    bad = {"l_quantity": (7, "Infinity"), "l_extendedprice": (11, "NaN"), "l_discount": (13, "-Infinity"), "l_tax": (17, None)}
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        *[F.when(F.col("l_orderkey") % m == 0, F.lit(v).cast("double")).otherwise(F.col(c)).alias(c) for c, (m, v) in bad.items()],
    )


@query(
    "clean_features",
    f"WITH {DIRTY} SELECT l_orderkey, l_linenumber, "
    + ", ".join(f"CASE WHEN {c} IS NULL OR NOT isfinite({c}) THEN 0.0::DOUBLE ELSE {c} END AS {c}" for c in NUMBERS)
    + " FROM dirty",
)
def clean_features(spark, sf):
    return C.clean_numeric(_dirty(spark, sf), NUMBERS)


@query(
    "nonfinite_counts",
    f"WITH {DIRTY} "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NULL OR NOT isfinite({c})) AS n FROM dirty" for c in NUMBERS
    ),
)
def nonfinite_counts(spark, sf):
    return C.nonfinite_count(_dirty(spark, sf), NUMBERS, per_column=True)


@query(
    "scaler_fit",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {sql_round(f'avg({c})', 4)} AS mean, {sql_round(f'stddev_pop({c})', 4)} AS std FROM lineitem"
        for c in NUMBERS
    ),
)
def scaler_fit(spark, sf):
    return fit_scaler(table(spark, sf, "lineitem"), NUMBERS).select(
        "column", rounded("mean", 4).alias("mean"), rounded("std", 4).alias("std")
    )


@query(
    "scaled_features",
    "WITH s AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in NUMBERS)
    + " FROM lineitem) SELECT l_orderkey, l_linenumber, "
    + ", ".join(sql_round(f"({c} - m_{c}) / s_{c}", 4) + f" AS {c}" for c in NUMBERS)
    + " FROM lineitem, s",
)
def scaled_features(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *NUMBERS)
    scaled = Scaler.fit(lines, NUMBERS).transform(lines)
    return scaled.select("l_orderkey", "l_linenumber", *[rounded(c, 4).alias(c) for c in NUMBERS])


@query(
    "training_frame",
    """WITH j AS (
  SELECT d.doc_id, CASE WHEN toxic = 1 THEN 'SSH-Patator' WHEN quality = 1 THEN 'BENIGN' ELSE 'OTHER' END AS label,
         CAST(n_chars AS DOUBLE) AS n_chars, CASE WHEN d.doc_id % 5 = 0 THEN NULL ELSE CAST(length(text) AS DOUBLE) / n_chars END AS ratio
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id, n_chars, coalesce(ratio, 0) AS ratio, CASE WHEN label = 'SSH-Patator' THEN 1 ELSE 0 END AS target
FROM j WHERE label IN ('SSH-Patator', 'BENIGN')""",
)
def training_frame(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    name = F.when(F.col("toxic") == 1, "SSH-Patator").when(F.col("quality") == 1, "BENIGN").otherwise("OTHER")
    joined = docs.join(labels, "doc_id").select(
        "doc_id",
        name.alias("label"),
        F.col("n_chars").cast("double").alias("n_chars"),
        F.when(F.col("doc_id") % 5 != 0, F.length("text") / F.col("n_chars")).alias("ratio"),
    )
    return C.training_frame(joined, ["n_chars", "ratio"], keep=["doc_id"])


@query(
    "union_by_name",
    """SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, -1 AS nation FROM customer
UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL, s_nationkey FROM supplier""",
)
def union_by_name(spark, sf):
    c = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("acctbal"),
        F.col("c_mktsegment").alias("segment"),
    )
    s = table(spark, sf, "supplier").select(
        F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("id"),
        F.col("s_name").alias("name"),
    )
    return C.union_by_name(c, s).withColumn("nation", F.coalesce("nation", F.lit(-1)))
