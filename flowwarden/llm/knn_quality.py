"""Quality of texts by the votes of labelled neighbours in a latent-semantic space.

Texts become tf-idf weights of hashed byte n-grams (case and symbols kept) beside a mark for the entropy of
their counts, which is low in texts that repeat themselves; and these are projected on the leading
singular vectors of a bounded labelled sample.  The labelled vectors are broadcast;
every document is compared with all of them in blocks of exact cosine products, and its
nearest neighbours vote with their similarity as weight.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import fresh, gram_counts, held_out, sample_share, ship, shipped, utf8

#: Bound of the labelled sample; it also bounds what is broadcast (rows x WIDTH floats).
TRAIN_ROWS = 3000
BITS = 12
GRAMS = (1, 3)
WIDTH = 48
NEIGHBOURS = 25
#: Weight of a neighbour: its similarity, if positive, to this power.
POWER = 4
BLOCK = 256
EMPTY_SCORE = 0.0
#: Entropy marks (one a nat) and their weight beside the n-grams.
MARKS, MARK_WEIGHT = 9, 0.6


@dataclass
class Neighbours:
    """Idf weights, projection, unit vectors of the labelled texts and their labels."""

    idf: np.ndarray
    project: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray

    def vector(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.concatenate([features(c, self.idf) @ self.project for c in blocks(counts)]))

    def scores(self, counts: np.ndarray) -> np.ndarray:
        """Share of the votes for label 1 of each row of a block of n-gram counts."""
        if not len(self.labels):
            return np.full(len(counts), EMPTY_SCORE)
        like = self.vector(counts) @ self.vectors.T
        k = min(NEIGHBOURS, like.shape[1])
        near = np.argpartition(-like, k - 1, axis=1)[:, :k]
        weight = np.clip(np.take_along_axis(like, near, axis=1), 1e-6, 1) ** POWER
        return (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)


def features(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of tf-idf weights and entropy marks; an entropy between two marks is shared by both."""
    share = counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)
    entropy = -(share * np.log(np.where(share > 0, share, 1))).sum(axis=1)
    marks = np.clip(1 - np.abs(entropy[:, None] - np.arange(MARKS)), 0, None)
    return unit(np.hstack([unit(np.log1p(counts) * idf), MARK_WEIGHT * unit(marks)]))


def blocks(rows: np.ndarray) -> list[np.ndarray]:
    """Rows in blocks, so that work arrays stay small."""
    return [rows[i : i + BLOCK] for i in range(0, max(1, len(rows)), BLOCK)]


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _counts(column: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of n-gram counts, `BLOCK` rows each."""
    data, offsets = utf8(column)
    for at in range(0, len(column), BLOCK):
        cut = offsets[at : at + BLOCK + 1]
        yield np.array([gram_counts(data[a:b], GRAMS, BITS) for a, b in zip(cut[:-1], cut[1:], strict=True)])


def train(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "quality", rows: int = TRAIN_ROWS
) -> Neighbours:
    """From about `rows` labelled documents at most, none of them held out; a document's labels count once (the larger)."""
    known = labels.filter(~held_out(F.col(id_col)) & F.col(label).isin(0, 1) & F.col(id_col).isNotNull())
    known = known.groupBy(F.col(id_col).alias("id")).agg(F.max(label).cast("int").alias("label"))
    n = known.count()
    if n == 0:
        return Neighbours(np.zeros(0), np.zeros((0, 0)), np.zeros((0, WIDTH)), np.zeros(0))
    chosen = known.filter(sample_share(F.col("id").cast("string"), min(1.0, rows / n)))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).join(F.broadcast(chosen), "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = []
            for block in _counts(batch.column(1)):
                packed += [np.minimum(row, 1 << 30).astype(np.int32).tobytes() for row in block]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary())], names=["label", "counts"])

    found = texts.select("label", "text").mapInArrow(run, "label int, counts binary").collect()
    found.sort(key=lambda r: (r["label"], r["counts"]))
    if not found:
        return Neighbours(np.zeros(0), np.zeros((0, 0)), np.zeros((0, WIDTH)), np.zeros(0))
    votes = np.array([r["label"] for r in found], np.float64)
    counts = np.frombuffer(b"".join(r["counts"] for r in found), np.int32).reshape(len(found), -1)
    del found
    idf = np.log((1 + len(counts)) / (1 + np.count_nonzero(counts, axis=0))) + 1
    return fit(counts, idf, votes)


def fit(counts: np.ndarray, idf: np.ndarray, labels: np.ndarray) -> Neighbours:
    """Leading right singular vectors by subspace iteration."""
    x = np.concatenate([features(c, idf) for c in blocks(counts)])  # single precision
    width = min(WIDTH, *x.shape)
    basis = np.linalg.qr(np.random.default_rng(3).standard_normal((x.shape[1], min(width + 12, *x.shape))))[0].astype(np.float32)
    for _ in range(6):
        basis = np.linalg.qr(x.T @ (x @ basis))[0]
    small = x @ basis
    _, _, turn = np.linalg.svd(small, full_matrices=False)
    model = Neighbours(idf, (basis @ turn[:width].T).astype(np.float32), np.zeros((0, width)), labels)
    model.vectors = model.vector(counts)
    return model


def score(docs: DataFrame, model: Neighbours, text: str = "text") -> DataFrame:
    """Adds `score` (0 to 1, higher: label 1 is likelier) to every row.

    A null text is an empty one; an empty text, and every text for a model without labels, has the score
    0: nothing speaks for it.  Only the text is read.  Repeated rows stay and score alike, an empty table gives
    an empty one; a taken name gets an underscore.  Scores are rounded to six places.
    """
    name = fresh(docs, "score")
    schema = T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())])
    place = docs.columns.index(text)
    sent = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(sent)
        for batch in batches:
            found = []
            for block in _counts(batch.column(place)):
                values = model.scores(block)
                values[block.sum(axis=1) == 0] = EMPTY_SCORE
                found.append(values)
            values = np.round(np.clip(np.concatenate(found), 0, 1), 6) if found else np.empty(0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(values, pa.float64())], names=schema.names)

    return docs.mapInArrow(run, schema)
