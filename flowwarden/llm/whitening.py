"""Whitening of embeddings by the covariance of their distinct vectors.

Entries are put on a grid of whole numbers, so equal vectors can be told exactly.  Identical vectors
are grouped with their number; the number, or one, is the weight with which a vector enters the fit.
Sums of whole numbers give the mean, a second pass multiplies centred blocks (one GEMM a batch,
partial matrices are summed in Spark), and the eigenvectors of the small matrix are taken on the
driver.  Each distinct vector is whitened once; the results are joined back to the rows.

A key is the vector itself, packed as 16-bit numbers where they fit and as 64-bit ones elsewhere.
What the driver holds follows the number of dimensions only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import fresh, ship, shipped
from flowwarden.session import durable

GRID = 256
COMPONENTS = 4
BLOCK_ROWS = 4096
#: A component with less than this share of the largest variance has none: rounding, not data.
RANK = 1e-12


def pack_rows(x: np.ndarray) -> list[bytes]:
    """Whole-number vectors as bytes, 2 or 8 bytes an entry; each vector has one form only."""
    narrow = ((x >= -(1 << 15)) & (x < 1 << 15)).all(axis=1)
    small, large = x.astype("<i2"), x.astype("<i8")
    return [small[i].tobytes() if narrow[i] else large[i].tobytes() for i in range(len(x))]


def unpack_rows(packed: pa.Array, dim: int) -> np.ndarray:
    out = np.empty((len(packed), dim), np.int64)
    for i, b in enumerate(packed.to_pylist()):
        out[i] = np.frombuffer(b, "<i2" if len(b) == 2 * dim else "<i8")
    return out


def grid_keys(column: pa.Array, dim: int, grid: int = GRID) -> pa.Array:
    """Packed floor(grid * c) of each vector of `dim` finite entries, null for the others."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    out: list[bytes | None] = [None] * len(column)
    sized = pc.fill_null(pc.equal(pc.list_value_length(column), dim), False).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(sized)
    if dim and len(at):
        flat = column.take(pa.array(at)).flatten().cast(pa.float64())
        c = flat.to_numpy(zero_copy_only=False).reshape(len(at), dim)  # nulls become NaN
        good = np.isfinite(c).all(axis=1)
        x = np.floor(grid * c[good])
        # Beyond 64 bits there is no whole number; such a vector has no place on the grid.
        fits = (np.abs(x) < 2.0**63).all(axis=1)
        for i, key in zip(at[good][fits].tolist(), pack_rows(x[fits].astype(np.int64)), strict=True):
            out[i] = key
    return pa.array(out, pa.binary())


def dimension(vectors: DataFrame, column: str) -> int:
    """The length that most vectors have (the longer one of equals); 0 without any."""
    sizes = vectors.filter(F.size(column) > 0).groupBy(F.size(column).alias("n")).agg(F.count(F.lit(1)).alias("rows"))
    top = sizes.orderBy(F.col("rows").desc(), F.col("n").desc()).first()
    return top["n"] if top else 0


def _blocks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, BLOCK_ROWS):
            part = batch.slice(at, BLOCK_ROWS)
            yield unpack_rows(part.column(0), dim), part.column(1).to_numpy()


def exact_sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """Sum of weights and weighted sum of each entry, exact at any size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, sums = 0, [0] * dim
        for x, w in _blocks(batches, dim):
            total += int(w.sum())
            if dim and float(np.abs(x).max(initial=0)) * float(w.sum()) < 2.0**62:
                part = (w @ x).tolist()
            else:
                part = [sum(map(int.__mul__, w.tolist(), x[:, j].tolist())) for j in range(dim)]
            sums = [a + b for a, b in zip(sums, part, strict=True)]
        # High and low halves, so that Spark's sums stay exact.
        rows = [total, *sums]
        high, low = [v >> 32 for v in rows], [v & 0xFFFFFFFF for v in rows]
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dim), pa.int32()), pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["j", "high", "low"])

    parts = distinct.select("key", "weight").mapInArrow(run, "j int, high bigint, low bigint")
    found = {r["j"]: (int(r["h"]) << 32) + int(r["l"]) for r in parts.groupBy("j").agg(F.sum("high").alias("h"), F.sum("low").alias("l")).collect()}
    return found.get(-1, 0), [found.get(j, 0) for j in range(dim)]


def scatter(rows: DataFrame, dim: int, vectors: Callable[[list[pa.Array]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Sum of w * v v^T over all rows; `vectors` gives centred vectors and weights of a batch's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                v, w = vectors(part.columns)
                total += (v * w[:, None]).T @ v
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(total.tolist(), pa.list_(pa.float64()))], names=["i", "row"])

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, row in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                mine[i] = mine.get(i, 0.0) + np.array(row)
        yield pa.RecordBatch.from_arrays([pa.array(list(mine), pa.int32()), pa.array([r.tolist() for r in mine.values()], pa.list_(pa.float64()))], names=["i", "row"])

    shape = "i int, row array<double>"
    out = np.zeros((dim, dim))
    # A task adds up what the partitions found for its rows of the matrix.
    for r in rows.mapInArrow(run, shape).repartition("i").mapInArrow(added, shape).collect():
        out[r["i"]] = r["row"]
    return out


@dataclass
class Whitener:
    """A fit: weights `n`, exact sums `total`, unit eigenvectors as rows by falling eigenvalue, and the trace."""

    n: int
    total: list[int]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.total)

    @property
    def mean(self) -> np.ndarray:
        return np.array([s / self.n for s in self.total]) if self.n else np.zeros(self.dim)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, from the exact whole number n * x - S where 64 bits hold it."""
        if self._narrow(x):
            return (x * self.n - np.array(self.total, np.int64)) / self.n
        return x - self.mean

    def _narrow(self, x: np.ndarray) -> bool:
        most = float(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.total), default=0)
        return most < 2.0**53

    def deviation(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n * x - S)^2, exact; null where it needs more than 64 bits."""
        top = (float(np.abs(x).max(initial=0)) * self.n + max(map(abs, self.total), default=0)) ** 2 * max(1, self.dim)
        if top < 2.0**62:
            d = x * self.n - np.array(self.total, np.int64)
            return (d * d).sum(axis=1).tolist()
        exact = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.total, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in exact]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Projections over the root of the eigenvalue; NaN for a component without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            scale = np.where(self.values > 0, 1 / np.sqrt(np.where(self.values > 0, self.values, 1)), np.nan)
        return self.centred(x) @ self.vectors.T * scale


def fit(distinct: DataFrame, dim: int, components: int = COMPONENTS) -> Whitener:
    """Mean and leading eigenvectors of the weighted covariance of `distinct` (key, weight)."""
    n, total = exact_sums(distinct, dim)
    empty = Whitener(n, total, np.zeros((0, dim)), np.zeros(0), 0.0)
    if not n:
        return empty
    sent = ship(distinct.sparkSession, empty)

    def vectors(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        return shipped(sent).centred(unpack_rows(columns[0], dim)), columns[1].to_numpy().astype(float)

    cov = scatter(distinct.select("key", "weight"), dim, vectors) / n
    values, basis = np.linalg.eigh((cov + cov.T) / 2)
    order = np.argsort(-values, kind="stable")[: min(components, dim)]
    values, basis = values[order], basis[:, order].T
    # Either sign is an eigenvector; the entry of the largest size is made positive.
    signs = np.sign(basis[np.arange(len(basis)), np.abs(basis).argmax(axis=1)])
    values = np.where(values > RANK * max(values.max(initial=0.0), 0.0), values, 0.0)
    return Whitener(n, total, basis * signs[:, None], values, float(np.trace(cov)))


def identity_error(white: DataFrame, found: Whitener) -> float | None:
    """Largest absolute entry of the whitened vectors' covariance minus the identity; null without a component."""
    has = np.flatnonzero(found.values > 0)
    if not len(has):
        return None
    wide = white.select(F.col("weight"), *[F.get("whitened", F.lit(int(i))).alias(f"w{i}") for i in has])
    means = wide.agg(*[(F.sum(F.col(f"w{i}") * F.col("weight")) / F.sum("weight")).alias(f"w{i}") for i in has]).first()
    mean = np.array([means[f"w{i}"] for i in has])

    def vectors(columns: list[pa.Array]) -> tuple[np.ndarray, np.ndarray]:
        return np.column_stack([c.to_numpy(zero_copy_only=False) for c in columns[1:]]) - mean, columns[0].to_numpy().astype(float)

    cov = scatter(wide, len(has), vectors) / found.n
    return float(np.abs(cov - np.eye(len(has))).max())


def whiten(
    embeddings: DataFrame, vector: str = "embedding", weights: str = "one", components: int = COMPONENTS, grid: int = GRID
) -> DataFrame:
    """Adds `n`, `deviation`, `whitened` and `explained` (arrays, a value a component), and `identity_error`.

    `weights` is "one" (each distinct vector counts once) or "count" (as often as it stands there).

    Rows whose vector is null or empty, holds a null or a non-finite entry or one beyond 64 bits on the
    grid, or has another length than most vectors, are dropped.  Repeated rows and null ids stay.  A
    component without variance (equal vectors, fewer vectors than components) has a null in `whitened`
    and 0 in `explained`; there are as many components as dimensions at most.  `deviation` is null where
    it does not fit 64 bits.  An empty table gives an empty one.  Added columns whose name is taken get
    an underscore.
    """
    if weights not in ("one", "count"):
        raise ValueError("weights is 'one' or 'count'")
    spark, names = embeddings.sparkSession, embeddings.columns
    dim = dimension(embeddings, vector)
    key = fresh(embeddings, "_key")
    schema = T.StructType([*embeddings.schema.fields, T.StructField(key, T.BinaryType())])
    where = names.index(vector)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, grid_keys(batch.column(where), dim, grid)], names=[*names, key])

    rows = embeddings.mapInArrow(keyed, schema).filter(F.col(key).isNotNull())
    weight = F.lit(1).cast("bigint") if weights == "one" else F.count(F.lit(1))
    # Copies collapse before the shuffle, so a vector that many rows hold is one row a task.
    distinct = durable(rows.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"), weight.alias("weight")).select("key", "weight"))
    found = fit(distinct, dim, components)
    sent = ship(spark, found)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shipped(sent)
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(at, BLOCK_ROWS)
                x = unpack_rows(part.column(0), dim)
                white = [[None if v != v else v for v in row] for row in fitted.whitened(x).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(fitted.deviation(x), pa.int64()), pa.array(white, pa.list_(pa.float64()))],
                    names=["key", "weight", "deviation", "whitened"],
                )

    white = durable(distinct.mapInArrow(run, "key binary, weight bigint, deviation bigint, whitened array<double>"))
    error = identity_error(white, found)
    explained = [float(v / found.trace) if found.trace > 0 else 0.0 for v in found.values]
    other, dev, out = (fresh(embeddings, c) for c in ("_other", "_deviation", "_whitened"))
    added = {
        "n": F.lit(found.n).cast("bigint"),
        "deviation": F.col(dev),
        "whitened": F.col(out),
        "explained": F.array(*[F.lit(v) for v in explained]).cast("array<double>"),
        "identity_error": F.lit(error).cast("double"),
    }
    back = white.select(F.col("key").alias(other), F.col("deviation").alias(dev), F.col("whitened").alias(out))
    # One row a vector on this side; a vector that many rows hold is split by the adaptive planner.
    joined = rows.join(back, F.col(key) == F.col(other))
    return joined.select(*names, *[c.alias(fresh(embeddings, n)) for n, c in added.items()])
