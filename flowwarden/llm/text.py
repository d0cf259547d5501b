"""Texts of an Arrow batch as flat arrays: bytes, words and shingle hashes without a Python loop per word.

Hashes of words are polynomials modulo 2^64 over random byte values, taken as differences of one
running sum, then mixed.  They are the same in every process and at every position.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SLICE_BYTES = 1 << 20
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
BASE = 0x9E3779B97F4A7C15 | 1
MASK = (1 << 64) - 1


def _splitmix(n: int, seed: int) -> np.ndarray:
    x = (np.arange(1, n + 1, dtype=np.uint64) * np.uint64(BASE)) + np.uint64(seed & MASK)
    return mix(x)


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


def space_separated() -> np.ndarray:
    """Bytes of words that end at white space (0x20 and 0x09 to 0x0D)."""
    table = np.ones(256, bool)
    table[list(SPACES)] = False
    return table


def letters_and_digits() -> np.ndarray:
    """Bytes of words of ASCII letters, digits and anything beyond ASCII."""
    table = np.zeros(256, bool)
    table[0x30:0x3A] = table[0x41:0x5B] = table[0x61:0x7B] = True
    table[0x80:] = True
    return table


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1]
    at = at.astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `limit` bytes each; a longer text has a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end
        row = end


class Words:
    """Words of the rows of one slice: `start` and `end` bytes, `first[r] : first[r + 1]` those of row r."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray):
        self.data, self.offsets = data, offsets
        inside = is_word[data]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        edges = offsets[:-1][offsets[:-1] < len(data)]
        before[edges] = False
        self.start = np.flatnonzero(inside & ~before)
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        lasts = offsets[1:][offsets[1:] > 0] - 1
        after[lasts] = False
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)


class Hasher:
    """Word and shingle hashes; powers are kept from slice to slice."""

    def __init__(self, seed: int = 1):
        self.seed = seed
        self.values = _splitmix(256, seed)
        self.power = np.empty(0, np.uint64)

    def _powers(self, n: int) -> None:
        if len(self.power) >= n:
            return
        n = max(n, 2 * SLICE_BYTES)
        with np.errstate(over="ignore"):
            self.power = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, BASE, np.uint64)]))
            inverse = np.uint64(pow(BASE, -1, 1 << 64))
            self.back = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(n - 1, inverse, np.uint64)]))

    def words(self, words: Words, lower: bool = True) -> np.ndarray:
        data = words.data
        self._powers(len(data) + 1)
        values = self.values[lower_table()] if lower else self.values
        total = np.zeros(len(data) + 1, np.uint64)
        with np.errstate(over="ignore"):
            np.cumsum(values[data] * self.power[: len(data)], out=total[1:])
            return mix((total[words.end] - total[words.start]) * self.back[words.start])

    def shingles(self, hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash of each k-word shingle of each row, the word it starts at, and the row's range.

        A row with fewer words, but one at least, has its whole sequence as its one shingle.
        """
        n = np.diff(first)
        with np.errstate(over="ignore"):
            long = max(0, len(hashes) - k + 1)
            each = np.zeros(long, np.uint64)
            for i in range(k):
                each += hashes[i : i + long] * np.uint64(int(_splitmix(k, 77)[i]) | 1)
            each = mix(each)
            valid = np.ones(long, bool)
            for r_end in range(1, k):  # starts whose shingle would run over the row's end
                at = first[1:] - r_end
                at = at[(at >= 0) & (at < long)]
                valid[at] = False
            starts = np.flatnonzero(valid)
            if len(short := np.flatnonzero((n > 0) & (n < k))):
                # Ends of short rows that are inside another row's last k - 1 words were cut above already.
                whole = np.zeros(len(short), np.uint64)
                for i in range(k - 1):
                    here = first[short] + i
                    has = i < n[short]
                    whole[has] += hashes[here[has]] * np.uint64(int(_splitmix(k, 99)[i]) | 1)
                whole = mix(whole + n[short].astype(np.uint64))
                starts = np.concatenate([starts, first[short]])
                out = np.concatenate([each[starts[: len(starts) - len(short)]], whole])
                order = np.argsort(starts, kind="stable")
                starts, out = starts[order], out[order]
            else:
                out = each[starts]
        return out, starts, np.searchsorted(starts, first)


def batch_rows(batch: pa.RecordBatch, name: str = "text") -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of each slice of a batch's texts."""
    data, offsets = utf8(batch.column(name))
    for a, b in slices(offsets):
        yield a, b, data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]


def held_out(doc_id: Column) -> Column:
    """True for the quarter of the documents that no model may learn from; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fresh(df: DataFrame, wanted: str) -> str:
    """`wanted`, or a longer name that no column of `df` has (names are compared without case)."""
    have = {c.lower() for c in df.columns}
    while wanted.lower() in have:
        wanted += "_"
    return wanted


PIECE_BYTES = 1 << 20


def gram_counts(data: np.ndarray, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """Counts of hashed byte n-grams of one text in 2^bits buckets; long texts are read in overlapping pieces."""
    out = np.zeros(1 << bits, np.int64)
    for at in range(0, max(1, len(data)), PIECE_BYTES):
        part = data[at : at + PIECE_BYTES + max(sizes) - 1].astype(np.uint32)
        for n in sizes:
            count = min(len(part) - n + 1, PIECE_BYTES)
            if count <= 0:
                continue
            code = part[:count] * np.uint32(0x9E3779B1)
            for i in range(1, n):
                code ^= (code << np.uint32(5)) + part[i : i + count] * np.uint32(0x85EBCA6B + 2 * i)
            code *= np.uint32(0xC2B2AE35)
            out += np.bincount(code >> np.uint32(32 - bits), minlength=1 << bits)
    return out


def sample_share(column: Column, share: Column | float) -> Column:
    """True for about `share` of the rows, chosen by a hash; null is never chosen."""
    return F.pmod(F.xxhash64(column, F.lit("sample")), F.lit(1 << 40)) < F.lit(float(1 << 40)) * share


_sent: list[Broadcast] = []


def ship(spark: SparkSession, value: Any) -> Broadcast:
    """Broadcasts an object with its class, so executors need not have this package installed."""
    _sent.append(spark.sparkContext.broadcast({"packed": cloudpickle.dumps(value)}))
    return _sent[-1]


def release() -> None:
    """Lets executors drop what was shipped so far; a table that still needs it fetches it again."""
    while _sent:
        try:
            _sent.pop().unpersist()
        except Exception as gone:  # noqa: BLE001
            if "stopped" not in str(gone).lower():
                raise


def shipped(sent: Broadcast, ready: Callable[[Any], Any] = lambda value: value) -> Any:
    """`ready` of the object; a worker process makes it once and later tasks go on with it."""
    box = sent.value
    if "ready" not in box:
        box["ready"] = ready(pickle.loads(box.pop("packed")))
    return box["ready"]
