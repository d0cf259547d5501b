"""Benchmark decontamination.

Each benchmark item has a SimHash fingerprint of its five-word shingles.  A document is read in
windows of each item's size; a window's fingerprint is looked up in an index of blocks: the 64 bits
are cut into eight blocks, each with an allowance such that two fingerprints within `RADIUS` bits
agree within the allowance in one block at least.  So all items within the radius are found.  Each
is verified by the exact weighted similarity of the two bags of shingles (sum of smaller over sum
of larger multiplicities), which alone decides.

Windows with too few benchmark shingles to reach the similarity with any item get no fingerprint;
that gate loses nothing.  A text with fewer shingles than an item is itself the one window: the items that share
shingles with it are counted exactly, without a fingerprint.  At a similarity of 0.8 fingerprints differ by about 10 bits, with a
deviation of 3, so a radius of 22 misses such a pair with a probability of about 1 in 50,000, and
closer copies less often.

The items of one pass are bounded by `PASS_BYTES`; a larger benchmark takes several passes.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import Hasher, Words, _splitmix, batch_rows, letters_and_digits, mix, ship, shipped, utf8

K = 5
PERCENT = 80
RADIUS = 22
BLOCKS = 8
PASS_BYTES = 16 << 20


def allowances(radius: int = RADIUS, blocks: int = BLOCKS) -> list[int]:
    """Differing bits allowed in each block: all plus one each make radius + 1, so one block must fit."""
    base, more = divmod(radius + 1, blocks)
    return [base - 1 + (i < more) for i in range(blocks)]


def sequences(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of n < K words, as a text of n words has it."""
    long = max(0, len(hashes) - n + 1)
    total = np.zeros(long, np.uint64)
    for i in range(n):
        total += hashes[i : i + long] * np.uint64(int(_splitmix(K, 99)[i]) | 1)
    return mix(total + np.uint64(n))


class Items:
    """Fingerprints, shingle bags and block index of some benchmark items."""

    def __init__(self, ids: list[int], texts: list[str | None]):
        self.ids = ids
        hasher = Hasher()
        data, offsets = utf8(pa.array(texts, pa.string()))
        words = Words(data, offsets, letters_and_digits())
        hashes = hasher.words(words)
        shingles, _, first = hasher.shingles(hashes, words.first, K)
        count = np.diff(words.first)
        self.words = count.tolist()
        self.bags: list[tuple[np.ndarray, np.ndarray]] = []
        self.short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        self.sizes: dict[int, list[int]] = defaultdict(list)  # shingles in a window: items
        prints = np.zeros(len(ids), np.uint64)
        known = []
        for i, n in enumerate(count.tolist()):
            own = shingles[first[i] : first[i + 1]]
            self.bags.append(np.unique(own, return_counts=True))
            if n >= K:
                self.sizes[len(own)].append(i)
                prints[i] = fingerprints(own, np.array([0]), len(own))[0]
                known.append(own)
            elif n:
                self.short[n][int(own[0])].append(i)
        self.short = {n: dict(v) for n, v in self.short.items()}
        self.known = np.unique(np.concatenate(known)) if known else np.empty(0, np.uint64)
        # Items of each shingle, in order of the shingles' hashes, for texts shorter than an item.
        self.n_shingles = np.array([int(times.sum()) for _, times in self.bags], np.int64)
        full = np.flatnonzero(count >= K).tolist()
        held = np.concatenate([self.bags[i][0] for i in full]) if full else np.empty(0, np.uint64)
        order = np.argsort(held, kind="stable")
        self.held = held[order]
        self.holder = np.repeat(np.array(full, np.int32), [len(self.bags[i][0]) for i in full])[order]
        self.held_times = (np.concatenate([self.bags[i][1] for i in full]) if full else np.empty(0, np.int64)).astype(np.int32)[order]
        self.gate = np.zeros(1 << 20, bool)  # a bit for the top of each known hash, before the search
        self.gate[(self.known >> np.uint64(44)).astype(np.int64)] = True
        self.sizes = {m: np.array(v) for m, v in sorted(self.sizes.items())}
        self.prints = prints
        width = 64 // BLOCKS
        self.index: dict[int, list[list[np.ndarray]]] = {}
        for m, items in self.sizes.items():
            blocks = []
            for b, allowed in enumerate(allowances()):
                cells: list[list[int]] = [[] for _ in range(1 << width)]
                near = [sum(1 << x for x in flips) for f in range(allowed + 1) for flips in combinations(range(width), f)]
                for place, item in enumerate(items.tolist()):
                    value = int(prints[item]) >> (b * width) & ((1 << width) - 1)
                    for flip in near:
                        cells[value ^ flip].append(place)
                blocks.append([np.array(c, np.int64) for c in cells])
            self.index[m] = blocks

    def near(self, m: int, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(window, item) of fingerprints within the radius, for windows of m shingles."""
        width = 64 // BLOCKS
        items = self.sizes[m]
        met = np.zeros((len(found), len(items)), bool)
        for b, cells in enumerate(self.index[m]):
            values = (found >> np.uint64(b * width)).astype(np.int64) & ((1 << width) - 1)
            for w, v in enumerate(values.tolist()):
                met[w, cells[v]] = True
        w, place = np.nonzero(met)
        close = np.bitwise_count(found[w] ^ self.prints[items[place]]) <= RADIUS
        return w[close], items[place[close]]

    def longer(self, text: np.ndarray) -> Iterator[tuple[int, float]]:
        """(item, similarity) of the items that have more shingles than the whole text and are near enough to it."""
        have, times = np.unique(text, return_counts=True)
        low, high = np.searchsorted(self.held, have, "left"), np.searchsorted(self.held, have, "right")
        n = high - low
        at = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
        both = np.bincount(self.holder[at], np.minimum(np.repeat(times, n), self.held_times[at])).astype(np.int64)
        for item in np.flatnonzero(both).tolist():
            o, m = int(both[item]), int(self.n_shingles[item])
            if m > len(text) and 100 * o >= PERCENT * (len(text) + m - o):
                yield item, o / (len(text) + m - o)

    def similarity(self, window: np.ndarray, item: int) -> float:
        have, times = np.unique(window, return_counts=True)
        want, wanted = self.bags[item]
        _, a, b = np.intersect1d(have, want, assume_unique=True, return_indices=True)
        both = int(np.minimum(times[a], wanted[b]).sum())
        return both / (int(times.sum()) + int(wanted.sum()) - both)


def fingerprints(shingles: np.ndarray, starts: np.ndarray, m: int) -> np.ndarray:
    """SimHash of the m shingles from each start; every occurrence has a vote."""
    low, high = int(starts.min()), int(starts.max()) + m
    bits = ((shingles[low:high, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)).astype(np.int32)
    total = np.zeros((high - low + 1, 64), np.int32)
    np.cumsum(2 * bits - 1, axis=0, out=total[1:])
    votes = total[starts - low + m] - total[starts - low]
    return ((votes > 0).astype(np.uint64) << np.arange(64, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)


def leaks(items: Items, hasher: Hasher, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, float, int]]:
    """(row, item, similarity, first word) of the items in the texts of one slice, at the best window each."""
    words = Words(data, offsets, letters_and_digits())
    hashes = hasher.words(words)
    with np.errstate(over="ignore"):
        yield from _long(items, hasher, hashes, words)
        for n, want in items.short.items():
            runs = sequences(hashes, n)
            best = {}
            for at in np.flatnonzero(np.isin(runs, np.array(list(want), np.uint64))).tolist():
                row = int(np.searchsorted(words.first, at, "right")) - 1
                if at + n <= words.first[row + 1]:
                    for item in want[int(runs[at])]:
                        best.setdefault((row, item), at - int(words.first[row]))
            for (row, item), at in best.items():
                yield row, item, 1.0, at


def _long(items: Items, hasher: Hasher, hashes: np.ndarray, words: Words) -> Iterator[tuple[int, int, float, int]]:
    shingles, starts, first = hasher.shingles(hashes, words.first, K)
    if not len(items.known) or not len(shingles):
        return
    hit = items.gate[(shingles >> np.uint64(44)).astype(np.int64)]
    maybe = np.flatnonzero(hit)
    hit[maybe] = items.known[np.minimum(np.searchsorted(items.known, shingles[maybe]), len(items.known) - 1)] == shingles[maybe]
    where = np.flatnonzero(hit)
    if not len(where):
        return
    rows, per_row = np.unique(np.searchsorted(first, where, "right") - 1, return_counts=True)
    for row, n_hits in zip(rows.tolist(), per_row.tolist(), strict=True):
        a, b = int(first[row]), int(first[row + 1])
        seen = np.concatenate([[0], np.cumsum(hit[a:b])])
        best: dict[int, tuple[float, int]] = {}
        # At most b - a shingles are shared with an item of more than b - a.
        if n_hits >= -(-PERCENT * (2 * (b - a) + 1) // (100 + PERCENT)):
            best = {i: (score, 0) for i, score in items.longer(shingles[a:b])}
        for m in items.sizes:
            # Shared shingles o of two bags of m: o / (2 m - o) >= PERCENT / 100.
            need = -(-2 * PERCENT * m // (100 + PERCENT))
            if n_hits < need or b - a < m:
                continue
            at = np.flatnonzero(seen[m:] - seen[:-m] >= need)
            for part in np.array_split(at, -(-len(at) // 4096)) if len(at) else []:
                window, item = items.near(m, fingerprints(shingles[a:b], part, m))
                for w, i in zip(window.tolist(), item.tolist(), strict=True):
                    start = int(part[w])
                    score = items.similarity(shingles[a + start : a + start + m], i)
                    if 100 * score >= PERCENT - 1e-9 and score > best.get(i, (0.0, 0))[0]:
                        best[i] = (score, start)
        for i, (score, start) in best.items():
            yield row, i, score, start


def passes(bench: DataFrame, id_col: str, text: str) -> Iterator[Broadcast]:
    """Broadcast items of each pass; each is bounded by `PASS_BYTES` of text on average."""
    spark = bench.sparkSession
    items = bench.select(F.col(id_col).cast("bigint").alias("i"), F.col(text).alias("t")).filter("i is not null and t is not null")
    size = items.agg(F.sum(F.octet_length("t"))).first()[0] or 0
    n = max(1, -(-int(size) // PASS_BYTES))
    for p in range(n):
        rows = sorted(items.filter(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == p).collect())
        yield ship(spark, Items([r["i"] for r in rows], [r["t"] for r in rows]))


def contaminations(
    docs: DataFrame, bench: DataFrame, id_col: str = "doc_id", text: str = "text", item_col: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """(id, item_id, similarity, first_word, n_words): each item that a row's text holds, at its best window.

    Words are runs of letters, digits and characters beyond ASCII, A-Z lower-cased.  An item of
    fewer than five words is found where its whole sequence stands.  A text with fewer shingles than an item is
    compared whole, from its first word; `n_words` is always the item's number of words.  Null and empty texts and items
    are never found; repeated rows are found each; of equal windows the first counts.  Nulls in
    other columns change nothing; items without an id are ignored, documents without one have a null id.
    """
    schema = T.StructType([
        docs.schema[id_col],
        *T.StructType.fromDDL("item_id bigint, similarity double, first_word bigint, n_words bigint").fields,
    ])
    out = None
    for sent in passes(bench, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            items, hasher = shipped(sent), Hasher()
            for batch in batches:
                at, found = [], []
                for a, _, data, offsets in batch_rows(batch):
                    for row, item, score, start in leaks(items, hasher, data, offsets):
                        at.append(a + row)
                        found.append((items.ids[item], score, start, items.words[item]))
                columns = [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *columns], names=schema.names)

        part = docs.select(id_col, F.col(text).alias("text")).mapInArrow(run, schema)
        out = part if out is None else out.union(part)
    return out


def decontaminate(docs: DataFrame, bench: DataFrame, text: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` whose text holds no benchmark item; columns as they were, no shuffle."""
    for sent in passes(bench, item_col, item_text):

        def run(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            items, hasher = shipped(sent), Hasher()
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for a, _, data, offsets in batch_rows(batch, text):
                    for row, *_ in leaks(items, hasher, data, offsets):
                        keep[a + row] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
