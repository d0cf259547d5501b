"""Near-duplicate groups by min-max hashing.

Each permutation of a document's shingle set gives two signature values, its smallest and its
largest hash, so 64 permutations give 128 values.  Bands of a few values are bucket keys.  The number of
values in a band is the largest with which a pair just at the threshold meets in no bucket with a
probability below `MISS` (one in a million).

Equal sets are one node from the start.  In a bucket every node is compared with one hub only, the
node that meets most others, so large groups of near copies cost a few comparisons each.  Links
found so far are joined to components.  Around a hub that still meets several components, members of
different components are compared where a link is possible.  With many members that is found
by what sets them apart from the hub: for sets u and v with differences D(u), D(v) from the hub
(shingles in one but not in both), the difference of u and v is |D(u)| + |D(v)| - 2 |D(u) & D(v)|, so
a link needs a number of common elements of D(u) and D(v), and thus one among the rarest few
of either.  Those are the keys of the join.  So of all nodes that share a bucket, every pair is
linked, connected or ruled out, and no pairs are made but those with a rare difference in common.
All links are confirmed on the full sets.  Nothing is collected; groups are never gathered in a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.components import components
from flowwarden.llm.text import Hasher, Words, _splitmix, batch_rows, fresh, mix, space_separated
from flowwarden.session import durable

PERMUTATIONS = 64
MISS = 1e-6
ROWS_AT_ONCE = 2048
#: Hubs with up to so many members are searched pair by pair; either way has the same result.
FEW = 24

SKETCH = "n_shingles bigint, d1 bigint, d2 bigint, keys array<bigint>"


def band_rows(percent: int) -> int:
    """Values in a band: as many as the threshold allows."""
    total = 2 * PERMUTATIONS
    ok = [r for r in range(1, total) if (1 - (percent / 100) ** r) ** (total // r) <= MISS]
    return max(ok, default=1)


def shingle_sets(batch: pa.RecordBatch, text: str, k: int, hasher: Hasher) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each row; a row without words has none."""
    table = space_separated()
    for _, _, data, offsets in batch_rows(batch, text):
        words = Words(data, offsets, table)
        hashes, _, first = hasher.shingles(hasher.words(words), words.first, k)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a < 2:
                yield hashes[a:b]
                continue
            part = np.sort(hashes[a:b])
            fresh_value = np.empty(len(part), bool)
            fresh_value[0] = True
            np.not_equal(part[1:], part[:-1], out=fresh_value[1:])
            yield part[fresh_value]


def min_max(values: np.ndarray, times: np.ndarray, plus: np.ndarray) -> np.ndarray:
    """Smallest, then largest value of the set under each permutation."""
    low = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(times), np.uint64)
    for i in range(0, len(values), ROWS_AT_ONCE):
        seen = values[i : i + ROWS_AT_ONCE, None] * times + plus
        np.minimum(low, seen.min(axis=0), out=low)
        np.maximum(high, seen.max(axis=0), out=high)
    return np.concatenate([low, high])


def digest(values: np.ndarray) -> tuple[int, int]:
    raw = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def sketches(docs: DataFrame, id_col: str, text: str, k: int, percent: int) -> DataFrame:
    """(id, n_shingles, d1, d2, keys): set size, a 128-bit digest of the set, and its bucket keys."""
    rows = band_rows(percent)
    bands = 2 * PERMUTATIONS // rows
    schema = T.StructType([docs.schema[id_col], *T.StructType.fromDDL(SKETCH).fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        times, plus = _splitmix(PERMUTATIONS, 11) | np.uint64(1), _splitmix(PERMUTATIONS, 12)
        place = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        factor = _splitmix(rows, 13) | np.uint64(1)
        with np.errstate(over="ignore"):
            for batch in batches:
                sizes, d1, d2, keys, cuts = [], [], [], [], [0]
                for values in shingle_sets(batch, text, k, hasher):
                    sizes.append(len(values))
                    if len(values):
                        signature = mix(min_max(values, times, plus))[: bands * rows].reshape(bands, rows)
                        keys.append(mix((signature * factor).sum(axis=1, dtype=np.uint64) + place))
                        one, two = digest(values)
                    else:
                        one = two = None
                    d1.append(one)
                    d2.append(two)
                    cuts.append(cuts[-1] + bands * bool(len(values)))
                flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(d1, pa.int64()),
                        pa.array(d2, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat)),
                    ],
                    names=schema.names,
                )

    return docs.select(id_col, text).mapInArrow(run, schema)


def full_sets(docs: DataFrame, text: str, k: int) -> DataFrame:
    """(d1, d2, members): the whole set of each text as packed 8-byte hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in batches:
            for start in range(0, batch.num_rows, 500):
                part = batch.slice(start, 500)
                found = [(*digest(v), v.tobytes()) for v in shingle_sets(part, text, k, hasher) if len(v)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([f[i] for f in found], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary()))],
                    names=["d1", "d2", "members"],
                )

    return docs.select(text).mapInArrow(run, "d1 bigint, d2 bigint, members binary")


def measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, na, nb, both) of pairs of nodes: set sizes and the size of the intersection."""
    left = sets.select(F.col("nid").alias("a"), F.col("members").alias("ma"))
    right = sets.select(F.col("nid").alias("b"), F.col("members").alias("mb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                short, long = (p, q) if len(p) <= len(q) else (q, p)
                at = np.searchsorted(long, short)
                at[at == len(long)] = 0
                out.append((len(p), len(q), int(np.count_nonzero(long[at] == short))))
            counts = [pa.array([o[i] for o in out], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *counts], names=["a", "b", "na", "nb", "both"])

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "ma", "mb")
    return joined.mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, both bigint")


def similar(both: Column, na: Column, nb: Column, percent: int) -> Column:
    return 100 * both >= percent * (na + nb - both)


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row.

    Words end at white space, A-Z are lower-cased.  The set of a row is its distinct k-word shingles; with fewer words
    its whole sequence; a null text or one without words has none and is linked with nothing.
    Rows whose sets have a similarity of at least `percent` / 100 are linked; `component_id` is
    the smallest id that links reach, and rows with that id are kept.  Repeated rows, and rows that
    share an id, get a row each; a null id counts as no id, and a row with a null id is kept only
    if its whole component has none.  An empty table gives an empty one; other columns are ignored.
    """
    sketch = durable(sketches(docs, id_col, text, k, percent).withColumnRenamed(id_col, "id"))
    # One node per distinct set, numbered once and for all by writing it.
    nodes = durable(
        sketch.filter(F.col("n_shingles") > 0)
        .groupBy("d1", "d2")
        .agg(F.min("id").alias("low"), F.max(F.col("id").isNull()).alias("bare"), F.first("n_shingles").alias("n"), F.first("keys").alias("keys"))
        .withColumn("nid", F.monotonically_increasing_id())
    )
    buckets = nodes.select(F.explode("keys").alias("key"), "nid")
    counts = buckets.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    # Rows of buckets with two nodes or more; far fewer than all.
    shared = durable(buckets.join(counts, "key"))
    central = shared.groupBy("nid").agg(F.sum("c").alias("met"))
    best = F.max(F.struct("met", (-F.col("nid")).alias("minus")))
    hubs = shared.join(central, "nid").groupBy("key").agg((-best["minus"]).alias("hub"))
    first = durable(
        shared.join(hubs, "key").filter(F.col("nid") != F.col("hub")).select(F.col("nid").alias("a"), F.col("hub").alias("b")).distinct()
    )
    # Texts of the nodes that share a bucket, and their sets; the digest tells rows of one id apart.
    nothing = F.lit(-(1 << 63)).cast("bigint")
    known = shared.select("nid").distinct().join(nodes.select("nid", "d1", "d2", "low", "bare"), "nid")
    ids = known.select(F.coalesce("low", nothing).alias("id")).union(known.filter("bare").select(nothing)).distinct()
    texts = docs.select(F.coalesce(F.col(id_col), nothing).alias("id"), F.col(text).alias("text"))
    sets = durable(
        full_sets(texts.join(ids, "id", "left_semi"), "text", k)
        .join(known.select("nid", "d1", "d2"), ["d1", "d2"])
        .select("nid", "members")
        .dropDuplicates(["nid"])
    )
    star = durable(measured(first, sets))
    linked = similar(F.col("both"), F.col("na"), F.col("nb"), percent)
    links = star.filter(linked).select("a", "b")
    label = components(links, "a", "b")
    more = durable(_across(star, label, sets, percent))
    links = links.union(durable(measured(more, sets)).filter(linked).select("a", "b"))
    label = components(links, "a", "b")
    named = nodes.join(label, nodes["nid"] == label["node"], "left").select(
        "d1", "d2", "low", F.coalesce("component", "nid").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = named.join(lowest, "component").select("d1", "d2", "component_id")
    out = sketch.drop("keys").join(by_set, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id"))
    return out.select(
        F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept")
    )


def _across(star: DataFrame, label: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): nodes of different components around one hub that may still be linked.

    star: (a, b, na, nb, both) of nodes a and their hubs b.
    """
    own = label.select(F.col("node").alias("a"), F.col("component").alias("ca"))
    hub = label.select(F.col("node").alias("b"), F.col("component").alias("cb"))
    placed = star.join(own, "a", "left").join(hub, "b", "left").select(
        F.col("b").alias("hub"),
        F.col("a").alias("nid"),
        F.col("na").alias("n"),
        F.coalesce("ca", "a").alias("component"),
        F.coalesce("cb", "b").alias("hub_component"),
        # Elements in one set but not in both, of the node and of the hub.
        (F.col("na") + F.col("nb") - 2 * F.col("both")).alias("d"),
        F.col("nb").alias("nh"),
        similar(F.col("both"), F.col("na"), F.col("nb"), percent).alias("near"),
    )
    low, high = F.min(F.least("component", "hub_component")), F.max(F.greatest("component", "hub_component"))
    mixed = placed.groupBy("hub").agg(low.alias("x"), high.alias("y"), F.count(F.lit(1)).alias("m")).filter("x <> y and m > 1")
    rows = durable(placed.join(mixed.select("hub", "m"), "hub").drop("hub_component"))
    small = rows.filter(F.col("m") <= FEW).withColumn("rest", F.col("d"))
    few = _pairs(small, small, ["hub"], percent)
    many = rows.filter(F.col("m") > FEW)
    c = (100 - percent) / (100 + percent)
    # Common differences that a link needs: with a node that is not linked to the hub, and with one that is.
    far = F.ceil((F.col("d") + c * (F.col("nh") - F.col("n"))) / 2 - 1e-6)
    close = F.ceil(F.col("d") - c * F.col("n") * (1 + 100 / percent) - 1e-6)
    keys = durable(_rarest(many, sets, {"to_far": far, "to_near": close}))
    apart, linked = ~F.col("near"), F.col("near")
    crossed = _pairs(keys.filter(linked & F.col("to_far")), keys.filter(apart & F.col("to_near")), ["hub", "element"], percent, False)
    both = keys.filter(apart & F.col("to_far"))
    return few.union(crossed).union(_pairs(both, both, ["hub", "element"], percent)).distinct()


def _pairs(left: DataFrame, right: DataFrame, on: list[str], percent: int, once: bool = True) -> DataFrame:
    """(a, b) with equal keys, different components, and sizes and differences that allow a link."""
    names = {"nid": "", "n": "n", "component": "c", "d": "d", "rest": "r"}
    x = left.select(*on, *[F.col(k).alias(v + "a") for k, v in names.items()])
    y = right.select(*on, *[F.col(k).alias(v + "b") for k, v in names.items()])
    # At the first element in common no more can be common than this one and what comes after it.
    need = (F.col("da") + F.col("db") - (100 - percent) / (100 + percent) * (F.col("na") + F.col("nb"))) / 2 - 1e-6
    may = (F.col("ca") != F.col("cb")) & (percent * F.greatest("na", "nb") <= 100 * F.least("na", "nb"))
    may = may & (1 + F.least("ra", "rb") >= need)
    if once:
        may = may & (F.col("a") < F.col("b"))
    return x.join(y, on).filter(may).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def _rarest(rows: DataFrame, sets: DataFrame, needs: dict[str, Column]) -> DataFrame:
    """rows (hub, nid, n, component, near, d) by their elements of difference, rarest first.

    For each need a flag tells whether the element is among the first d - need + 1, one of which two nodes with so
    many in common must share.  Elements that no other member has are counted, but not returned.
    """
    left = sets.select(F.col("nid"), F.col("members").alias("ma"))
    right = sets.select(F.col("nid").alias("hub"), F.col("members").alias("mb"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, cuts = [], [0]
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                out.append(np.setxor1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True))
                cuts.append(cuts[-1] + len(out[-1]))
            flat = np.concatenate(out).view(np.int64) if out else np.empty(0, np.int64)
            elements = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), elements], names=["hub", "nid", "elements"])

    pairs = rows.select("hub", "nid").join(left, "nid").join(right, "hub").select("hub", "nid", "ma", "mb")
    apart = pairs.mapInArrow(run, "hub bigint, nid bigint, elements array<bigint>").select("hub", "nid", F.explode("elements").alias("element"))
    apart = durable(apart)
    times = apart.groupBy("hub", "element").agg(F.count(F.lit(1)).alias("df")).filter("df > 1")
    lists = apart.join(times, ["hub", "element"]).groupBy("hub", "nid").agg(F.sort_array(F.collect_list(F.struct("df", "element"))).alias("e"))
    at = F.posexplode("e").alias("at", "e")
    out = rows.join(lists.withColumn("alone", F.size("e")), ["hub", "nid"]).select(*rows.columns, "alone", at)
    place = F.col("d") - F.col("alone") + F.col("at") + 1
    flags = {k: place <= F.col("d") - F.greatest(need, F.lit(1)) + 1 for k, need in needs.items()}
    out = out.withColumns(flags).select(
        "hub", "nid", "n", "component", "near", "d", (F.col("d") - place).alias("rest"), F.col("e.element").alias("element"), *needs
    )
    return out.filter(F.array_contains(F.array(*needs), True))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of `docs` that are kept: one document of each group; columns as they were.

    Rows that share an id are one document and go together; rows without an id stay.
    """
    key = fresh(docs, "gone")
    gone = near_duplicates(docs, id_col, text, k, percent).filter(~F.col("kept")).select(F.col(id_col).alias(key)).distinct()
    return docs.join(gone, docs[id_col] == F.col(key), "left_anti")
