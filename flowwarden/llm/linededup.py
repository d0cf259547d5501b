"""Line deduplication that can be taken back.

An index keeps a log of postings (key, document, +1 or -1), from which exact reference counts
follow, and one cuckoo filter a shard of the keys that two documents or more hold.  Inserting
documents adds keys to the filters, deleting documents takes keys out again, both exactly when a
count crosses two.  A filter answers "certainly in one document" for most lines, so only the
others are joined with the exact counts.  The filters together are broadcast up to `FILTER_BYTES`;
beyond that all lines go to the exact join: same result, more shuffle.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import fresh, mix
from flowwarden.session import scratch_path

LEAST_POINTS = 10
SHARD_KEYS = 200_000
FILTER_BYTES = 64 << 20
SLOTS = 4
KICKS = 200
SPACE = b" \t\n\x0b\x0c\r"
POSTING = "k1 bigint, k2 bigint, doc_id bigint"


class Cuckoo:
    """Cuckoo filter of 128-bit keys: 16-bit fingerprints in buckets of four, insertion and deletion.

    What finds no place after `KICKS` moves goes to a short exact list beside the buckets.
    """

    def __init__(self, keys: int = 0):
        # At most half full at first, so that later insertions find a place.
        self.buckets = 1 << max(2, int(np.ceil(np.log2(max(1, keys) / (SLOTS / 2)))))
        self.slots = np.zeros((self.buckets, SLOTS), np.uint16)
        self.rest: list[tuple[int, int]] = []

    def _places(self, k1: np.ndarray, k2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        finger = (k2.view(np.uint64) >> np.uint64(48)).astype(np.uint16)
        finger[finger == 0] = 1
        one = (k1.view(np.uint64) & np.uint64(self.buckets - 1)).astype(np.int64)
        return finger, one, one ^ self._hop(finger)

    def _hop(self, finger: np.ndarray) -> np.ndarray:
        return (mix(finger.astype(np.uint64)) & np.uint64(self.buckets - 1)).astype(np.int64)

    def insert(self, k1: np.ndarray, k2: np.ndarray) -> None:
        hop = self._hop(np.arange(1 << 16, dtype=np.uint16)).tolist()
        rng = np.random.default_rng(7)
        fingers, ones, twos = self._places(k1, k2)
        slots = self.slots.tolist()
        for finger, one, two, a, b in zip(fingers.tolist(), ones.tolist(), twos.tolist(), k1.tolist(), k2.tolist(), strict=True):
            for at in (one, two):
                if 0 in slots[at]:
                    slots[at][slots[at].index(0)] = finger
                    break
            else:
                moves, at = [], two
                for _ in range(KICKS):
                    slot = int(rng.integers(SLOTS))
                    moves.append((at, slot, slots[at][slot]))
                    finger, slots[at][slot] = slots[at][slot], finger
                    at ^= hop[finger]
                    if 0 in slots[at]:
                        slots[at][slots[at].index(0)] = finger
                        break
                else:
                    for at, slot, old in reversed(moves):
                        slots[at][slot] = old
                    self.rest.append((a, b))
        self.slots = np.array(slots, np.uint16).reshape(-1, SLOTS)

    def delete(self, k1: np.ndarray, k2: np.ndarray) -> None:
        fingers, ones, twos = self._places(k1, k2)
        for finger, one, two, key in zip(fingers, ones, twos, zip(k1.tolist(), k2.tolist(), strict=True), strict=True):
            if key in self.rest:
                self.rest.remove(key)
                continue
            for at in (one, two):
                if len(found := np.flatnonzero(self.slots[at] == finger)):
                    self.slots[at, found[0]] = 0
                    break

    def may_have(self, k1: np.ndarray, k2: np.ndarray) -> np.ndarray:
        finger, one, two = self._places(k1, k2)
        found = (self.slots[one] == finger[:, None]).any(axis=1) | (self.slots[two] == finger[:, None]).any(axis=1)
        for a, b in self.rest:
            found |= (k1 == a) & (k2 == b)
        return found

    def pack(self) -> bytes:
        rest = np.array(self.rest, np.int64).tobytes()
        return np.array([self.buckets, len(self.rest)], np.int64).tobytes() + rest + self.slots.tobytes()

    @staticmethod
    def unpack(raw: bytes) -> Cuckoo:
        out = Cuckoo()
        out.buckets, n = np.frombuffer(raw, np.int64, 2).tolist()
        out.rest = [tuple(r) for r in np.frombuffer(raw, np.int64, 2 * n, 16).reshape(-1, 2).tolist()]
        out.slots = np.frombuffer(raw, np.uint16, offset=16 + 16 * n).reshape(-1, SLOTS).copy()
        return out


def line_key(line: bytes) -> bytes | None:
    """Digest of a line's key, or None if the key is too short to count."""
    key = line.strip(SPACE).lower()  # of bytes: A-Z only
    n = len(key)
    if n < LEAST_POINTS or (n < 4 * LEAST_POINTS and len(key.decode("utf-8", "replace")) < LEAST_POINTS):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def _raw(column: pa.Array) -> Iterator[bytes]:
    for value in pc.cast(column, pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()):
        yield value.as_py() or b""


def postings(docs: DataFrame, id_col: str, text: str) -> DataFrame:
    """(k1, k2, doc_id): the distinct keys of each row; rows without an id have none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, counts = [], []
            for raw in _raw(batch.column(1)):
                own = {k for k in map(line_key, raw.split(b"\n")) if k}
                keys.extend(own)
                counts.append(len(own))
            both = np.frombuffer(b"".join(keys), np.int64).reshape(-1, 2)
            ids = np.repeat(np.asarray(batch.column(0)), counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(ids, pa.int64())], names=["k1", "k2", "doc_id"]
            )

    return docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, POSTING)


class LineIndex:
    """The log and the filters of one corpus, below a folder that all executors share."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root or scratch_path(spark, "lines")
        self.shards = 0
        self.version = 0
        self.batches = 0
        self.bytes = 0

    def _log(self) -> DataFrame:
        if not self.batches:
            return self.spark.createDataFrame([], POSTING + ", sign int")
        return self.spark.read.schema(POSTING + ", sign int").parquet(*[f"{self.root}/log/{i}" for i in range(self.batches)])

    def _append(self, rows: DataFrame) -> DataFrame:
        path = f"{self.root}/log/{self.batches}"
        rows.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(POSTING + ", sign int").parquet(path)

    def counts(self, rows: DataFrame | None = None) -> DataFrame:
        """(k1, k2, refs, first, last): exact counts, smallest and largest document of each key in use.

        With one batch of insertions each posting is a reference; else insertions and deletions of
        one document and key are set off first.
        """
        log = self._log() if rows is None else rows
        if self.batches > 1:
            log = log.groupBy("k1", "k2", "doc_id").agg(F.sum("sign").alias("sign")).filter("sign > 0")
        return log.groupBy("k1", "k2").agg(
            F.sum("sign").alias("refs"), F.min("doc_id").alias("first"), F.max("doc_id").alias("last")
        )

    def shared(self, rows: DataFrame | None = None) -> DataFrame:
        """Keys that two documents or more hold, with the smallest."""
        return self.counts(rows).filter(F.col("first") < F.col("last")).select("k1", "k2", "first")

    def insert(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> None:
        """Adds every row's lines. A document that is in the index already must be deleted first."""
        self._change(postings(docs, id_col, text).withColumn("sign", F.lit(1)))

    def delete(self, ids: DataFrame, id_col: str = "doc_id") -> None:
        """Takes all lines of these documents out again; ids that are not in the index change nothing."""
        gone = ids.select(F.col(id_col).cast("bigint").alias("doc_id")).distinct()
        live = self._log().groupBy("k1", "k2", "doc_id").agg(F.sum("sign").alias("n")).filter("n > 0")
        self._change(live.join(gone, "doc_id", "left_semi").select("k1", "k2", "doc_id", (-F.col("n")).cast("int").alias("sign")))

    def _change(self, rows: DataFrame) -> None:
        new = self._append(rows)
        old_log = self._log()
        if not self.batches:
            self.batches = 1
            self._rebuild()
            return
        keys = new.select("k1", "k2").distinct()
        before = self.shared(old_log.join(keys, ["k1", "k2"], "left_semi")).withColumn("was", F.lit(1))
        self.batches += 1
        after = self.shared(self._log().join(keys, ["k1", "k2"], "left_semi")).withColumn("is", F.lit(1))
        change = before.drop("first").join(after.drop("first"), ["k1", "k2"], "full_outer").filter(
            F.col("was").isNull() | F.col("is").isNull()
        )
        self._update(change.select("k1", "k2", F.col("is").isNotNull().alias("add")))

    def _keys(self, frame: DataFrame) -> DataFrame:
        return frame.withColumn("shard", F.pmod(F.col("k2"), F.lit(self.shards)).cast("int"))

    def _rebuild(self) -> None:
        """All filters anew from the exact counts, with as many shards as they need now."""
        path = f"{self.root}/shared/{self.version}"
        self.shared().write.mode("overwrite").parquet(path)
        shared = self.spark.read.parquet(path)
        self.shards = max(8, -(-shared.count() // SHARD_KEYS))

        def build(rows: pd.DataFrame) -> pd.DataFrame:
            found = Cuckoo(2 * len(rows))
            found.insert(rows["k1"].to_numpy(np.int64), rows["k2"].to_numpy(np.int64))
            return pd.DataFrame({"shard": [int(rows["shard"].iloc[0])], "bits": [found.pack()], "left": [len(found.rest)]})

        self._write(self._keys(shared.select("k1", "k2")).groupBy("shard").applyInPandas(build, "shard int, bits binary, left bigint"))

    def _update(self, change: DataFrame) -> None:
        """Inserts and deletes keys in the filters of their shards; other shards stay as they are."""

        def step(rows: pd.DataFrame, have: pd.DataFrame) -> pd.DataFrame:
            found = Cuckoo.unpack(have["bits"].iloc[0]) if len(have) else Cuckoo(2 * len(rows))
            if len(rows):
                add = rows["add"].to_numpy(bool)
                k1, k2 = rows["k1"].to_numpy(np.int64), rows["k2"].to_numpy(np.int64)
                found.delete(k1[~add], k2[~add])
                found.insert(k1[add], k2[add])
            shard = int((have if len(have) else rows)["shard"].iloc[0])
            return pd.DataFrame({"shard": [shard], "bits": [found.pack()], "left": [len(found.rest)]})

        grouped = self._keys(change).groupBy("shard").cogroup(self.filters().groupBy("shard"))
        self._write(grouped.applyInPandas(step, "shard int, bits binary, left bigint"))
        if self.left > 64 * self.shards:  # too full: the exact counts make larger filters
            self._rebuild()

    def _write(self, filters: DataFrame) -> None:
        self.version += 1
        filters.write.mode("overwrite").parquet(f"{self.root}/filters/{self.version}")
        row = self.filters().agg(F.sum(F.length("bits")).alias("b"), F.sum("left").alias("l")).first()
        self.bytes, self.left = row["b"] or 0, row["l"] or 0

    def filters(self) -> DataFrame:
        return self.spark.read.schema("shard int, bits binary, left bigint").parquet(f"{self.root}/filters/{self.version}")

    def _maybe_shared(self, rows: DataFrame) -> DataFrame:
        """Postings whose key may be shared, by the filters."""
        if self.bytes > FILTER_BYTES:
            return rows
        shards = self.shards
        packed = self.spark.sparkContext.broadcast({r["shard"]: bytes(r["bits"]) for r in self.filters().collect()})

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            filters = {s: Cuckoo.unpack(raw) for s, raw in packed.value.items()}
            for batch in batches:
                k1, k2 = (np.asarray(batch.column(i)) for i in range(2))
                keep = np.zeros(len(k1), bool)
                shard = k2 % shards
                order = np.argsort(shard, kind="stable")
                cut = np.searchsorted(shard[order], np.arange(shards + 1))
                for s, found in filters.items():
                    at = order[cut[s] : cut[s + 1]]
                    keep[at] = found.may_have(k1[at], k2[at])
                yield batch.filter(pa.array(keep))

        return rows.select("k1", "k2", "doc_id").mapInArrow(run, POSTING)

    def drops(self) -> DataFrame:
        """(doc_id, keys): for each document the keys whose lines it loses, as packed digests."""
        live = self._log()
        if self.batches > 1:
            live = live.groupBy("k1", "k2", "doc_id").agg(F.sum("sign").alias("sign")).filter("sign > 0")
        shared = self.spark.read.parquet(f"{self.root}/shared/0") if self.batches == 1 else self.shared()
        lost = self._maybe_shared(live).join(shared, ["k1", "k2"]).filter(F.col("doc_id") > F.col("first"))
        return lost.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("keys"))

    def dedup(self, docs: DataFrame, id_col: str = "doc_id", text: str = "text", replace: bool = False) -> DataFrame:
        """Every row of `docs` (documents of the index) with `n_lines`, `n_dropped` and `kept_text`.

        A line's key is the line stripped of white space with A-Z lower-cased; keys of fewer than ten code points
        never count.  A key that two documents or more hold loses its lines in all but the one with the
        smallest id, where all its lines stay.  A null or empty text is one empty line.  Rows with one id are one
        document; rows without an id lose nothing and count for nothing.  Added columns whose name
        is taken get an underscore.  With `replace` the kept text takes the text's place instead and nothing is added.
        """
        key, lost = fresh(docs, "line_doc"), fresh(docs, "line_keys")
        drops = self.drops().select(F.col("doc_id").alias(key), F.col("keys").alias(lost)).hint("shuffle_hash")
        joined = docs.join(drops, docs[id_col].cast("bigint") == F.col(key), "left").drop(key)
        names = [] if replace else [fresh(docs, n) for n in ("n_lines", "n_dropped", "kept_text")]
        kinds = [T.LongType(), T.LongType(), T.StringType()]
        schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(names, kinds, strict=False)]])
        place = docs.columns.index(text)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lists = batch.column(batch.num_columns - 1)
                pairs = lists.flatten()
                packed = np.stack([np.asarray(pairs.field(0), np.int64), np.asarray(pairs.field(1), np.int64)], axis=1).tobytes()
                sizes = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))]) * 16
                sizes = sizes.astype(np.int64).tolist()
                texts, n_lines, n_dropped = [], [], []
                for i, raw in enumerate(_raw(batch.column(place))):
                    lines = raw.split(b"\n")
                    a, b = sizes[i], sizes[i + 1]
                    gone = {packed[j : j + 16] for j in range(a, b, 16)}
                    kept = [x for x in lines if line_key(x) not in gone] if gone else lines
                    n_lines.append(len(lines))
                    n_dropped.append(len(lines) - len(kept))
                    texts.append(b"\n".join(kept))
                kept_text = pa.array(texts, pa.binary()).cast(pa.string())
                columns = batch.columns[:-1]
                if replace:
                    columns[place] = kept_text.cast(columns[place].type)
                else:
                    columns += [pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()), kept_text]
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

        return joined.select(*[docs[c] for c in docs.columns], lost).mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text: str = "text", replace: bool = False) -> DataFrame:
    """One batch: all rows go into a new index and are judged by it (see `LineIndex.dedup`).

    The index goes away when the session ends; for one that stays, use `LineIndex` with a folder.
    """
    spark = docs.sparkSession
    index = LineIndex(spark)
    at = spark._jvm.org.apache.hadoop.fs.Path(index.root)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    index.insert(docs, id_col, text)
    return index.dedup(docs, id_col, text, replace)
