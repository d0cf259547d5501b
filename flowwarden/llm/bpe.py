"""BPE encoding and decoding by a tokenization automaton.

The automaton starts with one state, on which every byte's arc loops.  Each merge (a, b) -> c, in
order, adds a gadget: the state that a leads to is copied without the arc b, all a-arcs go to the
copy, and every state with an a-arc gets an arc c to where a, then b, led before.  All arcs of one
label always lead to one state, so a state is known by the label that led to it; its missing arcs
are the removals on its chain of copies.  A sequence of labels from the start is a path exactly if
it is what the merges make of the joined bytes, hence each prefix of a word has exactly one path.
Encoding moves along a word's bytes and keeps that path; decoding writes the labels of the arcs.

Encoding takes many distinct words at once: from each byte, labels are read along a byte table, and
a label's arc settles the state at its end.  The compiled tables follow the vocabulary's size and
are broadcast; a worker keeps what it has encoded, within a bound, and starts anew when it is full.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from struct import pack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from flowwarden.llm.text import fresh, ship, shipped, slices, utf8

#: What a worker keeps of encoded words, in bytes with the cost of the entries; a fuller table starts anew.
TABLE_BYTES = 32 << 20
ENTRY_BYTES = 200
ARC_BITS = 19
ARC_TABLE = 1 << ARC_BITS
#: Texts encoded at once; the work arrays take about 30 bytes for each byte of words that are not known yet.
TEXT_BYTES = 1 << 19
#: Words of the byte-level kind, as the public vocabularies split texts.
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


@dataclass
class Automaton:
    """Compiled merges.

    `ids`: label bytes to id.  `removed[s]`: arcs that the state after label s lost, each with the
    merge that removed it; `copied[s]`: the state it was copied from and the merge that did it.
    `made[t]`: first part and merge of label t (a byte has none).
    """

    ids: dict[bytes, int]
    labels: list[bytes]
    removed: dict[int, dict[int, int]]
    copied: dict[int, tuple[int, int]]
    made: dict[int, tuple[int, int]]
    special: dict[str, int]

    @staticmethod
    def compile(merges: list[tuple[bytes, bytes]], ids: dict[bytes, int], special: dict[str, int]) -> Automaton:
        removed: dict[int, dict[int, int]] = {}
        copied: dict[int, tuple[int, int]] = {}
        made: dict[int, tuple[int, int]] = {}
        for step, (left, right) in enumerate(merges):
            a, b, c = ids[left], ids[right], ids[left + right]
            alive = all(len(part) == 1 or ids[part] in made for part in (left, right))
            if not alive or c in made or not _open(a, b, removed, copied, made):
                continue  # made before, or no path has a before b: the gadget would change nothing
            copied[c] = (b, step)
            made[c] = (a, step)
            removed.setdefault(a, {})[b] = step
        size = max([*ids.values(), *special.values(), -1]) + 1
        labels = [b""] * size
        for label, i in ids.items():
            labels[i] = label
        for text, i in special.items():
            labels[i] = text.encode()
        return Automaton(ids, labels, removed, copied, made, special)

    @staticmethod
    def load(path: str) -> Automaton:
        """From a byte-level tokenizer file, read on the driver."""
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        kind = (spec.get("pre_tokenizer") or {}).get("type")
        if spec["model"]["type"] != "BPE" or kind != "ByteLevel":
            raise ValueError("a byte-level BPE file is needed")
        letters = byte_letters()
        raw = lambda s: bytes(letters[c] for c in s)
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ids = {raw(s): i for s, i in spec["model"]["vocab"].items() if s not in special}
        return Automaton.compile([(raw(a), raw(b)) for a, b in pairs], ids, special)


def _open(state: int, label: int, removed: dict, copied: dict, made: dict) -> bool:
    """Does the state after `state` have an arc `label`?

    The arc of a merged label came with its merge to the states that then had the arc of its first
    part; so the first part's arc must not have been removed up to that merge.  A copy has what its
    model had lost before it was copied.
    """
    lost = []
    until = None
    while True:  # the chain of copies, with the merge up to which each counts
        own = removed.get(state)
        if own:
            lost.append((own, until))
        up = copied.get(state)
        if up is None:
            break
        state, step = up
        until = step if until is None else min(until, step)
    if not lost:
        return True
    at = None
    while True:  # the label, its first part, that one's first part, ...
        for own, until in lost:
            step = own.get(label)
            if step is not None and (until is None or step < until) and (at is None or step <= at):
                return False
        up = made.get(label)
        if up is None:
            return True
        label, at = up


class Encoder:
    """Table-driven encoding of words and texts with one automaton; ids are packed in 4 bytes each."""

    def __init__(self, automaton: Automaton, pattern: str = WORD_PATTERN, limit: int = TABLE_BYTES):
        import regex

        self.automaton = automaton
        self.split = regex.compile(pattern).findall
        names = sorted(automaton.special, key=len, reverse=True)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, names)) + ")") if names else None
        self.limit = limit
        self.table: dict[str, bytes] = {}
        self.held = 0
        self._spell()
        self._forget_arcs()

    def _spell(self) -> None:
        """Labels by their bytes: `arc[i]` is node * 256 + byte, sorted, `onto[i]` the next node, `ends[node]` the label there or -1.

        A dense table would take a kilobyte a node; the sorted arcs of a vocabulary fit a processor's cache.
        """
        made = self.automaton.made
        ids = {label: i for label, i in self.automaton.ids.items() if len(label) == 1 or i in made}
        rows: dict[bytes, int] = {b"": 0}
        for label in ids:
            for cut in range(1, len(label)):
                rows.setdefault(label[:cut], len(rows))
        inner = len(rows)
        ends = [ids.get(prefix, -1) for prefix in rows]
        arcs = {rows[prefix[:-1]] * 256 + prefix[-1]: node for prefix, node in rows.items() if prefix}
        for label, i in ids.items():
            if label not in rows:
                arcs[rows[label[:-1]] * 256 + label[-1]] = len(ends)
                ends.append(i)
        self.arc, self.onto = np.array(sorted(arcs.items()), np.int32).reshape(-1, 2).T.copy()
        self.first = np.full(256, -1, np.int32)  # the arcs of the empty prefix
        self.first[self.arc[self.arc < 256]] = self.onto[self.arc < 256]
        self.ends, self.inner = np.array(ends, np.int32), inner
        self.length = np.array([len(label) for label in self.automaton.labels], np.int64)

    def _step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """Next nodes, -1 where there is none."""
        wanted = (node << 8 | byte).astype(np.int32)
        at = np.minimum(np.searchsorted(self.arc, wanted), len(self.arc) - 1)
        return np.where(self.arc[at] == wanted, self.onto[at], -1)

    def _forget_arcs(self) -> None:
        self.arc_key = np.full(ARC_TABLE, -1, np.int64)
        self.arc_open = np.zeros(ARC_TABLE, bool)
        self.arcs = 0

    def _arcs(self, before: np.ndarray, label: np.ndarray) -> np.ndarray:
        """Which states have which arc; asked once for each pair, then looked up."""
        key = before.astype(np.int64) << 32 | label
        out = np.zeros(len(key), bool)
        left = np.arange(len(key))
        at = ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - ARC_BITS)).astype(np.int64)
        unknown = []
        while len(left):
            have = self.arc_key[at]
            hit = have == key[left]
            out[left[hit]] = self.arc_open[at[hit]]
            unknown.append(left[have < 0])
            on = ~hit & (have >= 0)
            left, at = left[on], (at[on] + 1) & (ARC_TABLE - 1)
        new = np.concatenate(unknown) if unknown else left
        if len(new):
            auto = self.automaton
            pairs, back = np.unique(key[new], return_inverse=True)
            found = [_open(k >> 32, k & 0xFFFFFFFF, auto.removed, auto.copied, auto.made) for k in pairs.tolist()]
            out[new] = np.array(found, bool)[back]
            if self.arcs + len(pairs) > ARC_TABLE // 2:
                self._forget_arcs()
            if len(pairs) <= ARC_TABLE // 2:
                for k, ok in zip(pairs.tolist(), found, strict=True):
                    at = (k * 0x9E3779B97F4A7C15 & (1 << 64) - 1) >> 64 - ARC_BITS
                    while self.arc_key[at] >= 0:
                        at = (at + 1) & (ARC_TABLE - 1)
                    self.arc_key[at], self.arc_open[at] = k, ok
                self.arcs += len(pairs)
        return out

    def words(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of each word: the one path whose labels join to it."""
        if not words:
            return []
        order = sorted(range(len(words)), key=lambda i: -len(words[i]))
        n = np.array([len(words[i]) for i in order], np.int64)
        base = np.concatenate([[0], np.cumsum(n + 1)[:-1]])
        data = np.frombuffer(b"\0".join([words[i] for i in order]) + b"\0", np.uint8).astype(np.int64)
        last = np.full(len(data), -1, np.int32)  # the label that leads to the state at each byte
        for start in range(int(n[0])):
            active = int(np.searchsorted(-n, -start, "left"))  # words longer than start
            at = base[:active] + start
            end = base[:active] + n[:active]
            before = last[at]
            node = None
            while len(at):
                node = self.first[data[at]] if node is None else self._step(node, data[at])
                at = at + 1
                label = np.where(node >= 0, self.ends[node], -1)
                ask = np.flatnonzero((label >= 0) & (last[at] < 0))
                if len(ask):
                    ok = slice(None) if start == 0 else self._arcs(before[ask], label[ask])  # the start has all arcs
                    good = ask[ok]
                    last[at[good]] = label[good]
                on = (node >= 0) & (node < self.inner) & (at < end)
                at, end, before, node = at[on], end[on], before[on], node[on].astype(np.int64)
        if (last[base + n] < 0).any():
            raise ValueError("a byte of a word has no label")
        # Back from each word's end along the labels, all words at once.
        on_path = np.zeros(len(data), bool)
        at = base + n
        while len(at):
            on_path[at] = True
            at = at - self.length[last[at]]
            at = at[last[at] >= 0]
        ids = last[on_path].astype("<u4").tobytes()
        count = np.add.reduceat(on_path, base, dtype=np.int64)
        cut = np.concatenate([[0], np.cumsum(count)]) * 4
        out: list[bytes] = [b""] * len(words)
        for i, a, b in zip(order, cut[:-1].tolist(), cut[1:].tolist(), strict=True):
            out[i] = ids[a:b]
        return out

    def learn(self, words: set[str]) -> None:
        """Encodes the words that are not in the table yet; a table that is full before that starts anew."""
        if self.held > self.limit:
            self.table, self.held = {}, 0
        new = list(words - self.table.keys())
        packed = self.words([w.encode() for w in new])
        self.table.update(zip(new, packed, strict=True))
        self.held += ENTRY_BYTES * len(new) + sum(map(len, new)) + sum(map(len, packed))

    def texts(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; special tokens in a text get their own id."""
        special = self.automaton.special
        parts: list[list] = []
        for text in texts:
            if self.marks is None or not self.marks.search(text):
                parts.append([self.split(text)])
            else:
                cut = self.marks.split(text)
                parts.append([pack("<I", special[p]) if i % 2 else self.split(p) for i, p in enumerate(cut)])
        self.learn(set().union(*[part for text in parts for part in text if type(part) is list]))
        get = self.table.__getitem__
        return [b"".join(p if type(p) is bytes else b"".join(map(get, p)) for p in text) for text in parts]

    def decode(self, ids: bytes) -> bytes:
        """The joined labels of the arcs; bytes that are no UTF-8 are replaced by the reader."""
        return b"".join(map(self.automaton.labels.__getitem__, memoryview(ids).cast("I").tolist()))


def _encoded(encoder: Encoder, column: pa.Array) -> Iterator[bytes]:
    _, offsets = utf8(column)
    for a, b in slices(offsets, TEXT_BYTES):
        yield from encoder.texts([t or "" for t in column.slice(a, b - a).to_pylist()])


def encode_decode(docs: DataFrame, automaton: Automaton, text: str = "text", keep_text: bool = False) -> DataFrame:
    """Adds `n_tokens`, `ids_sha256`, `decoded_sha256`, and with `keep_text` also `ids` and `decoded`.

    A null text is an empty one: no tokens, and the digests of nothing.  Repeated rows stay, an
    empty table gives an empty one.  Added columns whose name is taken get an underscore.  A text
    is held whole in its task, its ids beside it.
    """
    sent = ship(docs.sparkSession, automaton)
    added = [("n_tokens", T.LongType()), ("ids_sha256", T.StringType()), ("decoded_sha256", T.StringType())]
    if keep_text:
        added += [("ids", T.ArrayType(T.LongType())), ("decoded", T.StringType())]
    names = [fresh(docs, n) for n, _ in added]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, (_, t) in zip(names, added, strict=True)]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shipped(sent, Encoder)
        for batch in batches:
            counts, digests, texts, lists, decoded = [], [], [], [], []
            for ids in _encoded(encoder, batch.column(batch.schema.get_field_index(text))):
                back = encoder.decode(ids).decode("utf-8", "replace")
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                texts.append(hashlib.sha256(back.encode()).hexdigest())
                if keep_text:
                    lists.append(memoryview(ids).cast("I").tolist())
                    decoded.append(back)
            columns = [pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(texts, pa.string())]
            if keep_text:
                columns += [pa.array(lists, pa.list_(pa.int64())), pa.array(decoded, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*batch.schema.names, *names])

    return docs.mapInArrow(run, schema)
