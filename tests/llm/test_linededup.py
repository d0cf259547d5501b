import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("flowwarden.llm")
from tests.llm.helpers import corpus, frame, odd

from flowwarden.llm import linededup
from flowwarden.llm.linededup import Cuckoo, LineIndex, dedup_lines


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))


def brute(rows):
    held = {}
    for d, text, *_ in rows:
        for line in (text or "").split("\n"):
            if d is not None and len(key(line)) >= 10:
                held.setdefault(key(line), set()).add(d)
    out = []
    for d, text, *_ in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if d is None or len(held.get(key(x), ())) < 2 or d == min(held[key(x)])]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def rows_of(df, names=("n_lines", "n_dropped", "kept_text")):
    return sorted((tuple(r[c] for c in ("doc_id", *names)) for r in df.collect()), key=repr)


LINES = [(i, f"  THE same Line {i % 3} of all\nÉtude {i % 2} là-bas\nshort\n\nown line number {i}\nthe same line {i % 3} of all", "aa", "hot", 0) for i in range(12)]


def test_equals_brute_force(spark):
    rows = LINES + [(d and d + 50, *r) for d, *r in corpus(40)] + odd()
    assert rows_of(dedup_lines(frame(spark, rows))) == brute(rows)


def test_beyond_the_filter_bound_and_with_clashing_names(spark, monkeypatch):
    monkeypatch.setattr(linededup, "FILTER_BYTES", 0)
    rows = LINES + odd()
    docs = frame(spark, rows).withColumnRenamed("lang", "N_Lines").withColumnRenamed("source", "line_keys")
    out = dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines_", "n_dropped", "kept_text"]
    assert rows_of(out, ("n_lines_", "n_dropped", "kept_text")) == brute(rows)
    assert dedup_lines(frame(spark, [])).count() == 0
    replaced = dedup_lines(docs, replace=True)
    assert replaced.columns == docs.columns
    assert sorted((r["doc_id"], r["text"]) for r in replaced.filter("doc_id is not null").collect()) == sorted(
        (d, t) for d, _, _, t in brute(rows) if d is not None
    )


def test_insertions_and_deletions_are_exact_and_reversible(spark):
    first, second = LINES[:7], LINES[7:] + [(99, "the same line 1 of all\nanother long line", "aa", "hot", 0)]
    index = LineIndex(spark)
    index.insert(frame(spark, first))
    before = sorted(map(tuple, index.shared().collect()))
    index.insert(frame(spark, second))
    assert rows_of(index.dedup(frame(spark, first + second))) == brute(first + second)
    index.delete(frame(spark, first[:3]))
    assert rows_of(index.dedup(frame(spark, first[3:] + second))) == brute(first[3:] + second)
    index.insert(frame(spark, first[:3]))
    index.delete(frame(spark, second))
    assert sorted(map(tuple, index.shared().collect())) == before
    assert rows_of(index.dedup(frame(spark, first))) == brute(first)
    filters = [Cuckoo.unpack(bytes(r["bits"])) for r in index.filters().collect()]
    assert sum(int((f.slots > 0).sum()) + len(f.rest) for f in filters) == len(before)


def test_cuckoo_filter():
    rng = np.random.default_rng(1)
    keys = rng.integers(-(1 << 62), 1 << 62, (5000, 2))
    found = Cuckoo(1000)  # far too small: what has no place is kept exactly
    found.insert(keys[:, 0].copy(), keys[:, 1].copy())
    found = Cuckoo.unpack(found.pack())
    assert found.may_have(keys[:, 0].copy(), keys[:, 1].copy()).all()
    found.delete(keys[:4000, 0].copy(), keys[:4000, 1].copy())
    assert found.may_have(keys[4000:, 0].copy(), keys[4000:, 1].copy()).all()
    other = rng.integers(-(1 << 62), 1 << 62, (20000, 2))
    assert found.may_have(other[:, 0].copy(), other[:, 1].copy()).mean() < 0.01


def test_line_key():
    assert linededup.line_key(b" \x0b Short\t") is None
    assert linededup.line_key("ééééééééé".encode()) is None
    assert linededup.line_key("éééééééééé".encode()) == hashlib.blake2b("éééééééééé".encode(), digest_size=16).digest()
    random.seed(0)
