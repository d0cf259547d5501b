import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from flowwarden.llm import merkle as M
from flowwarden.llm.queries import LOWER, MANIFEST_FIELDS, UPPER
from tests.llm.helpers import corpus, frame, odd


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels(nodes, arity):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + arity]) for i in range(0, len(out[-1]), arity)])
    return out


def lowered(text):
    return None if text is None else "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain(rows, arity):
    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append(r)
    for g in groups.values():
        g.sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: levels([leaf(r) for r in groups[s]], arity) for s in names}
    top = levels([trees[s][-1][0] for s in names], arity)
    out = []
    for place, s in enumerate(names):
        for i, r in enumerate(groups[s]):
            steps = []
            for tree, at in ((trees[s], i), (top, place)):
                for level in tree[:-1]:
                    start = at - at % arity
                    run = level[start : start + arity]
                    steps.append((run[: at - start], run[at - start + 1 :]))
                    at //= arity
            bent = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0
            now = leaf((r[0], lowered(r[1]), *r[2:])) if bent else leaf(r)
            for left, right in steps:
                now = h(*left, now, *right)
            proof = h(*[x for left, right in steps for x in left + right])
            out.append((r[0], leaf(r), trees[s][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return sorted(out, key=repr)


def audited(df, arity):
    fifth = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return M.audit(df, MANIFEST_FIELDS, {"text": F.translate("text", UPPER, LOWER)}, fifth, arity=arity)


@pytest.mark.parametrize("arity", [16, 2, 3])
def test_manifest_equals_a_plain_tree(spark, arity):
    # 130 documents of a hot source, some of few rows, a source of one, null sources, repeated rows and null ids.
    rows = [*corpus(130), *odd(), (5000, "A lone Text", "aa", "only", 11), *[(i, f"Hot {i}", "bb", "hot", 6) for i in range(6000, 6070)]]
    got = sorted((tuple(r) for r in audited(frame(spark, rows), arity).collect()), key=repr)
    assert got == plain(rows, arity)
    assert 0 < sum(not r[-1] for r in got) < len(got) / 3


@pytest.mark.parametrize("count", [1, 2, 16, 17, 33, 257])
def test_sizes_around_a_full_run(spark, count):
    rows = [(i, f"Text {i}", "aa", "s", 6) for i in range(count)]
    assert sorted((tuple(r) for r in audited(frame(spark, rows), 16).collect()), key=repr) == plain(rows, 16)


def test_no_rows_and_other_columns(spark):
    assert audited(frame(spark, []), 16).count() == 0
    df = frame(spark, corpus(20))
    more = df.withColumn("leaf", F.lit("x")).withColumn("tree", F.lit(1)).withColumn("path", F.lit(2)).withColumn("index", F.lit(3)).withColumn("digest", F.lit(4))
    assert sorted(audited(more, 16).collect(), key=repr) == sorted(audited(df, 16).collect(), key=repr)


def test_a_very_long_text(spark):
    rows = [(1, "Aé日" * 1_000_000, "aa", "s", 3_000_000), (2, "", "aa", "s", 0), (3, None, None, None, None)]
    assert sorted((tuple(r) for r in audited(frame(spark, rows), 16).collect()), key=repr) == plain(rows, 16)


def test_arity(spark):
    with pytest.raises(ValueError, match="arity"):
        audited(frame(spark, corpus(3)), 1)
