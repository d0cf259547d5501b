import hashlib
import random
import re

import pytest
import xxhash
from pyspark.sql import functions as F

from flowwarden.llm import order_minhash as O
from tests.llm.helpers import corpus, frame, odd, sentence

MASK = (1 << 64) - 1
KIND = re.compile("[^\t\n\x0b\x0c\r ⺀-\U0010ffff]+|[⺀-\U0010ffff]")


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def joined(data, seed):
    return xxhash.xxh64(data, seed=seed & MASK).intdigest()


def brute(text, k=O.K, l=O.L, m=O.M):  # noqa: E741
    """The signature by its definition: number k-mers, go round the circle, order by place, hash."""
    words = KIND.findall(text or "")
    kmers = []
    for i in range(max(len(words) - k + 1, min(len(words), 1))):
        value = 42
        for w in words[i : i + k]:
            value = joined(w.encode(), value)
        kmers.append(value & ((1 << O.HASH_BITS) - 1))
    seen, circle = {}, []
    for place, kmer in enumerate(kmers):
        number = seen[kmer] = seen.get(kmer, -1) + 1
        value = kmer
        if number:
            value = joined(kmer.to_bytes(8, "little"), 42)
            value = joined(number.to_bytes(4, "little"), value) & ((1 << O.HASH_BITS) - 1)
        circle.append((signed(value << O.PLACE_BITS), place))
    circle.sort()
    out = []
    for b in range(m):
        point = (b << 64) // m - (1 << 63)
        at = sum(v + p < point for v, p in circle)
        chosen = sorted((circle[(at + j) % len(circle)] for j in range(min(l, len(circle)))), key=lambda e: e[1]) if circle else []
        label = b
        for value, _ in chosen:
            label = joined(((value & MASK) >> O.PLACE_BITS).to_bytes(8, "little"), joined(label.to_bytes(8, "little"), 42))
        out.append(label >> 32)
    return out if circle else []


def near(a, b):
    return 1.0 if not a and not b else sum(x == y for x, y in zip(a, b)) / max(len(a), len(b))


def plain(rows):
    """(doc_id, n_chars, edited, signatures, likeness) in falling order of the ids."""
    rows = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    out = []
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = brute(text), brute(edited), brute(after)
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c)))
    return sorted(out, key=repr)


def found(df):
    cols = ("doc_id", "n_chars", "edited", "signature", "edited_signature", "near_edited", "near_next")
    digest = F.sha2(F.col("edited").cast("binary"), 256).alias("edited")
    return sorted((tuple(r) for r in O.edits(df).withColumn("edited", digest).select(*cols).collect()), key=repr)


def test_edits_equal_the_definition(spark):
    rng = random.Random(2)
    rows = [*corpus(40), *[r for r in odd() if r[0] != 1003], (7000, "日本語の 文章 と words " * 5, "aa", "s", 1), (7001, "same same same " * 30, "aa", "s", 1)]
    rng.shuffle(rows)
    assert found(frame(spark, rows)) == plain([r[:2] for r in rows])


def test_short_runs_give_the_same(spark, monkeypatch):
    rows = [(i * 7919 % 10007 - 3000, sentence(random.Random(i), 1 + i % 9), "aa", "s", 0) for i in range(60)]
    want = plain([r[:2] for r in rows])
    for size in (1, 7, 1000):
        dealt = O.in_runs(frame(spark, rows).select("doc_id", "text"), "doc_id", "run", "extra", rows=size)
        assert dealt.filter("not extra").count() == 60
        assert dealt.select("run").distinct().count() == dealt.filter("extra").count()
        monkeypatch.setattr(O.in_runs, "__defaults__", (size, O.RUNS))
        assert found(frame(spark, rows)) == want


@pytest.mark.parametrize("rows", [[], [(5, "only one text here")], [(None, "no id"), (None, None)], [(1 << 62, "a b c"), ((1 << 62) - 1, "a b d"), (-(1 << 62), "")]])
def test_few_rows(spark, rows):
    df = frame(spark, [(*r, "aa", "s", 0) for r in rows])
    assert found(df) == plain(rows)


def test_names_and_repeats(spark):
    df = frame(spark, corpus(6)).select("doc_id", "text")
    more = df.withColumn("_words", F.lit("x")).withColumn("_circle", F.lit(1)).withColumn("signature", F.lit(2))
    assert found(more.withColumn("run", F.lit(1)).withColumn("extra", F.lit(True))) == found(df)
    out = O.signatures(more)
    assert out.columns == ["doc_id", "text", "_words", "_circle", "signature"] and out.first()["_words"] == "x"
    twice = O.signatures(df.union(df))
    assert twice.count() == 12 and twice.distinct().count() == 6


def test_a_very_long_text(spark):
    text = " ".join(["again and again"] * 30_000 + [f"w{i}" for i in range(150_000)])
    got = O.signatures(frame(spark, [(1, text, "aa", "s", 0)])).first()["signature"]
    assert got == brute(text)


def test_order_and_edits_are_felt(spark):
    rng = random.Random(8)
    words = sentence(rng, 400).split(" ")
    swapped = words[200:] + words[:200]
    backwards = words[::-1]
    changed = [w if i % 40 else "other" for i, w in enumerate(words)]
    rows = [(i, " ".join(w), "aa", "s", 0) for i, w in enumerate((words, changed, swapped, backwards, sentence(rng, 400).split(" ")))]
    s = {r["doc_id"]: r["signature"] for r in O.signatures(frame(spark, rows)).collect()}
    like = [near(s[0], s[i]) for i in range(5)]
    # A few words, moved halves, the whole backwards, another text.
    assert like[0] == 1.0 and like[1] > 0.75 and 0.3 < like[2] < like[1] and like[3] < 0.1 and like[4] < 0.05
    assert spark.range(1).select(O.written(F.array(F.lit(255).cast("bigint"), F.lit(1 << 31).cast("bigint")))).first()[0] == "000000ff80000000"


def test_parameters(spark):
    df = frame(spark, corpus(5))
    got = [r["signature"] for r in O.signatures(df, k=3, l=4, m=16).orderBy("doc_id").collect()]
    assert got == [brute(r[1], 3, 4, 16) for r in corpus(5)]
    for wrong in ({"m": 12}, {"m": 0}, {"k": 0}, {"l": 0}):
        with pytest.raises(ValueError):
            O.signatures(df, **wrong)
