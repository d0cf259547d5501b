"""Language ID and the neighbour classifier: held-out accuracy, plain versions of their parts, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("flowwarden.llm")
from tests.llm.helpers import corpus, frame, odd, sentence

from flowwarden.llm import knn_quality, langid
from flowwarden.llm.text import gram_counts, held_out


def aside(i):
    return i is not None and zlib.crc32(str(i).encode()) % 4 == 2


def test_held_out(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(200), -5, None]], "doc_id bigint")
    assert all(r["h"] == aside(r["doc_id"]) for r in ids.select("doc_id", held_out(F.col("doc_id")).alias("h")).collect())


def test_gram_counts_of_pieces_equal_the_whole(monkeypatch):
    data = np.frombuffer(sentence(random.Random(1), 500).encode(), np.uint8)
    whole = gram_counts(data, (1, 2, 4), 8)
    assert whole.sum() == 3 * len(data) - 4
    monkeypatch.setattr("flowwarden.llm.text.PIECE_BYTES", 37)
    assert (gram_counts(data, (1, 2, 4), 8) == whole).all()
    assert gram_counts(data[:0], (2,), 8).sum() == 0


def test_language_on_held_out_rows(spark):
    rows = corpus(120)
    docs = frame(spark, rows + odd())
    model = langid.train(docs)
    assert model.languages == ["aa", "bb"]
    out = langid.identify(docs.withColumnRenamed("source", "Score"), model)
    assert out.columns == ["doc_id", "text", "lang", "Score", "n_chars", "lang_pred", "score_", "accepted"]
    got = out.collect()
    assert len(got) == len(rows) + len(odd())
    seen = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 120 and aside(r["doc_id"])]
    assert len(seen) > 15 and all(r["lang_pred"] == r["lang"] and r["accepted"] for r in seen)
    for r in got:
        letters = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred"] == "und") == (not letters)
        assert 0 <= r["score_"] <= 1 and (letters or not r["accepted"])
    assert langid.identify(frame(spark, []), model).count() == 0


def test_language_without_training_rows(spark):
    model = langid.train(frame(spark, [(1, "text", None, None, 4), (2, None, "aa", None, 0)]))
    assert [tuple(r)[-3:] for r in langid.identify(frame(spark, [(1, "text", None, None, 4)]), model).collect()] == [("und", 0.0, False)]


def test_model_never_sees_held_out_rows(spark):
    rows = corpus(60)
    other = [(d, "zzzz zz" if aside(d) else t, "zz" if aside(d) else lang, s, n) for d, t, lang, s, n in rows]
    other = [r for r in other if not aside(r[0])] + [(d, t, "aa", s, n) for d, t, lang, s, n in other if aside(d)]
    a = langid.train(frame(spark, [r for r in rows if not aside(r[0])]))
    b = langid.train(frame(spark, other))
    assert a.languages == b.languages and np.allclose(a.logits, b.logits)


def quality_rows(n=300):
    rng = random.Random(6)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = sentence(rng, rng.randint(30, 80))
        if not good:
            text = " ".join(w + "###" for w in text.split(" ")) if i % 8 else " ".join(["Lorem"] * 60)
        docs.append((i, text, "aa", "s", len(text)))
        labels.append((i, int(good), 0))
    return docs, labels


LABELS = "doc_id bigint, quality int, toxic int"


def test_quality_on_held_out_rows(spark):
    docs, labels = quality_rows()
    extra = [(5, 1, 0), (None, 1, 0), (7, None, 0), (9999, 1, 1)]
    model = knn_quality.train(frame(spark, docs), spark.createDataFrame(labels + extra, LABELS))
    out = knn_quality.score(frame(spark, docs + odd()).withColumnRenamed("lang", "SCORE"), model)
    assert out.columns[-1] == "score_" and out.count() == len(docs) + len(odd())
    good = {d: q for d, q, _ in labels}
    got = [r for r in out.collect() if r["doc_id"] in good and aside(r["doc_id"])]
    assert sum((r["score_"] >= 0.7) == good[r["doc_id"]] for r in got) >= 0.95 * len(got)
    odd_rows = [r for r in out.collect() if r["doc_id"] not in good]
    assert all(0 <= r["score_"] <= 1 for r in odd_rows) and all(r["score_"] == 0 for r in odd_rows if not r["text"])
    assert knn_quality.score(frame(spark, []), model).count() == 0


def test_votes_equal_a_plain_search():
    rng = np.random.default_rng(2)
    counts = rng.integers(0, 4, (80, 1 << knn_quality.BITS)) * (rng.random((80, 1 << knn_quality.BITS)) < 0.02)
    labels = rng.integers(0, 2, 80).astype(float)
    model = knn_quality.fit(counts, np.ones(1 << knn_quality.BITS), labels)
    got = model.scores(counts[:20] + counts[1:21])
    for row, value in zip(model.vector(counts[:20] + counts[1:21]), got, strict=True):
        like = [(float(row @ v), lab) for v, lab in zip(model.vectors, labels, strict=True)]
        near = sorted(like, reverse=True)[: knn_quality.NEIGHBOURS]
        weights = [min(1, max(1e-6, s)) ** knn_quality.POWER for s, _ in near]
        assert value == pytest.approx(sum(w * lab for w, (_, lab) in zip(weights, near, strict=True)) / sum(weights), abs=1e-4)


def test_quality_without_labels(spark):
    docs = frame(spark, corpus(5))
    model = knn_quality.train(docs, spark.createDataFrame([], LABELS))
    assert {r["score"] for r in knn_quality.score(docs, model).collect()} == {0.0}


TONGUES = {"k": ("bdk", "ae"), "l": ("lmn", "iu"), "m": ("rst", "oy"), "n": ("gvz", "éà"), "o": ("pfh", "aou")}


def spoken(rng, tongue, words):
    first, second = TONGUES[tongue]
    return " ".join("".join(rng.choice(first) + rng.choice(second) for _ in range(rng.randint(1, 4))) for _ in range(words))


def tongues(names, n, seed, low=20, high=200):
    rng = random.Random(seed)
    return [(i, spoken(rng, t := names[i % len(names)], rng.randint(low, high)), t, "s", 0) for i in range(n)]


def test_texts_of_no_known_language_are_rejected(spark):
    for left_out in "kn":
        known = [t for t in TONGUES if t != left_out]
        model = langid.train(frame(spark, tongues(known, 400, 1)))
        own = langid.identify(frame(spark, tongues(known, 400, 2)), model)
        assert own.filter("not accepted").count() <= 4  # one in a hundred
        assert own.filter("lang = lang_pred").count() >= 396
        foreign = langid.identify(frame(spark, tongues([left_out], 200, 3)), model)
        assert foreign.filter("not accepted").count() >= 180
        assert foreign.filter("score > 0.5").count() <= 20


def plain_grams(text):
    """Hashed n-grams of a text, one by one."""
    data = [0x20]
    for b in text.encode():
        c = b + 32 if 0x41 <= b <= 0x5A else b
        if data[-1] == 0xC3 and 0x80 <= c <= 0x9E and c != 0x97:
            c += 0x20
        c = c if c >= 0x80 or 0x61 <= c <= 0x7A else 0x20
        if c != 0x20 or data[-1] != 0x20:
            data.append(c)
    if data[-1] != 0x20:
        data.append(0x20)
    out = []
    for n in langid.GRAMS:
        for i in range(len(data) - n + 1):
            code = data[i] * 0x9E3779B1 & 0xFFFFFFFF
            for j in range(1, n):
                code ^= ((code << 5 & 0xFFFFFFFF) + data[i + j] * (0x85EBCA6B + 2 * j)) & 0xFFFFFFFF
            out.append((code * 0xC2B2AE35 & 0xFFFFFFFF) >> (32 - langid.BITS))
    return out


def test_scores_by_hand(spark):
    rows = [*tongues("klm", 150, 5), (900, "ÀÉÎ Õ×à", "k", "s", 0), (901, "x", "k", "s", 0), (902, "12 !", "k", "s", 0)]
    model = langid.train(frame(spark, rows))
    got = {r["doc_id"]: r for r in langid.identify(frame(spark, rows), model).collect()}
    for doc_id, text, *_ in rows:
        if not any(c.isalpha() for c in text):
            assert (got[doc_id]["lang_pred"], got[doc_id]["score"], got[doc_id]["accepted"]) == ("und", 0.0, False)
            continue
        grams = plain_grams(text)
        z = [sum(float(model.logits[g, k]) for g in grams) / len(grams) + model.bias[k] for k in range(3)]
        e = [math.exp((v - max(z)) / model.temperature) for v in z]
        best = e.index(max(e))
        usual = sum(float(model.usual[g, best]) for g in grams) / len(grams)
        away = (usual - model.mean[best]) / math.sqrt(model.spread[best][0] + model.spread[best][1] / len(grams))
        sure = 1 / (1 + math.exp(-max(-60, min(60, model.curve[0] * away + model.curve[1]))))
        want = max(e) / sum(e) * sure
        assert got[doc_id]["lang_pred"] == model.languages[best]
        assert abs(got[doc_id]["score"] - want) < 1e-6 and got[doc_id]["accepted"] == (got[doc_id]["score"] >= model.reject)
