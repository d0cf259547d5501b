import hashlib
import random

import numpy as np
import pytest

pytest.importorskip("flowwarden.llm")
from tests.llm.helpers import corpus, frame, odd

from flowwarden.llm.bpe import Automaton, Encoder, encode_decode
from flowwarden.llm.queries import tokenizer_path

ALPHABET = [
    "a", "e", "th", "\n", " ", "  ", "\t", "é", "ß", "日本", "😀", "\x1c", "\x85", " ", "　", "1", "23", "½", "²",
    "'s", "'ll", "'S", "!!", "###", "<|endoftext|>", "<|endof", "́", "\x00", "AB", "aaaa", "--------", "....", "\r\n",
]


@pytest.fixture(scope="module")
def automaton():
    return Automaton.load(tokenizer_path())


@pytest.fixture(scope="module")
def library():
    return pytest.importorskip("tokenizers").Tokenizer.from_file(tokenizer_path())


def test_equals_the_library(automaton, library):
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["".join(chr(rng.choice([rng.randint(32, 127), rng.randint(0, 0x24FF)])) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    encoder = Encoder(automaton, limit=500)
    for at in range(0, len(texts), 100):
        part = texts[at : at + 100]
        for text, ids in zip(part, encoder.texts(part), strict=True):
            want = library.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, np.uint32).tolist() == want
            assert encoder.decode(ids).decode("utf-8", "replace") == library.decode(want, skip_special_tokens=False)


def merged(word, ranks):
    parts = [bytes([b]) for b in word]
    while True:
        pairs = [(ranks[p], i) for i, p in enumerate(zip(parts, parts[1:], strict=False)) if p in ranks]
        if not pairs:
            return parts
        i = min(pairs)[1]
        parts[i : i + 2] = [parts[i] + parts[i + 1]]


def test_small_automata_equal_plain_merging():
    rng = random.Random(3)
    for _ in range(60):
        labels, merges = [b"a", b"b", b"c"], []
        while len(merges) < 12:
            pair = rng.choice(labels), rng.choice(labels)
            if pair[0] + pair[1] not in labels:
                merges.append(pair)
                labels.append(pair[0] + pair[1])
        ids = {label: i for i, label in enumerate(labels)}
        encoder = Encoder(Automaton.compile(merges, ids, {}))
        ranks = {p: i for i, p in enumerate(merges)}
        tests = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))) for _ in range(80)]
        for word, got in zip(tests, encoder.words([w.encode() for w in tests]), strict=True):
            assert np.frombuffer(got, np.uint32).tolist() == [ids[p] for p in merged(word.encode(), ranks)]


def test_frames(spark, automaton, library):
    rows = corpus(20) + odd()
    out = encode_decode(frame(spark, rows).selectExpr("*", "1 as N_TOKENS"), automaton, keep_text=True)
    got = out.collect()
    assert len(got) == len(rows) and "n_tokens_" in out.columns
    for r in got:
        want = library.encode(r["text"] or "", add_special_tokens=False).ids
        assert r["n_tokens_"] == len(want) and r["ids"] == want and r["decoded"] == (r["text"] or "")
        assert r["ids_sha256"] == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest()
    assert encode_decode(frame(spark, []), automaton).count() == 0
