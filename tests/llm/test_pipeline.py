"""The stages one after another against plain versions, and the registry with and without these operators."""

import random
import subprocess
import sys
from pathlib import Path

import pytest

pytest.importorskip("flowwarden.llm")
import corpus_pipeline
from tests.llm import test_linededup, test_minhash, test_scans
from tests.llm.helpers import corpus, frame, odd, sentence

from flowwarden.llm.bpe import Automaton, Encoder
from flowwarden.llm.queries import tokenizer_path
from flowwarden.session import durable

ROOT = Path(__file__).resolve().parents[2]


def keyed(rows):
    return sorted(((r["doc_id"], r["text"]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    rng = random.Random(12)
    items = [(i, sentence(rng, rng.randint(20, 40))) for i in range(5)]
    rows = corpus(60) + odd() + [(2000 + i, sentence(rng, 60) + " " + items[i][1] + " " + sentence(rng, 60), "aa", "s1", 0) for i in range(5)]
    # Near copies on one line each: line dedup leaves them, so the stage after it has something to drop.
    long = sentence(rng, 100).split(" ")
    rows += [(3000 + i, " ".join([*long[:50], f"other{i}", *long[51:]]), "aa", "s2", 0) for i in range(3)]
    folder = str(tmp_path_factory.mktemp("sf"))
    frame(spark, rows).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, items


def test_each_stage_on_what_the_one_before_kept(spark, sf):
    folder, items = sf
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "lines", "near_copies", "leaks", "encode"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        docs = durable(stage(spark, docs, folder))
        out[name] = (before, docs.collect())
        if name != "encode":
            assert docs.columns == names
    before, after = out["language"]
    assert keyed(after) == keyed(r for r in before if any(c.isalpha() for c in r["text"] or ""))
    before, after = out["lines"]
    want = test_linededup.brute([tuple(r) for r in before])
    assert keyed(after) == sorted(((d, t) for d, _, _, t in want), key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    before, after = out["near_copies"]
    kept = {d for d, _, _, k in test_minhash.brute([tuple(r) for r in before], 5, 80) if k}
    assert {r["doc_id"] for r in after} - {None} == kept - {None}
    assert len(after) == len(before) - 2
    before, after = out["leaks"]

    def leaks(text):
        w = test_scans.plain_words(text)
        for _, item in items:
            v = test_scans.plain_words(item)
            tries = range(len(w) - len(v) + 1) if len(w) < 5000 else ()
            if any(test_scans.bag_similarity(test_scans.grams(w[i : i + len(v)]), test_scans.grams(v)) >= 0.8 for i in tries):
                return True
        return False

    assert keyed(after) == keyed(r for r in before if not leaks(r["text"])) and len(after) == len(before) - 5
    before, after = out["encode"]
    encoder = Encoder(Automaton.load(tokenizer_path()))
    assert sorted((str(r["doc_id"]), r["n_tokens"]) for r in after) == sorted((str(r["doc_id"]), len(encoder.texts([r["text"]])[0]) // 4) for r in before)


def test_texts_that_are_shorter_than_an_item_leak(spark, sf):
    folder, items = sf
    texts = test_scans.truncated(items) + [sentence(random.Random(3), 25)]
    docs = frame(spark, [(i, t, "aa", "s1", len(t)) for i, t in enumerate(texts)])
    want = [i for i, t in enumerate(texts) if all(test_scans.best_similarity(t, item) < 0.8 for _, item in items)]
    assert sorted(r["doc_id"] for r in corpus_pipeline.leaks(spark, docs, folder).collect()) == want
    assert len(want) < len(texts) - 30


def test_run_equals_the_stages(spark, sf):
    docs = spark.read.parquet(f"{sf[0]}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = durable(stage(spark, docs, sf[0]))
    assert sorted(map(str, corpus_pipeline.run(spark, sf[0]).collect())) == sorted(map(str, docs.collect()))


def test_every_operator_has_its_query():
    import __spark_entry__

    names = list(__spark_entry__.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()) == list(range(1, 14))
    assert "pipeline" in names and set(__spark_entry__.oracle_sql()) <= set(names)


def test_the_rest_stands_alone():
    code = "import sys; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; q = e.queries(); assert 'flow_hits' in q and 'op8_minhash' not in q and 'pipeline' not in q; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
