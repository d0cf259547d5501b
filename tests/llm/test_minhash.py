import random

import pytest

pytest.importorskip("flowwarden.llm")
from tests.llm.helpers import corpus, frame, odd, sentence, shingles

from flowwarden.llm.components import components
from flowwarden.llm.minhash import band_rows, drop_near_duplicates, near_duplicates


def brute(rows, k, percent):
    """Smallest id reachable from each distinct text's set; ids of one text are linked."""
    sets = [(r[0], shingles(r[1], k)) for r in rows]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j, (_, b) in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    out = []
    for i, (d, s) in enumerate(sets):
        component = low.get(find(i)) if s else d
        out.append((d, len(s), component, d == component))
    return sorted(out, key=repr)


@pytest.mark.parametrize("k, percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, k, percent):
    rng = random.Random(4)
    rows = corpus(70) + odd()
    # A large group of near copies, a chain of drifting copies, and texts that share one passage.
    base = sentence(rng, 150).split(" ")
    for i in range(40):
        text = list(base)
        for _ in range(rng.randint(0, 6)):
            text[rng.randrange(len(text))] = f"w{rng.randint(0, 9)}"
        rows.append((2000 + i, " ".join(text), "aa", "hot", 0))
    drift = list(base[::-1])
    for i in range(20):
        drift[(i * 7) % len(drift)] = f"d{i}"
        rows.append((3000 - i, " ".join(drift), "aa", "hot", 0))
    passage = sentence(rng, 60)
    rows += [(4000 + i, passage + " " + sentence(rng, rng.randint(1, 25)), "bb", "hot", 0) for i in range(30)]
    got = near_duplicates(frame(spark, rows).withColumnRenamed("source", "nid"), k=k, percent=percent)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, k, percent)


def test_kept_rows_keep_their_columns(spark):
    rows = corpus(30) + odd()
    docs = frame(spark, rows).withColumnRenamed("n_chars", "gone")
    kept = drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {d for d, _, _, k in brute(rows, 5, 80) if k}
    assert {r["doc_id"] for r in kept.collect()} - {None} == want - {None}


def test_empty(spark):
    assert near_duplicates(frame(spark, [])).count() == 0


def test_bands_leave_few_out():
    for percent in (50, 80, 85, 95):
        rows = band_rows(percent)
        assert (1 - (percent / 100) ** rows) ** (128 // rows) <= 1e-6 or rows == 1


def test_components(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 80)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a bigint, b bigint"), "a", "b").collect()}
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    assert got == {x: find(x) for a, b in links if a != b for x in (a, b)}
