"""Small documents with the cases that every operator must take, and plain versions of the rules."""

import random
import re

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)
VOWELS = {"aa": "aeo", "bb": "iuy"}


def sentence(rng, n, lang="aa"):
    syllables = [c + v for c in "bdklmnrst" for v in VOWELS[lang]]
    return " ".join("".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n))


def corpus(n=60, seed=1):
    """(doc_id, text, lang, source): prose in two languages, with exact copies, near copies and repeated lines."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = "aa" if i % 3 else "bb"
        text = "\n".join(sentence(rng, rng.randint(20, 40), lang) for _ in range(rng.randint(3, 6)))
        if i % 7 == 3 and rows:
            text, lang = rows[rng.randrange(len(rows))][1:3]
        elif i % 7 == 5 and rows:
            old, lang = rows[rng.randrange(len(rows))][1:3]
            words = old.split(" ")
            words[rng.randrange(len(words))] = "changed"
            text = " ".join(words)
        elif i % 5 == 0:
            text = "A line that many documents hold.\n" + text
        rows.append((i, text, lang, "hot" if i % 3 == 0 else f"s{i % 4}", len(text)))
    return rows


def odd(first=1000):
    """Nulls in each column, empty, blank and long texts, ties and repeated rows."""
    rng = random.Random(9)
    long = sentence(rng, 30_000)
    same = sentence(rng, 80)
    return [
        (first, None, "aa", "hot", 0),
        (first + 1, "", None, None, 0),
        (first + 2, " \n\t ", "aa", "hot", 4),
        (first + 3, long, "aa", "hot", len(long)),
        (first + 4, same, "aa", None, len(same)),
        (first + 4, same, "aa", None, len(same)),
        (None, same + " more", None, "hot", None),
        (None, None, None, None, None),
        (first + 5, "éß 日本 123 \U0001f600 x", "bb", "hot", None),
        (first + 6, "one", "bb", "s1", 3),
        (first + 7, "12 34 !!", "bb", "s1", 8),
    ]


def frame(spark, rows):
    return spark.createDataFrame(rows, DOCS)


def words(text, lower=True):
    text = text or ""
    if lower:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def shingles(text, k):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def spark_rows(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
