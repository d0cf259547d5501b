"""Language of texts: averages of hashed subword embeddings under a linear softmax.

Subwords are byte n-grams of words with their edges, hashed into buckets.  Embeddings and the layer on
them are trained by stochastic gradient descent in numpy, on a bounded sample with as many rows of
each language as it has, up to an equal part.  Since all is linear up to the softmax, a trained model is
one row of logits for each bucket.

A softmax is as sure of a language that it never saw as of its own.  So a score is the product of the softmax's
probability and that of the text being in a known language at all.  The second one asks how likely the text's
subwords are in the language found, against texts of that language and of that length.  A fifth of the sample is kept
aside for calibration, its rows also cut down to few subwords at random: with them the temperature is fitted, the
mean and spread of the subwords' likelihood, and a logistic curve between rows judged by their own language
and the same rows judged by the likeliest of the other languages, as if their own were left out.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowwarden.llm.text import fresh, gram_counts, held_out, sample_share, ship, shipped, utf8

#: Bound of the sample that a model is fitted on; each row is at most its 2^BITS bucket counts.
TRAIN_ROWS = 2000
BITS = 13
GRAMS = (2, 3, 4)
WIDTH = 16
EPOCHS = 12
RATE = 1.0
#: Share of the kept-aside rows, in whose language the model was trained, that may be rejected.
FALSE_REJECTIONS = 0.001
#: Share of rows judged by other languages than their own that should be rejected.
FOREIGN_REJECTIONS = 0.95
#: The rejection score, unless more of the kept-aside rows than that are below it.
EVEN = 0.5
#: Numbers of subwords to which kept-aside rows are cut, those from which on a row counts for the curve, and the least
#: spread of the likelihood a subword.
PIECES = (16, 32, 64, 128, 256)
LONG = 64
LEAST_SPREAD = 0.02
NONE = "und"


def folded(data: np.ndarray) -> np.ndarray:
    """Lower-cased bytes (also the accented letters up to U+00DE); each run of ASCII that is no letter is one space, with one at either end."""
    table = np.full(256, 0x20, np.uint8)
    table[0x61:0x7B] = table[0x41:0x5B] = np.arange(0x61, 0x7B)
    table[0x80:] = np.arange(0x80, 0x100)
    out = np.concatenate([[0x20], table[data], [0x20]]).astype(np.uint8)
    upper = (out[:-1] == 0xC3) & (out[1:] >= 0x80) & (out[1:] <= 0x9E) & (out[1:] != 0x97)
    out[1:][upper] += 0x20
    space = out == 0x20
    return out[np.concatenate([[True], ~(space[1:] & space[:-1])])]


def has_letter(data: np.ndarray) -> bool:
    lower = data | 0x20
    if ((lower >= 0x61) & (lower <= 0x7A)).any():
        return True
    return bool((data >= 0x80).any()) and any(c.isalpha() for c in data.tobytes().decode("utf-8", "replace"))


@dataclass
class LanguageModel:
    """`logits[bucket, language]`, languages in order, temperature and rejection score.

    `usual[bucket, language]`: logarithm of a bucket's share among the subwords of a language; `mean` and `spread` (two
    numbers a language: fixed, and a subword) of its average over a text; `curve`: slope and height of the logistic curve.
    """

    languages: list[str]
    logits: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    reject: float = 0.0
    usual: np.ndarray | None = None
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    curve: tuple[float, float] = (0.0, 0.0)

    def deviation(self, average: np.ndarray | float, language: np.ndarray | int, n: np.ndarray | float) -> np.ndarray:
        """How many deviations the average likelihood of n subwords is above that of a language's texts."""
        spread = self.spread[language]
        return (average - self.mean[language]) / np.sqrt(spread[..., 0] + spread[..., 1] / np.maximum(n, 1))

    def known(self, z: np.ndarray | float) -> np.ndarray:
        slope, height = self.curve
        return 1 / (1 + np.exp(-np.clip(slope * z + height, -60, 60)))

    def scores(self, data: np.ndarray) -> np.ndarray:
        """Probability of each language, together at most that of any known one."""
        counts = gram_counts(folded(data), GRAMS, BITS)
        n = max(1, counts.sum())
        z = (counts @ self.logits / n + self.bias) / self.temperature
        e = np.exp(z - z.max())
        p = e / e.sum()
        if self.usual is None:
            return p
        best = int(p.argmax())
        return p * self.known(self.deviation(counts @ self.usual[:, best] / n, best, n))


def _features(docs: DataFrame) -> DataFrame:
    """(label, buckets, counts) of each row of (label, text), packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            buckets, counts = [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                found = gram_counts(folded(data[a:b]), GRAMS, BITS)
                at = np.flatnonzero(found)
                buckets.append(at.astype(np.uint16).tobytes())
                counts.append(found[at].astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(buckets, pa.binary()), pa.array(counts, pa.binary())], names=["label", "buckets", "counts"]
            )

    return docs.mapInArrow(run, "label string, buckets binary, counts binary")


def train(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = TRAIN_ROWS) -> LanguageModel:
    """Fits a model on the rows that are not held out, have a text and a language: about `rows` of them at most.

    Without any such row the model knows no language and answers "und".
    """
    known = docs.filter(~held_out(F.col(id_col)) & F.col(lang).isNotNull() & (F.length(text) > 0))
    sizes = {r[0]: r[1] for r in known.groupBy(lang).count().collect()}
    if not sizes:
        return LanguageModel([], np.zeros((1 << BITS, 0), np.float32), np.zeros(0))
    languages = sorted(sizes)
    part = rows / len(languages)
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, min(1.0, part / sizes[name]))])[F.col(lang)]
    sample = known.filter(sample_share(F.col(id_col).cast("string"), share)).select(F.col(lang).alias("label"), F.col(text).alias("text"))
    found = sorted(_features(sample).collect(), key=lambda r: (r["label"], r["buckets"], r["counts"]))
    if not found:
        found = sorted(_features(known.select(F.col(lang).alias("label"), F.col(text).alias("text")).limit(1)).collect())
        languages = [found[0]["label"]]
    return _fit(languages, found)


def _fit(languages: list[str], rows: list) -> LanguageModel:
    rng = np.random.default_rng(5)
    n = len(languages)
    place = {name: i for i, name in enumerate(languages)}
    data = []
    for r in rows:
        weight = np.frombuffer(r["counts"], np.float32).astype(np.float64)
        if not len(weight):
            continue  # a text without a letter has no subword
        data.append((np.frombuffer(r["buckets"], np.uint16).astype(np.int64), weight / weight.sum(), place[r["label"]], weight.sum()))
    if not data:
        return LanguageModel(languages, np.zeros((1 << BITS, n), np.float32), np.zeros(n))
    order = rng.permutation(len(data))
    aside = [data[i] for i in order[: len(data) // 5]]
    own = [data[i] for i in order[len(data) // 5 :]] or data
    vectors = rng.uniform(-1 / WIDTH, 1 / WIDTH, (1 << BITS, WIDTH))
    layer, bias = np.zeros((WIDTH, n)), np.zeros(n)
    steps = EPOCHS * len(own)
    for step in range(steps):
        if step % len(own) == 0:
            turn = rng.permutation(len(own))
        buckets, weight, label, _ = own[turn[step % len(own)]]
        mean = weight @ vectors[buckets]
        z = mean @ layer + bias
        p = np.exp(z - z.max())
        p /= p.sum()
        p[label] -= 1
        rate = RATE * (1 - step / steps)
        back = layer @ p
        layer -= rate * np.outer(mean, p)
        bias -= 0.01 * rate * p
        # An averaged embedding moves by its share of the text; scaled up by the number of buckets in it.
        vectors[buckets] -= rate * min(len(buckets), 256) * weight[:, None] * back
    model = LanguageModel(languages, (vectors @ layer).astype(np.float32), bias)
    if aside:
        _calibrate(model, own, aside, rng)
    return model


def _cut(rows: list, n: int, rng: np.random.Generator) -> list:
    """Rows with about n of their subwords, chosen at random; shorter ones stay out."""
    out = []
    for buckets, weight, label, total in rows:
        if total > n:
            count = rng.multinomial(n, weight / weight.sum())
            has = count > 0
            out.append((buckets[has], count[has] / n, label, n))
    return out


def _calibrate(model: LanguageModel, own: list, aside: list, rng: np.random.Generator) -> None:
    """Temperature, likelihood of subwords, logistic curve and rejection score from rows that trained no vector."""
    kinds = len(model.languages)
    counts = np.full((1 << BITS, kinds), 0.05)
    for buckets, weight, label, _ in own:
        counts[buckets, label] += 1000 * weight / max(1, len(own))
    model.usual = np.log(counts / counts.sum(axis=0)).astype(np.float32)
    pieces = {n: _cut(aside, n, rng) for n in PIECES}
    every = [*aside, *(row for rows in pieces.values() for row in rows)]
    label = np.array([r[2] for r in every])
    total = np.array([r[3] for r in every], float)
    z = np.array([w @ model.logits[b] + model.bias for b, w, _, _ in every])
    average = np.array([w @ model.usual[b] for b, w, _, _ in every])
    # No sharper than a twentieth of the rows being wrong would allow.
    grid = np.geomspace(0.05, 20, 60)
    model.temperature = float(min(grid, key=lambda t: _loss(z / t, label, 0.05)))
    model.mean, model.spread = np.zeros(kinds), np.full((kinds, 2), LEAST_SPREAD**2)
    for k in range(kinds):
        mine = label == k
        if mine.any():
            model.mean[k] = average[mine, k].mean()
            apart = (average[mine, k] - model.mean[k]) ** 2
            design = np.column_stack([np.ones(mine.sum()), 1 / total[mine]])
            fitted = np.linalg.lstsq(design, apart, rcond=None)[0]
            model.spread[k] = np.maximum(fitted, (LEAST_SPREAD**2, 0.0))
    rows = np.arange(len(every))
    found = z.argmax(axis=1)
    inside = model.deviation(average[rows, found], found, total)
    if kinds > 1:
        others = np.where(label[:, None] == np.arange(kinds), -np.inf, z).argmax(axis=1)
        outside = model.deviation(average[rows, others], others, total)
    else:
        outside = np.full(1, -8.0)  # nothing to compare with
    long = total >= LONG
    model.curve = _between(inside[long], outside[long] if kinds > 1 else outside)
    sure = model.known(inside) * np.exp((z / model.temperature).max(axis=1) - _log_sum(z / model.temperature))
    model.reject = float(min(EVEN, np.quantile(sure[long], FALSE_REJECTIONS)))


def _between(inside: np.ndarray, outside: np.ndarray) -> tuple[float, float]:
    """Slope and height of the logistic curve that passes one half between the two kinds, nearer to the outside ones.

    Where both overlap, keeping rows of known languages goes first.
    """
    low, high = np.quantile(inside, FALSE_REJECTIONS), np.quantile(outside, FOREIGN_REJECTIONS)
    centre = high + (low - high) / 8 if high < low else low
    slope = 4 / max(1.0, abs(low - centre))
    return float(slope), float(-slope * centre)


def _log_sum(z: np.ndarray) -> np.ndarray:
    top = z.max(axis=1)
    return top + np.log(np.exp(z - top[:, None]).sum(axis=1))


def _loss(z: np.ndarray, y: np.ndarray, smooth: float) -> float:
    """Cross entropy with a share of the label spread over all languages."""
    right = (1 - smooth) * z[np.arange(len(y)), y] + smooth * z.mean(axis=1)
    return float(np.mean(_log_sum(z) - right))


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """Adds `lang_pred`, `score` and `accepted` to every row.

    A null text, or one without a letter, is "und" with score 0 and not accepted; so is every text
    for a model without languages.  Else the likeliest language (of equals the first by name), its
    calibrated probability, and whether that reaches the rejection score.  Only the text is read, the whole of it: a
    very long one in pieces of a megabyte whose counts add up.
    Repeated rows stay, an empty table gives an empty one; added names that are taken get an underscore.
    """
    names = [fresh(docs, n) for n in ("lang_pred", "score", "accepted")]
    kinds = [T.StringType(), T.DoubleType(), T.BooleanType()]
    schema = T.StructType([*docs.schema.fields, *[T.StructField(n, t) for n, t in zip(names, kinds, strict=True)]])
    place = docs.columns.index(text)
    sent = ship(docs.sparkSession, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped(sent)
        for batch in batches:
            data, offsets = utf8(batch.column(place))
            langs, scores, accepted = [], [], []
            for a, b in zip(offsets[:-1], offsets[1:], strict=True):
                own = data[a:b]
                if not model.languages or not has_letter(own):
                    langs.append(NONE)
                    scores.append(0.0)
                    accepted.append(False)
                    continue
                p = model.scores(own)
                best = int(p.argmax())
                langs.append(model.languages[best])
                scores.append(float(p[best]))
                accepted.append(bool(p[best] >= model.reject))
            added = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(accepted, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=schema.names)

    return docs.mapInArrow(run, schema)
