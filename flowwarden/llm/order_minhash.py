"""Document fingerprints by order min-hashing: signatures that follow the edit distance of texts.

A text is a sequence of words: runs of code points that are no white space, while ideographs and kana
are words of one code point.  Its k-mers are all runs of `k` words; fewer words, but one at least, are
one k-mer as a whole.  Each k-mer is numbered by how often it stood in the text before, so repeated
passages count.  Numbered k-mers are hashed onto a circle.  Entry b of a signature starts at point b
of `m` even points and selects the `l` k-mers that come next on the circle, that is, the smallest in
the hash order shifted to that point.  These are put back into the order in which they stand in the text, and the
tuple is hashed.  Two texts have an equal entry if they share the selected k-mers in the same order,
so the share of equal entries falls with moved passages as well as with changed words.

All of it is array functions on one row: nothing is exploded, and nothing leaves the JVM.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.llm.text import fresh

#: Words: a run of anything but white space; from U+2E80 on (scripts that are written without spaces) each code point.
BLANK = r"\x09\x0A\x0B\x0C\x0D\x20"
ALONE = r"\x{2E80}-\x{10FFFF}"
K, L, M = 2, 2, 64
#: A numbered k-mer is packed in 64 bits: its place on the circle above, its position in the text below.
PLACE_BITS = 28
HASH_BITS = 64 - PLACE_BITS
PLACE = (1 << PLACE_BITS) - 1
ENTRY_BITS = 32
#: Rows that are put in order as one sorted run, and the number of runs that the driver knows the starts of.
RUN_ROWS, RUNS = 1024, 1 << 17


def _place(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(PLACE).cast("bigint"))


def _hash(packed: Column) -> Column:
    return F.shiftrightunsigned(packed, PLACE_BITS)


def _pack(value: Column, place: Column) -> Column:
    return F.shiftleft(value, PLACE_BITS).bitwiseOR(place)


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _begins(array: Column) -> Callable[[Column, Column], Column]:
    """Whether an element is the first of its k-mer in a sorted array."""
    return lambda x, i: (i == 0) | (F.shiftrightunsigned(x.bitwiseXOR(F.get(array, i - 1)), PLACE_BITS) != 0)


def _numbered(packed: Column) -> Column:
    """Sorted elements with the hash of (k-mer, number) in place of the k-mer's, where it stands for the second time or later."""

    def later(again: Column) -> Column:
        starts = F.filter(F.transform(again, lambda x, i: F.when(_begins(again)(x, i), i)), lambda i: i.isNotNull())
        numbers = _let(starts, lambda s: F.flatten(F.transform(s, lambda i, j: F.sequence(F.lit(1), F.coalesce(F.get(s, j + 1), F.size(again)) - i))))
        hashed = F.zip_with(again, numbers, lambda x, n: _pack(F.xxhash64(_hash(x), n), _place(x)))
        return F.transform(hashed, lambda x: F.coalesce(x, F.lit(0).cast("bigint")))

    def whole(first: Column) -> Column:
        return F.sort_array(F.concat(first, _let(F.array_except(packed, first), later)))

    return _let(F.filter(packed, _begins(packed)), whole)


def signatures(df: DataFrame, text: str = "text", name: str = "signature", k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """Adds `name`, an array of `m` entries of 32 bits; a text without words has an empty one.

    A null text is an empty one.  Equal texts have equal signatures wherever they stand; repeated rows
    stay, an empty table gives an empty one.  A text is held whole in its task, as arrays of its words
    and of 8 bytes a word; positions beyond 2^28 words count from 0 again.  `m` is a power of two.
    """
    if m < 1 or m & (m - 1):
        raise ValueError("m is a power of two")
    if k < 1 or l < 1:
        raise ValueError("k and l are 1 at least")
    names = df.columns
    words, runs, circle, halving = (fresh(df, n) for n in ("_words", "_runs", "_circle", "_halving"))
    # Each step refers to the array before it more than once, so Catalyst keeps the steps apart.
    w = F.col(words)
    whole = F.coalesce(text, F.lit(""))
    # The plain pattern is faster, and the same where no such code point is in the text.
    mixed = F.regexp_extract_all(whole, F.lit(f"[^{BLANK}{ALONE}]+|[{ALONE}]"), F.lit(0))
    spaced = F.regexp_extract_all(whole, F.lit(f"[^{BLANK}]+"), F.lit(0))
    split = df.select(*names, F.when(whole.rlike(f"[{ALONE}]"), mixed).otherwise(spaced).alias(words))
    heads = F.slice(w, F.lit(1), F.greatest(F.size(w) - (k - 1), F.least(F.size(w), F.lit(1))))
    kmer = F.transform(heads, lambda first, i: _pack(F.xxhash64(first, *[F.get(w, i + j) for j in range(1, k)]), _place(i.cast("bigint"))))
    # Equal k-mers stand together, in text order.  The first one's hash stands for number 0.
    r, c = F.col(runs), F.col(circle)
    kmers = split.select(*names, F.sort_array(kmer).alias(runs))
    plain = F.size(F.array_distinct(F.transform(r, _hash))) == F.size(r)
    placed = kmers.select(*names, F.when(plain, r).otherwise(_numbered(r)).alias(circle))
    # Steps by which a search halves the circle, the largest first.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(31))])
    searched = placed.select(*names, circle, F.filter(steps, lambda b: b <= F.size(c)).alias(halving))
    n = F.size(c)

    def below(point: Column) -> Column:
        """How many elements stand before a point; signed numbers are in the circle's order, cut at its middle."""
        return F.aggregate(
            F.col(halving), F.lit(0), lambda at, b: F.when((at + b <= n) & (F.get(c, at + b - 1) < point), at + b).otherwise(at)
        )

    def entry(at: Column, b: Column) -> Column:
        chosen = F.transform(F.sequence(F.lit(0), F.least(n, F.lit(l)) - 1), lambda j: F.get(c, (at + j) % n))
        in_order = F.sort_array(F.transform(chosen, lambda x: F.shiftleft(_place(x), HASH_BITS).bitwiseOR(_hash(x))))
        label = F.aggregate(in_order, b.cast("bigint"), lambda a, x: F.xxhash64(a, x.bitwiseAND(F.lit((1 << HASH_BITS) - 1).cast("bigint"))))
        return F.shiftrightunsigned(label, 64 - ENTRY_BITS)

    points = F.array(*[F.lit((b << 64) // m - (1 << 63)) for b in range(m)])
    none = F.array().cast("array<bigint>")
    entries = F.transform(F.transform(points, below), entry)
    return searched.select(*[F.col(x) for x in names if x != name], F.when(n > 0, entries).otherwise(none).alias(name))


def written(signature: Column) -> Column:
    """A signature as text, 8 hex digits an entry."""
    return F.array_join(F.transform(signature, lambda x: F.lower(F.lpad(F.hex(x), ENTRY_BITS // 4, "0"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries, 0 to 1: two texts without words are alike, one without words is like no other."""
    longest = F.greatest(F.size(a), F.size(b))
    equal = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same))
    return F.when(longest == 0, 1.0).otherwise(equal / longest).cast("double")


def _search(starts: list, value: Column) -> Column:
    """How many of the falling `starts` are not below `value`, by halving."""
    array = F.lit(starts) if starts else F.array().cast("array<bigint>")
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(max(1, len(starts).bit_length())))])
    n = len(starts)
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, b: F.when(at + b <= n, F.when(F.get(array, at + b - 1) >= value, at + b).otherwise(at)).otherwise(at),
    )


def in_runs(df: DataFrame, order: str, run: str, extra: str, rows: int = RUN_ROWS, runs: int = RUNS) -> DataFrame:
    """Deals rows into runs of falling `order` (a whole number; nulls last), each with the first row of the next run.

    Adds `run` and `extra`, which marks the copy of the next run's first row: sorted by `extra` and `order`, every
    row of a run has its successor behind it.  The last run is followed by the first row of all.  Runs hold about
    `rows` rows; there are `runs` of them at most, so the starts that the driver collects are bounded.
    """
    column = F.col(order).cast("bigint")
    total = df.select(F.count(column).alias("n")).first()["n"]
    count = max(1, min(runs, total // max(1, rows)))
    cuts = df.select(F.percentile_approx(column, [i / count for i in range(1, count)] or [0.5], 5 * count).alias("c")).first()["c"] or []
    cuts = sorted(set(cuts), reverse=True)
    # Every start is a value of the table, the largest of its run.
    dealt = df.filter(column.isNotNull()).groupBy(_search(cuts, column).alias("g")).agg(F.max(column).alias("start"))
    starts = sorted((r["start"] for r in dealt.collect()), reverse=True)
    # A null has no start above it that it is not below; it belongs to the last run, behind all numbers.
    mine = F.when(column.isNull(), F.lit(max(0, len(starts) - 1))).otherwise(_search(starts, column) - 1)
    before = F.when(mine == 0, F.lit(max(0, len(starts) - 1))).otherwise(mine - 1)
    if starts:
        is_start = F.get(F.lit(starts), mine) == column
    else:
        is_start = F.lit(True)  # no row has a number: one run
    both = F.when(F.coalesce(is_start, F.lit(False)), F.array(F.struct(mine.alias(run), F.lit(False).alias(extra)), F.struct(before.alias(run), F.lit(True).alias(extra))))
    return df.select("*", F.inline(both.otherwise(F.array(F.struct(mine.alias(run), F.lit(False).alias(extra))))))


def edits(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = K, l: int = L, m: int = M) -> DataFrame:  # noqa: E741
    """Every text and its edited text with both signatures and their likeness, and that to the next text.

    The next document has the next smaller id; after the smallest comes the largest.  The edited text is the text
    with its last floor(n / 2) code points replaced by the first as many of the next text (all of it, if that is
    shorter).  Returns `doc_id`, `n_chars`, `edited`, `signature`, `edited_signature`, `near_edited` and `near_next`.

    Documents are dealt once, with their texts, into short runs of falling ids, so no task sees all ids.  A null
    text is an empty one.  Null ids come after all others; among equal ids the order is that of the texts, and
    rows that are equal in both are interchangeable.  A single document is its own next one.  An empty table
    gives an empty one; other columns are dropped.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    dealt = in_runs(rows, "doc_id", "run", "extra")
    order = [F.col("extra"), F.col("doc_id").desc_nulls_last(), F.col("text")]
    inside = Window.partitionBy("run").orderBy(*order)
    after = dealt.select("run", "extra", "doc_id", "text", F.coalesce(F.lead("text").over(inside), F.lit("")).alias("following"))
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - half), F.substring(F.col("following"), F.lit(1), half))
    # The copies of first rows only lend their signature.
    pairs = after.select("run", "extra", "doc_id", "text", n.cast("bigint").alias("n_chars"), F.when(~F.col("extra"), edited).alias("edited"))
    signed = signatures(signatures(pairs, "text", "signature", k, l, m), "edited", "edited_signature", k, l, m)
    # Again in the order of the run: ids and texts are sorted already.
    joined = signed.withColumn("next_signature", F.lead("signature").over(inside)).filter(~F.col("extra"))
    mine = F.col("signature")
    return joined.select(
        "doc_id", "n_chars", "edited", "signature", "edited_signature",
        likeness(mine, F.col("edited_signature")).alias("near_edited"), likeness(mine, F.col("next_signature")).alias("near_next"),
    )
