"""Quality rules on text statistics, with robust multivariate outliers; DataFrame functions only.

Statistics of each text become a vector of four numbers on a grid.  For each language and source
the minimum-covariance-determinant estimate of place and scatter is found by concentration steps from
three starts: the `SHARE` of the texts nearest by Mahalanobis distance is kept and its mean and
covariance give the next distances, until no estimate changes.  Of the three subsets, the one whose covariance has the
least determinant is taken.  Texts beyond the `CUT` distance are rejected.

An estimate from n texts is blended with that of its language, and this with that of all, with weights
n and `PRIOR`, so no number of texts switches a source from one estimate to another.

The steps work on counts of equal grid vectors, aggregated before the shuffle, so a source with a third of
all texts is no larger than another.  Sums are of whole numbers, so results don't depend on any order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.session import durable

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
SYMBOLS = r"[^#*$%&|<>]+"
DIM = 4
#: Least deviation of each number: log of the mean word length, log of the percentage of symbols
#: plus one, share of repeated lines, share of repeated words.
FLOORS = (0.10, 0.35, 0.12, 0.08)
#: Grid steps in a least deviation, and the largest grid number.
GRID, FAR = 8, 100_000
SHARE = 0.75
#: Concentration steps at most; they mostly settle in fewer.
STEPS = 15
#: Texts that the estimate of the wider group counts for.
PRIOR = 200
# Fixed values for four dimensions: quantile 0.9999 of the chi-square distribution, and what makes
# the covariance of the nearest 75 % right for normal data.
CUT = 23.51
CONSISTENT = 1.487
#: Steps of the logarithm of a distance in which the nearest share is cut off.
BINS = 64


def with_statistics(docs: DataFrame, text: str) -> DataFrame:
    """Adds n_words, word_chars, n_symbols, n_lines (those with a word), n_dup_lines and n_repeat_words."""
    t = F.coalesce(F.col(text), F.lit(""))
    out = docs.withColumn("__t", t)
    trimmed = F.regexp_replace("__t", rf"^{SPACE}+|{SPACE}+$", "")
    out = out.withColumn("__trim", trimmed)
    words = F.when(F.col("__trim") == "", F.array().cast("array<string>")).otherwise(F.split("__trim", rf"{SPACE}+"))
    lines = F.filter(F.split("__t", "\n"), lambda x: x.rlike(WORD))
    out = out.withColumns({"__w": words, "__l": lines})
    n = F.size("__w")
    gram = lambda i: F.struct(
        F.xxhash64(F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)).alias("h"), i.alias("i")
    )
    grams = F.when(n >= 3, F.transform(F.sequence(F.lit(0), n - 3), gram)).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))
    out = out.withColumn("__g", F.sort_array(grams))
    twice = F.filter(
        "__g",
        lambda g, j: (F.get("__g", j + 1)["h"].eqNullSafe(g["h"])) | ((j > 0) & F.get("__g", F.greatest(j - 1, F.lit(0)))["h"].eqNullSafe(g["h"])),
    )
    out = out.withColumn("__p", F.sort_array(F.transform(twice, lambda g: g["i"])))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    covered = F.aggregate(
        "__p", start, lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")), lambda a: a["n"]
    )
    long = {
        "n_words": n,
        "word_chars": F.length(F.array_join("__w", "")),
        "n_symbols": F.length(F.regexp_replace("__t", SYMBOLS, "")),
        "n_lines": F.size("__l"),
        "n_dup_lines": F.size("__l") - F.size(F.array_distinct("__l")),
        "n_repeat_words": covered,
    }
    return out.withColumns({k: v.cast("bigint") for k, v in long.items()}).drop("__t", "__trim", "__w", "__l", "__g", "__p")


def grid() -> list[Column]:
    """The vector of a text's statistics in grid steps."""
    n, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))
    values = [
        F.log(F.greatest(F.col("word_chars") / n, F.lit(1.0))),
        F.log1p(100 * F.col("n_symbols") / F.greatest("word_chars", F.lit(1))),
        F.col("n_dup_lines") / lines,
        F.col("n_repeat_words") / n,
    ]
    return [F.least(F.round(v * GRID / f), F.lit(FAR)).cast("bigint") for v, f in zip(values, FLOORS, strict=True)]


def _factor(mean: list[Column], cov: list[list[Column]]) -> dict[str, Column]:
    """Columns of an estimate: means, and the lower Cholesky factor of the covariance plus the least variances."""
    out = {f"m{i}": m for i, m in enumerate(mean)}
    low: list[list[Column]] = [[F.lit(0.0)] * DIM for _ in range(DIM)]
    for i in range(DIM):
        for j in range(i + 1):
            rest = cov[i][j] + (GRID**2 if i == j else 0)
            for k in range(j):
                rest = rest - low[i][k] * low[j][k]
            low[i][j] = F.sqrt(F.greatest(rest, F.lit(1.0))) if i == j else rest / low[j][j]
            out[f"c{i}{j}"] = low[i][j]
    return out


def _distance() -> Column:
    """Squared Mahalanobis distance of q0.. to an estimate's columns, by forward substitution."""
    z: list[Column] = []
    for i in range(DIM):
        rest = F.col(f"q{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"c{i}{k}") * z[k]
        z.append(rest / F.col(f"c{i}{i}"))
    return sum((x * x for x in z[1:]), z[0] * z[0])


MEAN = [f"m{i}" for i in range(DIM)]
COV = [f"v{i}{j}" for i in range(DIM) for j in range(i + 1)]


def _moments(cells: DataFrame, by: list[str]) -> DataFrame:
    """Mean (m*) and covariance (v*) of each group's cells, weighted by their counts."""
    q = [F.col(f"q{i}") for i in range(DIM)]
    sums = [F.sum(F.col("n") * x).alias(f"s{i}") for i, x in enumerate(q)]
    squares = [F.sum((F.col("n") * q[i] * q[j]).cast("decimal(38,0)")).cast("double").alias(f"x{i}{j}") for i in range(DIM) for j in range(i + 1)]
    total = cells.groupBy(*by).agg(F.sum("n").alias("n"), *sums, *squares)
    mean = [F.col(f"s{i}") / F.col("n") for i in range(DIM)]
    cov = [(F.col(f"x{i}{j}") / F.col("n") - mean[i] * mean[j]).alias(f"v{i}{j}") for i in range(DIM) for j in range(i + 1)]
    return total.select(*by, *[m.alias(f"m{i}") for i, m in enumerate(mean)], *cov)


def _factored(moments: DataFrame, *names: str) -> DataFrame:
    """The named columns, the means, and the factor (c*) of the covariance plus the least variances."""
    mean = [F.col(m) for m in MEAN]
    factor = _factor(mean, [[F.col(f"v{i}{j}") for j in range(i + 1)] for i in range(DIM)])
    return moments.select(*names, *[v.alias(k) for k, v in factor.items()])


def _starts(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, size), and three first estimates of each group: quartiles, outer tenths, and all of it."""
    shares = F.array(*[F.lit(x) for x in (0.1, 0.25, 0.5, 0.75, 0.9)])
    quantiles = [F.percentile(f"q{i}", shares, F.col("n")).alias(f"p{i}") for i in range(DIM)]
    spread = durable(cells.groupBy("group").agg(F.sum("n").alias("size"), *quantiles))
    middle = [F.col(f"p{i}")[2].alias(f"m{i}") for i in range(DIM)]

    def diagonal(low: int, high: int, width: float) -> list[Column]:
        value = [((F.col(f"p{i}")[high] - F.col(f"p{i}")[low]) / width) ** 2 for i in range(DIM)]
        return [(value[i] if i == j else F.lit(0.0)).alias(f"v{i}{j}") for i in range(DIM) for j in range(i + 1)]

    quartiles = spread.select("group", F.lit(0).alias("start"), *middle, *diagonal(1, 3, 1.349))
    tenths = spread.select("group", F.lit(1).alias("start"), *middle, *diagonal(0, 4, 2.563))
    whole = _moments(cells, ["group"]).withColumn("start", F.lit(2))
    return spread.select("group", "size"), quartiles.unionByName(tenths).unionByName(whole)


def _nearest(cells: DataFrame, now: DataFrame) -> DataFrame:
    """Cells of each (group, start) up to the distance within which the nearest share of its texts lies."""
    far = F.floor(F.log1p(_distance()) * BINS).cast("int")
    placed = cells.join(_factored(now, "group", "start"), "group").select("group", "start", *[f"q{i}" for i in range(DIM)], "n", far.alias("bin"))
    # The last bin that is needed is found in a list of a group's few bins.
    bins = placed.groupBy("group", "start", "bin").agg(F.sum("n").alias("n"))
    lists = bins.groupBy("group", "start").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("b"), F.sum("n").alias("size"))
    begin = F.struct(F.lit(0).cast("bigint").alias("sum"), F.lit(None).cast("int").alias("bin"))
    reach = F.aggregate(
        "b",
        begin,
        lambda a, x: F.struct(
            (a["sum"] + x["n"]).alias("sum"),
            F.when(a["bin"].isNull() & (a["sum"] + x["n"] >= SHARE * F.col("size")), x["bin"]).otherwise(a["bin"]).alias("bin"),
        ),
        lambda a: a["bin"],
    )
    return placed.join(lists.select("group", "start", reach.alias("reach")), ["group", "start"]).filter(F.col("bin") <= F.col("reach"))


def estimates(cells: DataFrame) -> DataFrame:
    """(group, size, m*, v*) of each group of (group, q*, n): the subset of least determinant, made consistent."""
    sizes, first = _starts(cells)
    now = durable(first)
    for _ in range(STEPS):
        then = durable(_moments(_nearest(cells, now), ["group", "start"]))
        # Sums are exact, so a subset that stays the same has the same moments to the last bit.
        moved = then.join(now, ["group", "start", *MEAN, *COV], "left_anti").limit(1).count()
        now = then
        if not moved:
            break
    size = sum(2 * F.log(F.col(f"c{i}{i}")) for i in range(DIM))  # logarithm of the determinant, least variances included
    ranked = _factored(now, "group", "start").withColumn("det", F.round(size, 9))
    best = ranked.groupBy("group").agg(F.min_by("start", F.struct("det", "start")).alias("start"))
    chosen = now.join(best, ["group", "start"]).drop("start")
    wider = [(F.col(v) * CONSISTENT).alias(v) for v in COV]
    return durable(chosen.select("group", *MEAN, *wider).join(sizes, "group"))


def _blend(own: Column, wide: Column) -> Column:
    """An estimate drawn towards a wider one, the more the fewer texts it is from; without the former, the latter."""
    w = own["size"] / (own["size"] + PRIOR)
    mean = {m: w * own[m] + (1 - w) * wide[m] for m in MEAN}
    cov = {}
    for i in range(DIM):
        for j in range(i + 1):
            cov[f"v{i}{j}"] = w * own[f"v{i}{j}"] + (1 - w) * wide[f"v{i}{j}"]
    both = F.struct(own["size"].alias("size"), *[c.alias(n) for n, c in (mean | cov).items()])
    return F.when(own.isNull(), wide).otherwise(both)


def judge(
    docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source", keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The `keep` columns of every row with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, distance.

    Words end at white space; a null text has none.  n_dup_lines counts lines with a word that equal an earlier one;
    n_repeat_words the words in three-word windows that the text has twice or more.  base_failed: fewer than 50 words,
    or more than half of the words repeat.  kept is false for those, and for the others if the
    squared distance to the estimate of their language and source exceeds `CUT`.  Null languages
    and sources are groups of their own.  Repeated rows stay, an empty table gives an empty one;
    columns other than those named are ignored.
    """
    places = {name: f"k{i}" for i, name in enumerate(keep)}
    named = docs.select(
        *[F.col(n).alias(p) for n, p in places.items()], F.col(text).alias("t"), F.col(lang).alias("lang"), F.col(source).alias("source")
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    stats = with_statistics(named, "t").drop("t").withColumn("base_failed", failed)
    stats = durable(stats.withColumns({f"q{i}": g for i, g in enumerate(grid())}))
    # Levels 0 to 2: a language and source, a language, all.
    own, by_lang, all_ = (
        F.concat(F.lit(f"{n} "), *[F.coalesce(F.concat(F.length(c), F.lit(":"), c), F.lit("-")) for c in parts])
        for n, parts in enumerate((("lang", "source"), ("lang",), ()))
    )
    cells = stats.filter(~F.col("base_failed")).groupBy("lang", "source", *[f"q{i}" for i in range(DIM)]).agg(F.count(F.lit(1)).alias("n"))
    levels = F.explode(F.array(own, by_lang, all_)).alias("group")
    cells = durable(cells.select(levels, *[f"q{i}" for i in range(DIM)], "n").groupBy("group", *[f"q{i}" for i in range(DIM)]).agg(F.sum("n").alias("n")))
    found = estimates(cells)
    # The estimate of a language and source: settled between the few groups, not per row.
    groups = stats.select("lang", "source").distinct().withColumn("group", F.explode(F.array(own, by_lang, all_)))
    record = F.struct("size", *MEAN, *COV)
    level = F.substring("group", 1, 1)
    by_level = [F.max(F.when(level == str(i), record)).alias(f"e{i}") for i in range(3)]
    wide = groups.join(found, "group").groupBy("lang", "source").agg(*by_level)
    wide = wide.withColumn("e", _blend(F.col("e1"), F.col("e2"))).withColumn("e", _blend(F.col("e0"), F.col("e")))
    chosen = _factored(wide.select(F.col("lang").alias("l"), F.col("source").alias("s"), "e.*"), "l", "s")
    out = stats.join(chosen, F.col("lang").eqNullSafe(F.col("l")) & F.col("source").eqNullSafe(F.col("s")), "left")
    distance = F.round(_distance(), 6)
    return out.select(
        *[F.col(p).alias(n) for n, p in places.items()],
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & F.coalesce(distance <= CUT, F.lit(True))).alias("kept"),
        distance.alias("distance"),
    )
