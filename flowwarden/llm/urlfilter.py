"""URL filtering by a Bloom filter cascade, with DataFrame functions only.

The first level encodes the listed keys.  Those other keys of the corpus that it takes for listed
are encoded by the second level, the listed keys that the second takes for these by the third, and so
on until a level has nothing to correct.  A key's answer is given by the first level that lacks it.
Since every key of the corpus took part in the building, answers for the corpus are exact, and
no row is joined with the list.

Filters are literals in the plan, so their size is bounded: beyond `PART_KEYS` listed keys the
keys are dealt into parts by a hash, and each part is judged in a pass of its own over the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.llm.text import fresh
from flowwarden.session import durable

PART_KEYS = 200_000
#: Hash functions of a level: each makes it half as likely to take another key for one of its own.
LEAST_HASHES, MOST_HASHES = 6, 12

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without `://`."""
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), UPPER, LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


@dataclass
class Level:
    words: list[int]
    bits: int
    hashes: int


def _positions(key: Column, level: int, bits: int, hashes: int) -> list[Column]:
    # The level comes first in the hash: keys that collide on one level part on the next.
    h = F.xxhash64(F.lit(level), key)
    step, start = F.shiftrightunsigned(h, 33), h.bitwiseAND(F.lit((1 << 31) - 1))
    return [F.pmod(start + F.lit(i) * step, F.lit(bits)) for i in range(hashes)]


class Cascade:
    """Levels of one part of the keys."""

    def __init__(self, levels: list[Level]):
        self.levels = levels

    def has(self, at: int, key: Column) -> Column:
        level = self.levels[at]
        words = F.split(F.lit(",".join(map(str, level.words))), ",").cast("array<bigint>")  # folded to one constant
        found = F.lit(True)
        for p in _positions(key, at, level.bits, level.hashes):
            found = found & (F.bit_get(F.get(words, F.shiftright(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found

    def contains(self, key: Column) -> Column:
        """Is the key listed?  The first level that lacks it tells; a key on all levels is one of the last level's."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for at in reversed(range(len(self.levels))):
            answer = F.when(self.has(at, key), answer).otherwise(at % 2 == 1)
        return answer

    @staticmethod
    def build(keys: DataFrame) -> Cascade:
        """From (key, listed), one row a key, both without nulls: every key that may ever be asked."""
        cascade = Cascade([])
        sizes = {r["listed"]: r["count"] for r in keys.groupBy("listed").count().collect()}
        inside, outside = sizes.get(True, 0), sizes.get(False, 0)
        while inside:
            at = len(cascade.levels)
            rows = keys.filter(F.col("listed") == (at % 2 == 0))
            for i in range(at):
                rows = rows.filter(cascade.has(i, F.col("key")))
            hashes = min(MOST_HASHES, max(LEAST_HASHES, (outside // inside).bit_length() + 1))
            bits = 64 * (1 + inside * hashes * 3 // 128)  # 1.5 bits a key and hash: about half of the bits are set
            spots = rows.select(F.explode(F.array(*_positions(F.col("key"), at, bits, hashes))).alias("p"))
            one = F.expr("shiftleft(1L, cast(p & 63 as int))")
            words = spots.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(one).alias("x")).collect()
            filled = [0] * (bits // 64)
            for r in words:
                filled[r["w"]] = r["x"]
            cascade.levels.append(Level(filled, bits, hashes))
            wrong = keys.filter(F.col("listed") == (at % 2 == 1))
            for i in range(at + 1):
                wrong = wrong.filter(cascade.has(i, F.col("key")))
            inside, outside = wrong.count(), inside
        return cascade


def rule_keys(host: Column, path: Column, labels: int, depth: int) -> Column:
    """Host suffixes of up to `labels` labels with path prefixes of up to `depth` slashes, longest host first."""
    parts, steps = F.split(host, r"\."), F.split(path, "/")
    most, deep = F.least(F.size(parts), F.lit(labels)), F.least(F.size(steps) - 1, F.lit(depth))
    empty = F.array().cast("array<int>")
    suffixes = F.transform(F.sequence(most, F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(parts, F.size(parts) - i + 1, i), "."))
    prefixes = F.transform(
        F.when(deep >= 1, F.sequence(deep, F.lit(1), F.lit(-1))).otherwise(empty), lambda d: F.concat(F.array_join(F.slice(steps, 1, d), "/"), F.lit("/"))
    )
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], hosts: DataFrame, url: str = "url", part_keys: int = PART_KEYS) -> DataFrame:
    """Adds `host`, `path`, `rule` and `verdict` to every row.

    rules: (allow or block, host, path that ends with a slash); a rule fits its host and all
    subdomains if the path starts with the rule's; the longest wins, of equals the one with the longer host.
    hosts: one column of hosts that are blocked where no rule fits; others are allowed.  `rule` is the rule's host
    and path, or null.  A null url, or one without `://`, has an empty host and path, and no rule.
    Repeated rows stay, an empty table gives an empty one, nulls and repetitions among the hosts change nothing; added
    names that are taken get an underscore.
    """
    for _, _, p in rules:
        if not p.endswith("/"):
            raise ValueError("the path of a rule ends with a slash")
    labels = max([h.count(".") + 1 for _, h, _ in rules], default=1)
    depth = max([p.count("/") for _, _, p in rules], default=1)
    names = {n: fresh(pages, n) for n in ("host", "path", "rule", "verdict", "keys", "found")}
    host, path = host_path(F.col(url))
    split = pages.withColumns({names["host"]: host, names["path"]: path})
    host, path = F.col(names["host"]), F.col(names["path"])
    keys = rule_keys(host, path, labels, depth)
    # Three kinds of keys share one cascade: any rule, blocking rules, listed hosts.
    every = F.concat(
        F.transform(keys, lambda k: F.concat(F.lit("r "), k)),
        F.transform(keys, lambda k: F.concat(F.lit("b "), k)),
        F.array(F.concat(F.lit("h "), host)),
    )
    listed = [f"r {h}{p}" for _, h, p in rules] + [f"b {h}{p}" for a, h, p in rules if a == "block"]
    spark = pages.sparkSession
    asked = split.select(F.explode(every).alias("key")).withColumn("listed", F.lit(False)).distinct()
    fixed = spark.range(1).select(F.explode(F.array(*[F.lit(k) for k in listed]).cast("array<string>")).alias("key"), F.lit(True).alias("listed"))
    given = hosts.select(F.concat(F.lit("h "), F.col(hosts.columns[0])).alias("key"), F.lit(True).alias("listed")).filter(F.col("key").isNotNull())
    table = durable(asked.union(fixed).union(given).groupBy("key").agg(F.max("listed").alias("listed")))
    parts = max(1, -(-table.filter("listed").count() // part_keys))
    part = lambda k: F.pmod(F.xxhash64(F.lit("part"), k), F.lit(parts))
    out = split.withColumn(names["keys"], every)
    found = F.transform(F.col(names["keys"]), lambda k: F.lit(False))

    def step(at: int, cascade: Cascade, before: Column) -> Column:
        return F.zip_with(F.col(names["keys"]), before, lambda k, f: F.when(part(k) == at, cascade.contains(k)).otherwise(f))

    for at in range(parts):
        if parts == 1:
            found = F.transform(F.col(names["keys"]), Cascade.build(table).contains)
        else:
            cascade = Cascade.build(table.filter(part(F.col("key")) == at))
            out = durable(out.withColumn(names["found"], step(at, cascade, found)))
            found = F.col(names["found"])
    # Which of a row's keys are listed, then the longest rule among them.
    known = F.filter(F.zip_with(F.col(names["keys"]), found, lambda k, f: F.when(f, k)), lambda k: k.isNotNull())
    out = out.withColumn(names["found"], known) if parts == 1 else out.withColumn(names["keys"], known).drop(names["found"]).withColumnRenamed(names["keys"], names["found"])
    hits = F.col(names["found"])
    longest = F.aggregate(
        F.filter(hits, lambda k: k.startswith("r ")),
        F.lit(None).cast("string"),
        lambda best, k: F.when(best.isNull() | (F.length(k) > F.length(best)), k).otherwise(best),
    )
    out = out.withColumn(names["rule"], F.substring(longest, 3, 1 << 30))
    rule = F.col(names["rule"])
    by_rule = F.array_contains(hits, F.concat(F.lit("b "), rule))
    blocked = F.when(rule.isNotNull(), by_rule).otherwise(F.array_contains(hits, F.concat(F.lit("h "), host)))
    return out.withColumn(names["verdict"], F.when(blocked, "block").otherwise("allow")).drop(names["keys"], names["found"])
