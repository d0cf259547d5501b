"""Whitelist tests: addresses and networks as intervals of sorted keys.

An entry becomes an interval of address keys (fixed-width hex text behind a family mark, so their order
as text is the order of the addresses).  Sorted intervals are cut into chunks; a chunk holds the lower ends
and the running maximum of the upper ends, so the last lower end that is not above an address decides.
The chunks' first keys are all that the driver and the plan hold, one for `CHUNK` entries.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowwarden.functions import netaddr as N
from flowwarden.functions.search import count_at_most
from flowwarden.session import durable

CHUNK = 1024
#: Networks of one family that begin with the same address, at most, and the address itself.
SAME_START = 130
#: Mark of an IPv6 address that is listed as such: it is told by its text, as it is written.
TEXT = "7"


def whitelist_networks(whitelist: DataFrame) -> DataFrame:
    """Valid networks of a whitelist as (prefix, digits); malformed entries are ignored."""
    nets = whitelist.filter(F.col("entry").contains("/")).select(N.network("entry").alias("net"))
    return nets.filter(F.col("net").isNotNull()).select("net.prefix", "net.digits").distinct()


def whitelist_intervals(whitelist: DataFrame) -> DataFrame:
    """Distinct (lo, hi) keys of all valid entries, both ends included; malformed entries are ignored."""
    digits, cut = F.col("digits"), F.col("prefix") % 4
    width = F.when(digits.startswith("4"), 9).otherwise(33)
    # The digit that the prefix cuts through takes all its free bits.
    most = F.conv(F.right(digits, F.lit(1)), 16, 10).cast("int") + F.pow(F.lit(2.0), 4 - cut).cast("int") - 1
    top = F.when(cut == 0, digits).otherwise(F.concat(F.left(digits, F.length(digits) - 1), F.lower(F.hex(most.cast("bigint")))))
    nets = whitelist_networks(whitelist).select(F.rpad(digits, width, F.lit("0")).alias("lo"), F.rpad(top, width, F.lit("f")).alias("hi"))
    entry = F.col("entry")
    key = F.when(entry.contains(":"), F.concat(F.lit(TEXT), entry)).otherwise(N.ip_key(entry))
    exact = whitelist.filter(~entry.contains("/")).select(key.alias("lo"), key.alias("hi"))
    return nets.unionByName(exact).filter(F.col("lo").isNotNull()).distinct()


def interval_chunks(intervals: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """Sorted intervals in chunks: `first` key, lower ends `los`, running maxima of the upper ends `his`, and the last of these, `top`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[str, str]] = []

        def packed(rows: list[tuple[str, str]]) -> pa.RecordBatch:
            los, his = [lo for lo, _ in rows], list(accumulate((hi for _, hi in rows), max))
            columns = [pa.array([los[0]]), pa.array([los]), pa.array([his]), pa.array([his[-1]])]
            return pa.RecordBatch.from_arrays(columns, names=["first", "los", "his", "top"])

        for batch in batches:
            held += zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            while len(held) > chunk:
                # A key that many networks begin with stays in one chunk, or a chunk would not begin with its own key.
                end = chunk
                while end < len(held) and held[end][0] == held[end - 1][0]:
                    end += 1
                if end == len(held):
                    break
                yield packed(held[:end])
                held = held[end:]
        if held:
            yield packed(held)

    placed = intervals.select("lo", "hi").repartitionByRange("lo").sortWithinPartitions("lo")
    return durable(placed.mapInArrow(run, "first string, los array<string>, his array<string>, top string"))


def flag_whitelisted(
    rows: DataFrame, whitelist: DataFrame, ip: str = "ip", validity: str | None = None, chunk: int = CHUNK
) -> DataFrame:
    """Add a boolean `whitelisted`, and under the name `validity` whether the address parses.

    Each row is searched for in the first keys of the chunks, joined with its chunk and searched for in that.  The
    planner broadcasts chunks by their size in bytes or joins by chunk; no join depends on the prefix lengths in use.
    An IPv4 address is listed as such, an IPv6 address as it is written; an address that does not parse is never
    whitelisted.  A null or malformed entry is ignored.
    """
    chunks = interval_chunks(whitelist_intervals(whitelist), chunk)
    heads = sorted((r["first"], r["top"]) for r in chunks.select("first", "top").collect())
    key = N.ip_key(ip)
    out = rows.withColumn("_key", key)
    listed = F.lit(False)
    if heads:
        probes = {"_key": F.col("_key")}
        if heads[-1][1].startswith(TEXT):
            probes["_text"] = F.when(F.col("_key").startswith("6"), F.concat(F.lit(TEXT), F.col(ip)))
        firsts = F.lit([first for first, _ in heads])
        # Intervals of earlier chunks may reach into later ones.
        reach = F.lit(list(accumulate((top for _, top in heads), max)))
        for name, probe in probes.items():
            at, found = f"{name}_at", f"{name}_found"
            out = out.withColumn(at, count_at_most(firsts, probe, len(heads)))
            side = chunks.select(F.col("first").alias(f"{name}_first"), F.struct("los", "his").alias(found))
            out = out.join(side, F.get(firsts, F.col(at) - 1) == F.col(f"{name}_first"), "left")
            his = F.col(found)["his"]
            inside = F.get(his, count_at_most(F.col(found)["los"], probe, chunk + SAME_START) - 1) >= probe
            listed = listed | F.coalesce(inside, F.lit(False)) | F.coalesce(F.get(reach, F.col(at) - 2) >= probe, F.lit(False))
    valid = F.col("_key").isNotNull()
    extra = [valid.alias(validity)] if validity else []
    return out.select(*rows.columns, (valid & listed).alias("whitelisted"), *extra)


def whitelist_antijoin(rows: DataFrame, whitelist: DataFrame, ip: str = "ip") -> DataFrame:
    return flag_whitelisted(rows, whitelist, ip).filter(~F.col("whitelisted")).drop("whitelisted")


def whitelist_skipped(rows: DataFrame, whitelist: DataFrame, ip: str = "ip") -> DataFrame:
    return flag_whitelisted(rows, whitelist, ip).filter(F.col("whitelisted")).drop("whitelisted")


def set_changes(old: DataFrame, new: DataFrame, column: str) -> DataFrame:
    """Members that one of two sets lacks, with `added` or `removed`; no rows means no change."""
    marked = old.select(column, F.lit(1).alias("_old"), F.lit(0).alias("_new")).unionByName(
        new.select(column, F.lit(0).alias("_old"), F.lit(1).alias("_new"))
    )
    sides = marked.groupBy(column).agg(F.max("_old").alias("_old"), F.max("_new").alias("_new"))
    change = F.when(F.col("_new") > F.col("_old"), "added").otherwise("removed")
    return sides.filter(F.col("_old") != F.col("_new")).select(column, change.alias("change"))
