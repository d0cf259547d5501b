"""Merkle manifests of a dataset: a tree a group, and a tree over the groups' roots.

Every level is a table of nodes (tree, index, digest).  A level equijoins itself with the computed
indices of each node's siblings: XOR where two nodes make a parent, the run's other slots otherwise.
What a node meets is its piece of proof, left and right of its slot; the rows of slot zero hold a
whole run and emit the parents, the next level.  A run is one key of the join, never more than
`arity` rows, so no group is large however many rows a tree has.

Proofs go the other way: the siblings of a few high nodes are handed down to the runs below them, so
every leaf ends up with its path (left and right digests a level) and can be folded to the root.
Digests are kept as 32 bytes and hashed as hex text.  It is joins and functions of the JVM throughout.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.operators.positions import ordered_position
from flowwarden.session import BROADCAST_ROWS, durable

ARITY = 16
PATH = "array<struct<left:binary,right:binary>>"


def hashed(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the joined texts."""
    return F.sha2(F.concat(*[p.cast("string") for p in parts]).cast("binary"), 256)


def field(value: Column | str) -> Column:
    """`-` for null, else the number of bytes of the value's text, a colon, and the text."""
    c = (F.col(value) if isinstance(value, str) else value).cast("string")
    return F.when(c.isNull(), "-").otherwise(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c))


def leaf_hash(fields: Sequence[Column | str]) -> Column:
    return hashed(*[field(f) for f in fields])


def as_hex(digest: Column) -> Column:
    return F.lower(F.hex(digest))


@contextmanager
def _joined_where_they_are(spark: SparkSession) -> Iterator[None]:
    """Rows of a run are in one partition already; a join that also asks for the slot needs no second shuffle."""
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


@dataclass
class Tree:
    """`levels[j]`: nodes of level j that have a parent (tree, index, size, digest, left, right; level 0 has what leaves
    carry); `tops`: a row a tree (tree, height, digest); `alone`: leaves that are tops themselves."""

    levels: list[DataFrame]
    tops: DataFrame
    alone: DataFrame


def _siblings(nodes: DataFrame, arity: int, carry: Sequence[str]) -> DataFrame:
    """Nodes with the digests left and right of their slot, each joined."""
    index, size = F.col("index"), F.col("size")
    run = F.floor(index / arity).cast("bigint")
    placed = nodes.withColumn("run", run).repartition("tree", "run")
    if arity == 2:
        wanted = F.array(index.bitwiseXOR(F.lit(1).cast("bigint")))
    else:
        slots = F.sequence(F.lit(0).cast("bigint"), F.lit(arity - 1).cast("bigint"))
        wanted = F.filter(F.transform(slots, lambda s: F.col("run") * arity + s), lambda i: i != index)
    # One that is not there (the last run is shorter) finds no partner.
    ask = placed.select("*", F.explode(F.filter(wanted, lambda i: i < size)).alias("sibling"))
    alone = placed.filter((index % arity == 0) & (index == size - 1)).withColumn("sibling", F.lit(None).cast("bigint"))
    have = placed.select("tree", "run", F.col("index").alias("sibling"), F.col("digest").alias("other"))
    met = ask.unionByName(alone).join(have, ["tree", "run", "sibling"], "left")
    near = F.sort_array(F.collect_list(F.when(F.col("other").isNotNull(), F.struct("sibling", "other"))))
    whole = met.groupBy("tree", "run", "index", "size", "digest", *carry).agg(near.alias("near"))

    def side(chosen) -> Column:
        return F.unhex(F.array_join(F.transform(F.filter("near", chosen), lambda x: F.hex(x["other"])), ""))

    left, right = side(lambda x: x["sibling"] < index), side(lambda x: x["sibling"] > index)
    return whole.select("tree", "index", "size", "digest", *carry, left.alias("left"), right.alias("right"))


def grow(nodes: DataFrame, arity: int = ARITY, carry: Sequence[str] = ()) -> Tree:
    """The trees over `nodes` (tree, index from 0, size of the tree, digest, and the columns to carry).

    A tree of one node is its own top.  The number of levels follows the largest tree, by logarithm.
    """
    if arity < 2:
        raise ValueError("arity is 2 at least")
    spark = nodes.sparkSession
    largest = nodes.agg(F.max("size").alias("size")).first()["size"] or 0
    alone = nodes.filter(F.col("size") == 1)
    tops = alone.select("tree", F.lit(0).alias("height"), "digest")
    levels: list[DataFrame] = []
    level, kept = nodes, list(carry)
    while largest > 1:
        with _joined_where_they_are(spark):
            found = durable(_siblings(level.filter(F.col("size") > 1), arity, kept))
        levels.append(found)
        # Slot zero has the whole run on its right.
        parents = found.filter(F.col("index") % arity == 0).select(
            "tree",
            F.floor(F.col("index") / arity).cast("bigint").alias("index"),
            F.ceil(F.col("size") / arity).cast("bigint").alias("size"),
            F.unhex(hashed(as_hex(F.col("digest")), as_hex(F.col("right")))).alias("digest"),
        )
        level, kept = parents, []
        largest = -(-largest // arity)
        tops = tops.unionByName(level.filter(F.col("size") == 1).select("tree", F.lit(len(levels)).alias("height"), "digest"))
    return Tree(levels, tops, alone)


def paths(tree: Tree, above: DataFrame, extra: Sequence[str], carry: Sequence[str], arity: int = ARITY) -> DataFrame:
    """Leaves (tree, digest, carried columns) with their `path` and the extra columns of `above` (tree, height, path, extra)."""
    down: DataFrame | None = None
    for at in reversed(range(len(tree.levels))):
        # Parents of this level: nodes of the level above it, and the tops that are that high.
        up = above.filter(F.col("height") == at + 1).select("tree", F.lit(0).cast("bigint").alias("run"), F.col("path").alias("rest"), *extra)
        if down is not None:
            up = up.unionByName(down.select("tree", F.col("index").alias("run"), F.col("path").alias("rest"), *extra))
        mine = tree.levels[at].withColumn("run", F.floor(F.col("index") / arity).cast("bigint"))
        step = F.array(F.struct("left", "right"))
        joined = mine.join(up, ["tree", "run"]).withColumn("path", F.concat(step, F.col("rest")).cast(PATH))
        names = ["tree", "index", "digest", "path", *extra] + (list(carry) if at == 0 else [])
        down = joined.select(*names)
        if at:
            down = durable(down)
    single = tree.alone.join(above.filter(F.col("height") == 0), "tree")
    names = ["tree", "digest", "path", *extra, *carry]
    alone = single.select("tree", tree.alone["digest"], "path", *extra, *carry)
    return alone if down is None else down.select(*names).unionByName(alone)


def _code(group: Column) -> Column:
    """A group as a key that is never null and sorts null first, then by bytes."""
    return F.when(group.isNull(), "").otherwise(F.concat(F.lit("="), group.cast("string")))


def proof(path: Column) -> Column:
    """Hash of all siblings of a path, level by level, left to right."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(as_hex(s["left"]), as_hex(s["right"]))), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf's hex digest gives with the siblings of its path."""
    return F.aggregate(path, leaf, lambda acc, s: hashed(as_hex(s["left"]), acc, as_hex(s["right"])))


def manifest(leaves: DataFrame, order: str, group: str, leaf: str, carry: Sequence[str] = (), arity: int = ARITY) -> DataFrame:
    """Proof paths of all `leaves`: `order`, `leaf`, the carried columns, `subroot`, `root` (hex) and `path`.

    Per group (a null group is one too) leaves ascend by `order`, null first, and by `leaf` among equals; runs of
    `arity` nodes become one node until one is left, the subroot.  Subroots in order of the group, null first, give the
    root likewise.  Rows that are equal in all of that are interchangeable.  A lone leaf is its own subroot; an
    empty table gives an empty one.  Other columns are dropped.
    """
    rows = leaves.select(_code(F.col(group)).alias("tree"), F.col(order).alias("_order"), F.unhex(leaf).alias("digest"), F.struct(*carry).alias("_carried") if carry else F.lit(True).alias("_carried"))
    rows = durable(rows)  # the texts behind it are read and hashed once
    sizes = durable(rows.groupBy("tree").agg(F.count(F.lit(1)).alias("size")))
    few = sizes.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    placed = ordered_position(rows, ["_order", "digest"], ["tree"], name="index")
    sized = placed.join(F.broadcast(sizes) if few else sizes, "tree").withColumn("index", F.col("index") - 1)
    carried = ["_order", "_carried"]
    nodes = durable(sized.select("tree", "index", "size", "digest", *carried))
    tree = grow(nodes, arity, carried)

    # The second tree: subroots in order of their group.
    tops = durable(tree.tops)
    ranked = durable(ordered_position(tops.select(F.col("tree").alias("name"), "digest"), ["name"], name="index"))
    number = ranked.count()
    second = grow(ranked.select(F.lit("").alias("tree"), F.col("index") - 1, F.lit(number).cast("bigint").alias("size"), "digest", "name").toDF("tree", "index", "size", "digest", "name"), arity, ["name"])
    crown = second.tops.select("tree", "height", F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    subroots = paths(second, crown, ["root"], ["name"], arity)
    above = subroots.select(F.col("name").alias("tree"), "path", F.col("digest").alias("subroot"), "root")
    above = durable(tops.select("tree", "height").join(above, "tree"))
    found = paths(tree, above, ["subroot", "root"], carried, arity)
    more = [F.col(f"_carried.{c}").alias(c) for c in carry]
    return found.select(
        F.col("_order").alias(order), as_hex(F.col("digest")).alias(leaf), *more,
        as_hex(F.col("subroot")).alias("subroot"), as_hex(F.col("root")).alias("root"), "path",
    )


def audit(
    docs: DataFrame, fields: Sequence[str], altered: dict[str, Column], changed: Column, order: str = "doc_id", group: str = "source",
    arity: int = ARITY,
) -> DataFrame:
    """The manifest of `docs`, checked against a copy in which rows where `changed` holds have `altered` fields.

    Returns `order`, `leaf`, `subroot`, `root`, `proof_sha256` (all of the original rows), `folded_root` (of the copy's
    leaf with the original siblings) and `verified`.  A null in any field has a code of its own; texts are hashed
    whole in the JVM; where `changed` is null nothing is altered.  Other columns are dropped.
    """
    other = [altered[f] if f in altered else F.col(f) for f in fields]
    leaves = docs.select(
        F.col(order), F.col(group), leaf_hash(fields).alias("leaf"),
        F.when(F.coalesce(changed, F.lit(False)), F.unhex(leaf_hash(other))).alias("bent"),
    )
    found = manifest(leaves, order, group, "leaf", ["bent"], arity)
    seen = F.coalesce(as_hex(F.col("bent")), F.col("leaf"))
    folded = found.withColumn("folded_root", fold(seen, F.col("path")))
    return folded.select(
        order, "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
