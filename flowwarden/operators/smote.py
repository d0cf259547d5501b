"""Minority oversampling by interpolation between near neighbours.

The neighbour search is exact.  Points are cut into blocks along their distance to a pivot; a block
whose range is further away than a point's k-th distance inside its own block cannot hold one of its neighbours.
A block is one row with a matrix.  Pairs of blocks are a join of those few rows, whose parts are read again for each
task instead of sent once for each block that they meet, and k rows per point and part are emitted.  In many
dimensions the pivot rules few blocks out, so the time grows nearly with the square of the rows; what is sent and
written grows with the rows, but for the k rows per part.  Exact copies are collapsed before the search and
expanded after it.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.operators.positions import ordered_position
from flowwarden.operators.sampling import hash_mix
from flowwarden.session import durable

BLOCK_ROWS = 2048
#: Blocks are cut smaller than `MOST_BYTES` only while they are few.
BLOCKS, MOST_BYTES = 16, 1 << 22
PART_BLOCKS = 8  # blocks that a task holds to search in
STEP, CHUNK = 128, 1024  # query and data rows per matrix of products
PAIRS = 1 << 16  # pairs per exact evaluation


def _distances(wanted: np.ndarray, points: np.ndarray, row: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Distances of the pairs (wanted[row], points[at]), a bounded number at a time."""
    out = np.empty(len(row))
    for start in range(0, len(row), PAIRS):
        part = slice(start, start + PAIRS)
        gaps = wanted[row[part]] - points[at[part]]
        out[part] = np.sqrt(np.einsum("jk,jk->j", gaps, gaps))
    return out


def _closest(
    own: np.ndarray, wanted: np.ndarray, ids: np.ndarray, points: np.ndarray, k: int, limit: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, id, distance) of the k nearest data rows of each query row, itself excluded, ties by id; rows in order.

    Nothing beyond a row's `limit` is wanted (inf: not known).  Products of matrices tell which data rows can be among
    those, whatever their rounding; only they are measured by their differences.
    """
    by_id = np.argsort(ids, kind="stable")  # columns in order of id, so a stable sort breaks ties
    ids, points = ids[by_id], points[by_id]
    unit = 16 * (points.shape[1] + 8) * np.finfo(float).eps
    spread = slice(None, None, max(1, len(ids) // max(CHUNK, k + 1)))  # the k-th among these bounds the k-th of all
    found = [(np.empty(0, int), ids[:0], np.empty(0))]
    with np.errstate(over="ignore", invalid="ignore"):
        squares, mine = np.einsum("jk,jk->j", points, points), np.einsum("jk,jk->j", wanted, wanted)
        left, right = np.c_[-2 * wanted, np.ones(len(wanted))], np.c_[points, squares].T
        slack = unit * (mine + squares.max())
        reach = limit**2 * (1 + unit) - mine + slack  # all without the query row's own square
        for start in range(0, len(own), STEP):
            some = slice(start, start + STEP)
            far, pairs = reach[some], []
            if (unknown := np.isinf(limit[some])).any():
                about = np.where(own[some, None] == ids[None, spread], np.inf, left[some] @ right[:, spread])
                last = min(k, about.shape[1]) - 1
                far = np.where(unknown, np.partition(about, last, axis=1)[:, last] + slack[some], far)
            for begin in range(0, len(ids), CHUNK):
                about = left[some] @ right[:, begin : begin + CHUNK]
                hits = np.flatnonzero(~(about > far[:, None]))  # what is no number is measured
                row, at = np.divmod(hits, about.shape[1])
                pairs.append((row, at + begin))
            row, at = (np.concatenate(x) for x in zip(*pairs, strict=True))
            dist = _distances(wanted[some], points, row, at)
            kept = np.isfinite(dist) & (dist <= limit[some][row]) & (own[some][row] != ids[at])
            row, at, dist = row[kept], at[kept], dist[kept]
            order = np.lexsort((at, dist, row))
            row, at, dist = row[order], at[order], dist[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((row[best] + start, ids[at[best]], dist[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _nearest(query: pd.DataFrame, data: pd.DataFrame, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`_closest` of two frames of `vid` and `vec`, without limits."""
    wanted, points = np.stack(query["vec"].to_numpy()), np.stack(data["vec"].to_numpy())
    return _closest(query["vid"].to_numpy(), wanted, data["vid"].to_numpy(), points, k, np.full(len(query), np.inf))


def _kth(row: np.ndarray, dist: np.ndarray, k: int, limit: np.ndarray) -> np.ndarray:
    """`limit`, or the k-th distance of a row that has one; rows in order."""
    at = np.arange(len(row)) - np.searchsorted(row, row) == k - 1
    out = limit.copy()
    out[row[at]] = dist[at]
    return out


def _distinct_vectors(points: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: its smallest id as `vid`, and its k + 1 smallest ids."""
    placed = ordered_position(points, ["id"], ["vec"], name="place")
    return placed.filter(F.col("place") <= k + 1).groupBy("vec").agg(
        F.min("id").alias("vid"), F.array_sort(F.collect_list("id")).alias("ids")
    )


def _blocked(vectors: DataFrame, block_rows: int) -> tuple[DataFrame, list[float], list[float]]:
    size = F.size("vec")
    width = vectors.select(size.alias("d")).first()
    if width is None:
        return vectors.withColumn("proj", F.lit(0.0)).withColumn("block", F.lit(0).cast("bigint")), [], []
    stats = vectors.agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(F.col("vec")[i]).alias(f"c{i}") for i in range(width["d"])]
    ).first()
    n = stats["n"]
    pivot = F.array(*[F.lit(stats[f"c{i}"]) for i in range(width["d"])])
    square = F.aggregate(
        F.zip_with("vec", pivot, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x
    )
    projected = vectors.withColumn("proj", F.sqrt(square))
    most = max(1, MOST_BYTES // (8 * max(1, width["d"])))
    blocks = max(1, min(n // block_rows, max(BLOCKS, n // most)))
    placed = ordered_position(projected, ["proj", "vid"], name="place")
    block = F.floor((F.col("place") - 1) * F.lit(blocks) / F.lit(n)).cast("bigint")
    placed = placed.withColumn("block", block)
    ranges = placed.groupBy("block").agg(F.min("proj").alias("lo"), F.max("proj").alias("hi"))
    bounds = ranges.orderBy("block").collect()  # two numbers a block
    return placed.drop("place"), [r["lo"] for r in bounds], [r["hi"] for r in bounds]


def nearest_neighbours(df: DataFrame, key: str, vector: str, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(id, neighbour_id, distance, rank) of the k nearest other rows, ties by id.  Exact.

    Blocks that the pivot rules out are few in many dimensions, so the time is close to that of all pairs.  A block has
    at least `block_rows` rows, and more where they would be more than `BLOCKS`.
    """
    points = df.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    vectors = durable(_distinct_vectors(points, k))
    placed, lows, highs = _blocked(vectors, max(block_rows, k + 1))
    lo, hi = np.array(lows), np.array(highs)

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        row, _, dist = _nearest(pdf, pdf, k)
        radius = _kth(row, dist, k, np.full(len(pdf), np.inf))
        # The spare margin covers rounding in `proj`.
        margin, proj = radius * (1 + 1e-9) + 1e-9, pdf["proj"].to_numpy()
        first = np.searchsorted(hi, proj - margin, side="left")
        last = np.searchsorted(lo, proj + margin, side="right") - 1
        matrix = np.stack(pdf["vec"].to_numpy()).astype("<f8").tobytes()
        return pd.DataFrame({
            "block": [pdf["block"].iloc[0]], "low": [first.min()], "high": [last.max()], "ids": [pdf["vid"].to_numpy()],
            "matrix": [matrix], "radius": [radius], "first": [first], "last": [last],
        })

    vid = dict(df.dtypes)[key]
    packed = durable(placed.select("vid", "vec", "proj", "block").groupBy("block").applyInPandas(
        pack,
        f"block bigint, low bigint, high bigint, ids array<{vid}>, matrix binary, radius array<double>, "
        "first array<bigint>, last array<bigint>",
    ))
    # A block a part on one side and a few on the other; a task reads two parts, and nothing is sent for each pair.
    blocks = max(1, len(lows))
    parts = -(-blocks // PART_BLOCKS)
    queries = packed.repartitionById(blocks, F.col("block").cast("int"))
    targets = packed.select(F.col("block").alias("met"), F.col("ids").alias("met_ids"), F.col("matrix").alias("met_matrix"))
    targets = targets.repartitionById(parts, F.col("met").cast("int"))
    pairs = queries.hint("shuffle_replicate_nl").join(targets, F.col("met").between(F.col("low"), F.col("high")))

    def matrix(ids, packed):
        return np.frombuffer(packed, "<f8").reshape(len(ids), -1)

    def search(batches):
        block, best = None, []
        for pdf in batches:
            for pair in pdf.itertuples(index=False):
                if pair.block != block:
                    yield from best
                    block, own, wanted, limit = pair.block, pair.ids, matrix(pair.ids, pair.matrix), pair.radius
                    row, other, dist = np.empty(0, int), own[:0], np.empty(0)
                near = np.flatnonzero((pair.first <= pair.met) & (pair.met <= pair.last))
                points = matrix(pair.met_ids, pair.met_matrix)
                new = _closest(own[near], wanted[near], pair.met_ids, points, k, limit[near])
                row, other, dist = (np.concatenate(x) for x in zip((row, other, dist), (near[new[0]], *new[1:]), strict=True))
                order = np.lexsort((np.unique(other, return_inverse=True)[1], dist, row))
                row, other, dist = row[order], other[order], dist[order]
                kept = np.arange(len(row)) - np.searchsorted(row, row) < k
                row, other, dist = row[kept], other[kept], dist[kept]
                limit = _kth(row, dist, k, limit)
                best = [pd.DataFrame({"vid": own[row], "other": other, "distance": dist})]
        yield from best

    found = pairs.mapInPandas(search, f"vid {vid}, other {vid}, distance double")
    best = Window.partitionBy("vid").orderBy("distance", "other")  # k rows per part that was read
    nearest = durable(found.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= k).drop("r"))

    # Back to rows: a vector's own copies at distance 0, then the ids of its neighbours.
    copies = vectors.select("vid", F.col("vid").alias("other"), F.lit(0.0).alias("distance"))
    linked = nearest.unionByName(copies)
    expanded = (
        linked.join(vectors.select(F.col("vid").alias("other"), "ids"), "other")
        .select("vid", "distance", F.explode("ids").alias("neighbour_id"))
    )
    # Per distinct vector at most (k + 1)^2 candidates; the k + 1 best serve all its copies.
    order = Window.partitionBy("vid").orderBy("distance", "neighbour_id")
    shortlist = expanded.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= k + 1)
    lists = shortlist.groupBy("vid").agg(F.array_sort(F.collect_list(F.struct("distance", "neighbour_id"))).alias("l"))
    by_vector = vectors.select("vid", "vec").join(lists, "vid").select("vec", "l")
    # Copies of one vector all meet its single list; adaptive skew handling splits a hot one.
    each = points.join(by_vector, "vec")
    mine = F.slice(F.filter("l", lambda x: x["neighbour_id"] != F.col("id")), 1, k)
    ranked = each.select("id", F.posexplode(mine).alias("pos", "n"))
    return ranked.select(
        "id", F.col("n.neighbour_id").alias("neighbour_id"), F.col("n.distance").alias("distance"),
        (F.col("pos") + 1).alias("rank"),
    )


def smote(
    df: DataFrame, key: str, vector: str, label: str, minority: int | None = None, k: int = 5, seed: int = 42,
    block_rows: int = BLOCK_ROWS, parents: bool = False,
) -> DataFrame:
    """Rows of `df` (`vector`, `label`, `synthetic`) plus interpolated minority rows up to parity.

    The minority is the class with fewer rows unless one is named.  Base rows and neighbours are all minority rows.
    With `parents` each synthetic row carries the vectors it lies between, and its fraction.
    Every base row gets an equal share of the draws.  Neighbour and fraction come from a hash of
    (id, draw), so the result does not depend on partitioning or retries.
    """
    sizes = {r[label]: r["n"] for r in df.filter(F.col(label).isin(0, 1)).groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if minority is None:
        minority = min((0, 1), key=lambda c: (sizes.get(c, 0), -c))
    few, many = sizes.get(minority, 0), sizes.get(1 - minority, 0)
    original = df.select(F.col(vector).cast("array<double>").alias(vector), label, F.lit(False).alias("synthetic"))
    if parents:
        original = original.withColumns({c: F.lit(None).cast(t) for c, t in (("base", "array<double>"), ("other", "array<double>"), ("u", "double"))})
    missing = many - few
    if few < 2 or missing <= 0:
        return original
    base = df.filter(F.col(label) == minority)
    share, rest = divmod(missing, few)
    picked = base.select(F.col(key).alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    picked = picked.withColumn("_mix", hash_mix("id", seed=seed))
    placed = ordered_position(picked, ["_mix", "id"], name="place")
    draws = F.lit(share) + (F.col("place") <= rest).cast("int")
    drawn = placed.withColumn("draws", draws).filter(F.col("draws") > 0)

    near = nearest_neighbours(base, key, vector, k, block_rows)
    lists = near.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "neighbour_id"))).alias("near"))
    each = drawn.join(lists, "id").withColumn("draw", F.explode(F.sequence(F.lit(1), F.col("draws").cast("int"))))
    slot = F.pmod(F.xxhash64("id", "draw", F.lit(seed)), F.size("near")) + 1
    each = each.withColumn("other", F.element_at("near", slot.cast("int"))["neighbour_id"])
    fraction = hash_mix("id", "draw", seed=seed + 1) / F.lit(float(1 << 40))
    each = each.withColumn("u", fraction)
    # A popular neighbour may be drawn often; its vector joins on a unique key.
    vectors = picked.select(F.col("id").alias("other"), F.col("vec").alias("ovec"))
    made = each.join(vectors, "other")
    mixed = F.zip_with("vec", "ovec", lambda a, b: a + F.col("u") * (b - a))
    fresh = made.select(
        mixed.alias(vector), F.lit(minority).cast(dict(df.dtypes)[label]).alias(label), F.lit(True).alias("synthetic"),
        *([F.col("vec").alias("base"), F.col("ovec").alias("other"), "u"] if parents else []),
    )
    return original.unionByName(fresh)
