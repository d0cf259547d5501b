"""Block policy: intake of alerts, block episodes, history, counters and lists.

Alerts of one address fold into episodes.  An alert opens an episode when the previous alert's
timer has run out; otherwise it resets the timer.  No timer is shorter than the shortest tier, so
two alerts of an address that lie in the same slice of that length always share an episode.
Alerts are therefore first summed up per (address, slice), which also collapses a hot address on
the map side, and the sequence rule runs over slices: their number per address is bounded by the
time span, not by the number of alerts.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowwarden.functions import scalars as S
from flowwarden.operators.features import side_by_side
from flowwarden.operators.positions import ordered_position
from flowwarden.operators.whitelist import flag_whitelisted
from flowwarden.schema import CONFIDENCE_FLOOR, TIERS, Tier

ALERT_COLUMNS = ["ip", "ts", "alert_id", "confidence", "total_flows", "alert_file"]


def to_block_alerts(documents: DataFrame) -> DataFrame:
    """Alert documents -> the flat columns the block policy works on.

    A long alert comes in several documents (`part` 0, 1, ...) with the same totals; it counts once.
    """
    if "part" in documents.columns:
        documents = documents.filter(F.coalesce("part", F.lit(0)) == 0)
    file = F.col("alert_file") if "alert_file" in documents.columns else F.lit("unknown")
    return documents.select(
        F.col("attacker_ip").alias("ip"),
        F.col("timestamp").alias("ts"),
        S.or_default("alert_id", "unknown").alias("alert_id"),
        F.col("confidence.average").alias("confidence"),
        "total_flows",
        file.alias("alert_file"),
    )


def alert_intake(
    alerts: DataFrame, whitelist: DataFrame, floor: float = CONFIDENCE_FLOOR, ip: str = "ip", parsed_only: bool = True
) -> DataFrame:
    """Add `status`: invalid, below_threshold, whitelisted or accepted, decided in this order.

    An address that does not parse is invalid; without `parsed_only` only a missing one is, and any other text
    that names an attacker goes on, though no entry lists it.
    """
    flagged = flag_whitelisted(alerts, whitelist, ip, validity="_valid")
    named = F.col("_valid") if parsed_only else F.coalesce(F.col(ip) != "", F.lit(False))
    status = (
        F.when(~named | F.col("confidence").isNull(), "invalid")
        .when(F.col("confidence") < floor, "below_threshold")
        .when(F.col("whitelisted"), "whitelisted")
        .otherwise("accepted")
    )
    return flagged.withColumn("status", status).drop("whitelisted", "_valid")


def block_tiers(alerts: DataFrame, tiers: Iterable[Tier] = TIERS, floor: float = CONFIDENCE_FLOOR) -> DataFrame:
    """Tier, alias and end of block of each alert; alerts below the floor have no tier and drop."""
    tiers = tuple(tiers)
    tiered = alerts.withColumn("tier", S.tier_of("confidence", tiers, floor)).filter(F.col("tier").isNotNull())
    return tiered.withColumn("alias", S.tier_alias("tier", tiers)).withColumn(
        "unblock_at", S.unblock_at("ts", "tier", tiers)
    )


def slice_seconds(tiers: Iterable[Tier]) -> int:
    finite = [t.seconds for t in tiers if t.seconds is not None]
    return min(finite) if finite else 86_400


def _slice(ts: str, tiers: Iterable[Tier]) -> Column:
    seconds = F.unix_seconds(F.col(ts).cast("timestamp"))
    return F.floor(seconds / F.lit(slice_seconds(tiers))).cast("bigint")


def episode_slices(
    alerts: DataFrame,
    tiers: Iterable[Tier] = TIERS,
    as_of: Column | None = None,
    tick_seconds: int = 0,
    floor: float = CONFIDENCE_FLOOR,
) -> DataFrame:
    """One row per (address, slice): its alerts in brief, its episode, and the alerts before it there."""
    tiers = tuple(tiers)
    tiered = alerts.withColumn("tier", S.tier_of("confidence", tiers, floor)).filter(F.col("tier").isNotNull())
    if as_of is not None:
        tiered = tiered.filter(F.col("ts") <= as_of)
    order = F.struct("ts", "alert_id")
    opening = F.struct("ts", "alert_id", "tier", "confidence", "total_flows", "alert_file")
    slices = tiered.groupBy("ip", _slice("ts", tiers).alias("slice")).agg(
        F.count(F.lit(1)).alias("alerts"),
        F.min_by(opening, order).alias("first"),
        F.max_by(F.struct("ts", "alert_id", "tier"), order).alias("last"),
    )

    by_ip = Window.partitionBy("ip").orderBy("slice")
    slices = slices.withColumn("_prev", F.lag("last").over(by_ip))
    ended = S.unblock_at("_prev.ts", "_prev.tier", tiers, tick_seconds)
    opens = F.col("_prev").isNull() | F.coalesce(F.col("first.ts") >= ended, F.lit(False))
    slices = slices.withColumn("_new", opens.cast("int"))
    running = by_ip.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slices = slices.withColumn("_ep", F.sum("_new").over(running).cast("bigint"))
    # A block that opened as permanent takes in everything that follows.
    forever = (F.col("_new") == 1) & S.tier_seconds("first.tier", tiers).isNull()
    lasting = F.min(F.when(forever, F.col("_ep"))).over(Window.partitionBy("ip"))
    slices = slices.withColumn("episode", F.least("_ep", F.coalesce(lasting, F.col("_ep"))))
    earlier = Window.partitionBy("ip", "episode").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("alerts").over(earlier), F.lit(0))
    return slices.select("ip", "slice", "alerts", "first", "last", "episode", before.alias("before"))


def block_episodes(
    alerts: DataFrame,
    tiers: Iterable[Tier] = TIERS,
    as_of: Column | None = None,
    tick_seconds: int = 0,
    floor: float = CONFIDENCE_FLOOR,
) -> DataFrame:
    """Block episodes of accepted alerts.  The opening alert gives tier, alias, confidence and flow
    count, the newest one gives the end of the block.  Closed = ended at or before `as_of`."""
    tiers = tuple(tiers)
    merged = (
        episode_slices(alerts, tiers, as_of, tick_seconds, floor)
        .groupBy("ip", "episode")
        .agg(
            F.sum("alerts").alias("attempt_count"),
            F.min_by("first", "slice").alias("first"),
            F.max_by("last", "slice").alias("last"),
        )
    )
    unblock = S.unblock_at("last.ts", "last.tier", tiers, tick_seconds)
    lasting = S.tier_seconds("first.tier", tiers).isNull()
    closed = ~lasting & unblock.isNotNull()
    if as_of is not None:
        closed = closed & (unblock <= as_of)
    return merged.select(
        "ip",
        "episode",
        F.col("first.ts").alias("blocked_at"),
        unblock.alias("unblock_at"),
        F.col("first.tier").alias("tier"),
        S.tier_alias("first.tier", tiers).alias("alias"),
        F.col("first.confidence").alias("confidence_avg"),
        F.col("first.total_flows").alias("total_flows"),
        F.col("first.alert_id").alias("alert_id"),
        F.col("first.alert_file").alias("alert_file"),
        F.when(closed, "closed").otherwise("active").alias("status"),
        "attempt_count",
        F.when(F.col("attempt_count") > 1, F.col("last.ts")).alias("last_attempt"),
    )


def block_actions(
    alerts: DataFrame,
    tiers: Iterable[Tier] = TIERS,
    as_of: Column | None = None,
    tick_seconds: int = 0,
    floor: float = CONFIDENCE_FLOOR,
) -> DataFrame:
    """The action log: `block` or `reset` per alert, with its attempt number in the episode."""
    tiers = tuple(tiers)
    if as_of is not None:
        alerts = alerts.filter(F.col("ts") <= as_of)
    tiered = alerts.withColumn("tier", S.tier_of("confidence", tiers, floor)).filter(F.col("tier").isNotNull())
    sliced = tiered.withColumn("slice", _slice("ts", tiers))
    placed = ordered_position(sliced, ["ts", "alert_id"], ["ip", "slice"], name="_place")
    slices = episode_slices(alerts, tiers, None, tick_seconds, floor).select("ip", "slice", "episode", "before")
    joined = placed.join(slices, ["ip", "slice"])
    attempt = F.col("before") + F.col("_place")
    return joined.select(
        "ip",
        "ts",
        "alert_id",
        "tier",
        "confidence",
        "episode",
        F.when(attempt == 1, "block").otherwise("reset").alias("action"),
        attempt.alias("attempt_count"),
        S.unblock_at("ts", "tier", tiers, tick_seconds).alias("unblock_at"),
    )


def block_history(episodes: DataFrame) -> DataFrame:
    """Closed episodes with the month they ended in."""
    return episodes.filter(F.col("status") == "closed").select(
        S.month_key("unblock_at").alias("month"),
        "ip",
        "blocked_at",
        F.col("unblock_at").alias("unblocked_at"),
        "tier",
        "confidence_avg",
        "total_flows",
        F.col("attempt_count").alias("attempts"),
    )


def history_per_ip(history: DataFrame) -> DataFrame:
    """Closed blocks of an address and month as an array.  Blocks of an address do not overlap and
    last at least the shortest tier, which bounds the array by the length of a month."""
    record = F.struct("blocked_at", "unblocked_at", "tier", "confidence_avg", "total_flows", "attempts")
    return history.groupBy("month", "ip").agg(F.array_sort(F.collect_list(record)).alias("blocks"))


def active_blocks(episodes: DataFrame) -> DataFrame:
    """State table: the open episode of each address."""
    return episodes.filter(F.col("status") == "active")


def expired_blocks(blocks: DataFrame, now: Column, tiers: Iterable[Tier] = TIERS) -> DataFrame:
    """Blocks of a state table that have to be lifted at `now`."""
    temporary = S.tier_seconds("tier", tiers).isNotNull()
    return blocks.filter(temporary & F.col("unblock_at").isNotNull() & (F.col("unblock_at") <= now))


def persistent_attackers(episodes: DataFrame, min_resets: int) -> DataFrame:
    """Addresses that reset some block at least `min_resets` times."""
    most = episodes.groupBy("ip").agg(F.max("attempt_count").alias("max_attempts"))
    return most.filter(F.col("max_attempts") - 1 >= min_resets)


def block_counters(
    intake: DataFrame, episodes: DataFrame, started: Column, now: Column, tiers: Iterable[Tier] = TIERS
) -> DataFrame:
    """Counters of the block service, one row."""
    active = F.col("status") == "active"
    blocks = episodes.agg(
        F.count(F.lit(1)).alias("total_blocks"),
        F.coalesce(F.sum(F.col("attempt_count") - 1), F.lit(0)).alias("block_timer_resets"),
        F.count_if(active).alias("currently_blocked"),
        *[F.count_if(active & (F.col("tier") == t.name)).alias(f"active_{t.name}") for t in tiers],
        F.count_if(~active).alias("total_unblocks"),
    )
    skips = intake.agg(
        F.count_if(F.col("status") == "whitelisted").alias("skipped_whitelisted"),
        F.count_if(F.col("status") == "below_threshold").alias("skipped_below_threshold"),
        F.count_if(F.col("status") == "invalid").alias("skipped_invalid"),
    )
    both = side_by_side(blocks, skips)
    return both.withColumn("uptime_seconds", S.elapsed_seconds(started, now))


def alias_contents(active: DataFrame, max_entries: int = 100_000) -> DataFrame:
    """Alias lists as newline text.  A list longer than `max_entries` is published in parts, so no
    text has to hold an unbounded number of addresses."""
    members = active.groupBy("alias", "ip").agg(F.lit(1).alias("_n"))
    sizes = members.groupBy("alias").agg(F.ceil(F.count(F.lit(1)) / F.lit(max_entries)).cast("int").alias("parts"))
    # `sizes` has one row per alias; aliases are the handful of tiers.
    split = members.join(F.broadcast(sizes), "alias")
    split = split.withColumn("part", F.pmod(F.xxhash64("ip"), F.col("parts")).cast("int"))
    return split.groupBy("alias", "part").agg(
        F.count(F.lit(1)).alias("entries"),
        S.list_to_lines(F.array_sort(F.collect_list("ip"))).alias("content"),
    )


def alias_diff(desired: DataFrame, current: DataFrame) -> DataFrame:
    """(alias, ip, change): what to add to and to remove from the published lists."""
    want = desired.select("alias", "ip").distinct()
    have = current.select("alias", "ip").distinct()
    add = want.join(have, ["alias", "ip"], "left_anti").withColumn("change", F.lit("add"))
    remove = have.join(want, ["alias", "ip"], "left_anti").withColumn("change", F.lit("remove"))
    return add.unionByName(remove)


def missing_aliases(current: DataFrame, tiers: Iterable[Tier] = TIERS) -> DataFrame:
    """Aliases of the tier table that are not published yet."""
    names = current.sparkSession.createDataFrame([(t.alias,) for t in tiers], "alias string")
    return names.join(current.select("alias").distinct(), "alias", "left_anti")
