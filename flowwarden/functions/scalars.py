"""Scalar rules as Column expressions (all JVM-side)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowwarden.schema import BUCKETS, CONFIDENCE_FLOOR, SEVERITY, SEVERITY_FLOOR, TIERS, Tier


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def rounded(c: Column | str, places: int) -> Column:
    """Half-up rounding that does not depend on the order in which a double was summed.

    Going through a decimal with spare digits removes the last-bit noise of a distributed sum,
    so a tie rounds the same way under every partitioning.
    """
    return F.round(_col(c).cast("decimal(28,10)"), places).cast("double")


def percent(part: Column | str, whole: Column | str, places: int = 2) -> Column:
    share = F.try_divide(_col(part) * F.lit(100.0), _col(whole).cast("double"))
    return F.coalesce(rounded(share, places), F.lit(0.0))


def severity(flows: Column | str) -> Column:
    n = _col(flows)
    rule = F
    for name, at_least in SEVERITY:
        rule = rule.when(n >= at_least, name)
    return rule.otherwise(SEVERITY_FLOOR)


def confidence_bucket(p: Column | str) -> Column:
    """Histogram key of a probability; null outside the histogram."""
    p = _col(p)
    rule = F
    for i, (name, low, high) in enumerate(BUCKETS):
        below = p <= high if i == len(BUCKETS) - 1 else p < high
        rule = rule.when((p >= low) & below, name)
    return rule.otherwise(F.lit(None).cast("string"))


def tier_of(
    confidence: Column | str, tiers: Iterable[Tier] = TIERS, floor: float = CONFIDENCE_FLOOR
) -> Column:
    """Tier of a mean confidence: the strongest one reached, null below the floor."""
    c = _col(confidence)
    rule = F.when(c < floor, F.lit(None).cast("string"))
    ladder = sorted(tiers, key=lambda t: t.min_confidence)
    for upper in reversed(ladder[1:]):
        rule = rule.when(c >= upper.min_confidence, upper.name)
    return rule.when(c.isNotNull(), ladder[0].name)


def tier_value(tier: Column | str, tiers: Iterable[Tier], attribute: str, dtype: str) -> Column:
    """Look a tier attribute up by tier name (the table is a handful of constants)."""
    t = _col(tier)
    rule = None
    for row in tiers:
        value = F.lit(getattr(row, attribute)).cast(dtype)
        rule = F.when(t == row.name, value) if rule is None else rule.when(t == row.name, value)
    return rule.otherwise(F.lit(None).cast(dtype))


def tier_seconds(tier: Column | str, tiers: Iterable[Tier] = TIERS) -> Column:
    return tier_value(tier, tiers, "seconds", "bigint")


def tier_alias(tier: Column | str, tiers: Iterable[Tier] = TIERS) -> Column:
    return tier_value(tier, tiers, "alias", "string")


def unblock_at(
    ts: Column | str, tier: Column | str, tiers: Iterable[Tier] = TIERS, tick_seconds: int = 0
) -> Column:
    """Moment a block ends; null = never. With a tick, the first tick at or after that moment."""
    end = _col(ts) + F.make_dt_interval(secs=tier_seconds(tier, tiers))
    if not tick_seconds:
        return end
    micros = F.unix_micros(end.cast("timestamp"))
    tick = tick_seconds * 1_000_000
    return F.timestamp_micros(F.ceil(micros / F.lit(tick)).cast("bigint") * tick)


def alert_id(ip: Column | str, ts: Column | str) -> Column:
    stamp = F.date_format(_col(ts), "yyyyMMddHHmmss")
    return F.concat(F.lit("SSH_BF_"), F.replace(_col(ip), F.lit("."), F.lit("")), F.lit("_"), stamp)


def alert_filename(ip: Column | str, ts: Column | str) -> Column:
    stamp = F.date_format(_col(ts), "yyyyMMdd_HHmmss")
    host = F.replace(_col(ip), F.lit("."), F.lit("_"))
    return F.concat(F.lit("alert_"), host, F.lit("_"), stamp, F.lit(".json"))


def stats_filename(name: Column | str, ts: Column | str) -> Column:
    stamp = F.date_format(_col(ts), "yyyyMMdd_HHmmss")
    return F.concat(F.lit("stats_"), stem(name), F.lit("_"), stamp, F.lit(".json"))


def base_name(path: Column | str) -> Column:
    return F.substring_index(_col(path), "/", -1)


def stem(path: Column | str) -> Column:
    """File name without its last suffix; a name that only starts with a dot keeps it."""
    return F.regexp_replace(base_name(path), r"(?<=[^.])\.[^.]+$", "")


def capture_ts(path: Column | str) -> Column:
    """Start of a capture, parsed from its file name; null when the name holds none."""
    stamp = F.regexp_extract(base_name(path), r"capture_(\d{8}_\d{6})\.pcap", 1)
    return F.try_to_timestamp(stamp, F.lit("yyyyMMdd_HHmmss"))


def flow_file_name(capture: Column | str) -> Column:
    return F.concat(base_name(capture), F.lit("_Flow.csv"))


def month_key(ts: Column | str) -> Column:
    return F.date_format(_col(ts), "yyyyMM")


def iso_format(ts: Column | str) -> Column:
    """ISO text with a fraction only when there is one."""
    ts = _col(ts)
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    full = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(full.endswith(".000000"), whole).otherwise(full)


def iso_parse(text: Column | str) -> Column:
    return F.try_to_timestamp(_col(text))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    return F.timestamp_diff("SECOND", _col(start), _col(end))


def block_description(confidence: Column | str, flows: Column | str) -> Column:
    share = F.format_string("%.2f", rounded(_col(confidence) * 100, 2))
    return F.concat(
        F.lit("Blocked by ML: "), share, F.lit("% confidence, "), _col(flows).cast("string"), F.lit(" flows")
    )


def binary_label(label: Column | str, attack: str) -> Column:
    return (_col(label) == attack).cast("int")


def target_key(ip: Column | str, port: Column | str) -> Column:
    return F.concat_ws(":", _col(ip), _col(port).cast("string"))


def or_default(c: Column | str, default) -> Column:
    return F.coalesce(_col(c), F.lit(default))


def lines_to_list(text: Column | str) -> Column:
    """Newline text -> trimmed, non-blank lines."""
    lines = F.transform(F.split(_col(text), "\n"), lambda x: F.trim(x))
    return F.coalesce(F.filter(lines, lambda x: x != ""), F.array().cast("array<string>"))


def list_to_lines(items: Column | str) -> Column:
    return F.array_join(_col(items), "\n")


def alias_add(text: Column | str, ip: Column | str) -> Column:
    """Alias text with an address in it; adding one that is there already changes nothing."""
    items = lines_to_list(text)
    ip = _col(ip)
    grown = F.when(F.array_contains(items, ip), items).otherwise(F.array_append(items, ip))
    return list_to_lines(grown)


def alias_remove(text: Column | str, ip: Column | str) -> Column:
    return list_to_lines(F.array_remove(lines_to_list(text), _col(ip)))
