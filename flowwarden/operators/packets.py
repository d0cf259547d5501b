"""Sessions and flow features from ordered events or packets.

A key may carry a large share of all packets, so a key is never sorted as one group.  Packets are
first summed up per (key, slice of time), with a slice no longer than the gaps that split
sessions; everything inside a slice then belongs together.  Slices of a key are put in order, and
the gaps between neighbouring slices are added when slices are merged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SECOND = 1_000_000  # times are handled in microseconds

# TCP flag bits.
FIN, SYN, RST, PSH, ACK, URG, ECE, CWR = 1, 2, 4, 8, 16, 32, 64, 128


def micros(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(c.cast("timestamp"))


WHOLE = "decimal(38,0)"


def _square(c: Column) -> Column:
    return (c.cast("decimal(19,0)") * c.cast("decimal(19,0)")).cast(WHOLE)


def _gap_aggs(gap: Column, name: str) -> list[Column]:
    """Mergeable summary of whole numbers such as gaps (nulls are no gaps); sums are exact."""
    g = gap.cast("bigint")
    return [
        F.count(g).alias(f"{name}_n"),
        F.coalesce(F.sum(g.cast("decimal(19,0)")), F.lit(0)).cast(WHOLE).alias(f"{name}_s"),
        F.coalesce(F.sum(_square(g)), F.lit(0)).cast(WHOLE).alias(f"{name}_q"),
        F.max(g).alias(f"{name}_max"),
        F.min(g).alias(f"{name}_min"),
    ]


def _gap_merge(name: str, boundary: Column) -> list[Column]:
    """Merge slice summaries in order, adding the gap in front of each slice."""
    b = boundary.cast("bigint")
    extra = F.coalesce(b, F.lit(0))
    return [
        F.sum(F.col(f"{name}_n") + b.isNotNull().cast("bigint")).alias(f"{name}_n"),
        F.sum(F.col(f"{name}_s") + extra.cast("decimal(19,0)")).cast(WHOLE).alias(f"{name}_s"),
        F.sum(F.col(f"{name}_q") + _square(extra)).cast(WHOLE).alias(f"{name}_q"),
        F.max(F.greatest(F.col(f"{name}_max"), b)).alias(f"{name}_max"),
        F.min(F.least(F.col(f"{name}_min"), b)).alias(f"{name}_min"),
    ]


def _mean(name: str) -> Column:
    total, n = F.col(f"{name}_s").cast("double"), F.col(f"{name}_n").cast("double")
    return F.coalesce(F.try_divide(total, n), F.lit(0.0))


def _variance(name: str) -> Column:
    """Sample variance from count, sum and sum of squares; 0 below two values.

    All three are whole and n * q - s * s is exact, so regular gaps keep their small deviation.
    """
    n = F.col(f"{name}_n")
    total, squares = F.col(f"{name}_s").cast(WHOLE), F.col(f"{name}_q").cast(WHOLE)
    spread = ((n.cast("decimal(19,0)") * squares).cast(WHOLE) - (total * total).cast(WHOLE)).cast("double")
    pairs = n.cast("double") * (n.cast("double") - 1)
    return F.coalesce(F.try_divide(spread, F.nullif(pairs, F.lit(0.0))), F.lit(0.0))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("double")


def time_slices(df: DataFrame, keys: Sequence[str], ts: str, slice_seconds: float, sums: Sequence[str] = ()) -> DataFrame:
    """Per (key, slice): count, first and last time, summary of inner gaps, sums of columns."""
    width = int(slice_seconds * SECOND)
    timed = df.withColumn("_t", micros(ts)).withColumn("slice", F.floor(F.col("_t") / F.lit(width)).cast("bigint"))
    inner = F.col("_t") - F.lag("_t").over(Window.partitionBy(*keys, "slice").orderBy("_t"))
    return (
        timed.withColumn("_g", inner)
        .groupBy(*keys, "slice")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.min("_t").alias("first"),
            F.max("_t").alias("last"),
            *_gap_aggs(F.col("_g"), "iat"),
            *[F.sum(c).alias(c) for c in sums],
        )
    )


def iat_stats(df: DataFrame, keys: Sequence[str], ts: str, slice_seconds: float = 10.0) -> DataFrame:
    """Number, mean, deviation (sample), longest and shortest gap between events of a key, in seconds."""
    slices = time_slices(df, keys, ts, slice_seconds)
    in_order = Window.partitionBy(*keys).orderBy("slice")
    merged = (
        slices.withColumn("_b", F.col("first") - F.lag("last").over(in_order))
        .groupBy(*keys)
        .agg(F.sum("n").alias("events"), *_gap_merge("iat", F.col("_b")))
    )
    unit = F.lit(float(SECOND))
    return merged.select(
        *keys,
        "events",
        (_mean("iat") / unit).alias("iat_mean"),
        (F.sqrt(_variance("iat")) / unit).alias("iat_std"),
        (_zero("iat_max") / unit).alias("iat_max"),
        (_zero("iat_min") / unit).alias("iat_min"),
    )


def session_flows(
    df: DataFrame, keys: Sequence[str], ts: str, gap_seconds: float, sums: Sequence[str] = (), slice_seconds: float = 10.0
) -> DataFrame:
    """Sessions of each key, split where nothing happens for longer than the gap."""
    slices = time_slices(df, keys, ts, min(slice_seconds, gap_seconds), sums)
    in_order = Window.partitionBy(*keys).orderBy("slice")
    gap = F.col("first") - F.lag("last").over(in_order)
    marked = slices.withColumn("_new", F.when(gap <= int(gap_seconds * SECOND), 0).otherwise(1))
    numbered = marked.withColumn("session", F.sum("_new").over(in_order))
    return numbered.groupBy(*keys, "session").agg(
        F.sum("n").alias("events"),
        F.timestamp_micros(F.min("first")).alias("started"),
        F.timestamp_micros(F.max("last")).alias("ended"),
        ((F.max("last") - F.min("first")) / F.lit(float(SECOND))).alias("duration"),
        *[F.sum(c).alias(c) for c in sums],
    )


def time_sessions(df: DataFrame, keys: Sequence[str], ts: str, gap: str) -> DataFrame:
    """Sessions by the built-in session window; also usable on a stream with a watermark."""
    window = F.session_window(F.col(ts), gap)
    return df.groupBy(*keys, window).agg(F.count(F.lit(1)).alias("events"))


SIDES = ("a", "b")  # a: sent by the smaller endpoint, b: sent by the larger one


ENDS = ["end_a", "end_b"]
# Rows are dealt out by the ends only: a constant protocol vanishes from the keys of the steps that follow, and would
# no longer fit the partitions.
KEY = [*ENDS, "protocol"]
#: Packets, or slices of them, that a task sorts on average: a slice has about a hundred columns, several sorts are open at once.
TASK_ROWS = 100_000
ORDER = ["_t", "side", "length", "tcp_flags"]


def _sided(packets: DataFrame, width: int) -> DataFrame:
    """Packets with the two endpoints in order, the side that sent them, their time and its slice."""
    source = F.concat_ws(":", "src_ip", F.col("src_port").cast("string"))
    target = F.concat_ws(":", "dst_ip", F.col("dst_port").cast("string"))
    p = packets.withColumn("_t", micros("ts"))
    p = p.withColumn("side", F.when(source <= target, "a").otherwise("b"))
    p = p.withColumn("end_a", F.least(source, target)).withColumn("end_b", F.greatest(source, target))
    return p.withColumn("slice", F.floor(F.col("_t") / F.lit(width)).cast("bigint"))


BULK_SUMS = ("bulks", "packets", "bytes", "lasted")


def _bulk_sums(side: str, long_enough: Column) -> list[Column]:
    """Number, packets, bytes and duration of one side's runs that are bulks."""
    mine = (F.col("side") == side) & long_enough
    values = (F.lit(1), F.col("n"), F.col("bytes"), F.col("last") - F.col("first"))
    return [F.coalesce(F.sum(F.when(mine, v)), F.lit(0)).cast("bigint").alias(f"{name}_{side}") for name, v in zip(BULK_SUMS, values, strict=True)]


def _bulk_slices(p: DataFrame, gap: int, least: int) -> DataFrame:
    """Runs of payload packets per (key, slice): the runs at both ends, which may go on in other slices, and sums of the rest.

    A run ends where the other side sends payload or nothing is sent for longer than the gap.  `ends` holds one run if the
    slice has no other, else the first and the last.
    """
    key = [*KEY, "slice"]
    data = p.filter(F.col("payload_length") > 0).select(*key, *ORDER, "payload_length")
    in_order = Window.partitionBy(*key).orderBy(*ORDER)
    before, paused = F.lag("side").over(in_order), F.col("_t") - F.lag("_t").over(in_order)
    begins = F.when((before == F.col("side")) & (paused <= gap), 0).otherwise(1)
    runs = data.withColumn("_new", begins).withColumn("run", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    each = runs.groupBy(*key, "run").agg(
        F.min("side").alias("side"), F.count(F.lit(1)).alias("n"), F.sum(F.col("payload_length").cast("bigint")).alias("bytes"),
        F.min("_t").alias("first"), F.max("_t").alias("last"),
    )
    placed = each.withColumn("final", F.max("run").over(Window.partitionBy(*key)))
    inside = (F.col("run") > 1) & (F.col("run") < F.col("final"))
    end = F.struct("run", "side", "n", "bytes", "first", "last")
    return placed.groupBy(*key).agg(
        F.array_sort(F.collect_list(F.when(~inside, end))).alias("ends"),  # two at most
        *[c for s in SIDES for c in _bulk_sums(s, inside & (F.col("n") >= least))],
    )


def _bulks(p: DataFrame, sessions: DataFrame, gap: int, least: int, parts: int) -> DataFrame:
    """Sums of bulks per (key, session, side): a run that is open at the end of a slice goes on in the next one with data."""
    sliced = _bulk_slices(p, gap, least).join(sessions, [*KEY, "slice"])
    closed = sliced.groupBy(*KEY, "session").agg(*[F.sum(f"{c}_{s}").alias(f"{c}_{s}") for s in SIDES for c in BULK_SUMS])
    ends = sliced.select(*KEY, "session", "slice", F.posexplode("ends").alias("part", "e")).select(*KEY, "session", "slice", "part", "e.*")
    ends = ends.repartition(parts, *ENDS, "session")
    in_order = Window.partitionBy(*KEY, "session").orderBy("slice", "part")
    goes_on = (F.col("part") == 0) & (F.lag("side").over(in_order) == F.col("side")) & (F.col("first") - F.lag("last").over(in_order) <= gap)
    marked = ends.withColumn("_new", F.when(goes_on, 0).otherwise(1))
    whole = marked.withColumn("long_run", F.sum("_new").over(in_order)).groupBy(*KEY, "session", "long_run").agg(
        F.min("side").alias("side"), F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min("first").alias("first"), F.max("last").alias("last")
    )
    joined = whole.groupBy(*KEY, "session").agg(*[c for s in SIDES for c in _bulk_sums(s, F.col("n") >= least)])
    names = [f"{c}_{s}" for s in SIDES for c in BULK_SUMS]
    both = closed.unionByName(joined)
    return both.groupBy(*KEY, "session").agg(*[F.sum(n).alias(n) for n in names])


def _packet_slices(p: DataFrame) -> DataFrame:
    key, order = [*KEY, "slice"], ORDER
    p = p.withColumn("_g", F.col("_t") - F.lag("_t").over(Window.partitionBy(*key).orderBy(*order)))
    p = p.withColumn("_sg", F.col("_t") - F.lag("_t").over(Window.partitionBy(*key, "side").orderBy(*order)))

    def on(side: str, value: Column | str) -> Column:
        return F.when(F.col("side") == side, F.col(value) if isinstance(value, str) else value)

    def flag(bit: int) -> Column:
        return (F.col("tcp_flags").bitwiseAND(bit) != 0)

    payload = F.col("payload_length").cast("bigint")
    ends = F.struct("_t", "side", "src_ip", "src_port", "dst_ip", "dst_port")
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.min("_t").alias("first"),
        F.max("_t").alias("last"),
        F.min(ends).alias("opening"),
        *_gap_aggs(payload, "len"),
        F.count_if(F.col("_g") > SECOND).alias("pauses"),
        *_gap_aggs(F.col("_g"), "iat"),
    ]
    for name, bit in (("fin", FIN), ("syn", SYN), ("rst", RST), ("psh", PSH), ("ack", ACK), ("urg", URG), ("ece", ECE), ("cwr", CWR)):
        aggs.append(F.count_if(flag(bit)).alias(name))
    for s in SIDES:
        aggs += [
            F.min(on(s, "_t")).alias(f"first_{s}"),
            F.max(on(s, "_t")).alias(f"last_{s}"),
            *_gap_aggs(on(s, payload), f"len_{s}"),
            F.coalesce(F.sum(on(s, "header_length")), F.lit(0)).alias(f"head_{s}"),
            F.min(on(s, "header_length")).alias(f"seg_{s}"),
            F.count_if((F.col("side") == s) & flag(PSH)).alias(f"psh_{s}"),
            F.count_if((F.col("side") == s) & flag(URG)).alias(f"urg_{s}"),
            F.count_if((F.col("side") == s) & (payload > 0)).alias(f"data_{s}"),
            F.min(on(s, F.struct("_t", "win"))).alias(f"win_{s}"),
            *_gap_aggs(on(s, "_sg"), f"iat_{s}"),
        ]
    return p.groupBy(*key).agg(*aggs)


def flows_from_packets(
    packets: DataFrame,
    gap_seconds: float = 120.0,
    active_seconds: float = 5.0,
    slice_seconds: float = 1.0,
    bulk_seconds: float = 1.0,
    bulk_packets: int = 4,
) -> DataFrame:
    """Packets -> bidirectional flows with the columns of a flow file.

    A flow is a run of packets between two endpoints without a pause longer than the gap; its
    forward direction is that of its first packet.  Times are in microseconds, lengths are payload
    bytes, deviations are sample deviations.  An active period is a run without a pause longer than
    `active_seconds`, an idle period is such a pause.  A subflow ends at a pause of over a second.
    A bulk is a run of at least `bulk_packets` packets with payload from one side, without payload from
    the other side and without a pause longer than `bulk_seconds` between them; its averages are
    bytes and packets a bulk and bytes a second of bulks, cut to whole numbers.
    """
    width = int(min(gap_seconds, active_seconds, slice_seconds) * SECOND)
    # Partitions follow the number of packets, so that a task's sorts stay the same size on larger inputs.
    least = int(packets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-packets.count() // TASK_ROWS))
    sided = _sided(packets, width).repartition(parts, *ENDS, "slice")
    slices = _packet_slices(sided).repartition(parts, *ENDS)
    key = KEY
    in_order = Window.partitionBy(*key).orderBy("slice")
    gap = F.col("first") - F.lag("last").over(in_order)
    s = slices.withColumn("_gap", gap)
    split = F.col("_gap").isNull() | (F.col("_gap") > int(gap_seconds * SECOND))
    s = s.withColumn("session", F.sum(split.cast("int")).over(in_order))
    rested = split | (F.col("_gap") > int(active_seconds * SECOND))
    s = s.withColumn("run", F.sum(rested.cast("int")).over(in_order))
    s = s.withColumn("_b", F.when(~split, F.col("_gap")))
    earlier = Window.partitionBy(*key, "session").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    for side in SIDES:
        s = s.withColumn(f"_b{side}", F.col(f"first_{side}") - F.max(f"last_{side}").over(earlier))

    def add(*names: str) -> list[Column]:
        return [F.sum(n).alias(n) for n in names]

    def low(*names: str) -> list[Column]:
        return [F.min(n).alias(n) for n in names]

    def high(*names: str) -> list[Column]:
        return [F.max(n).alias(n) for n in names]

    flags = ["fin", "syn", "rst", "psh", "ack", "urg", "ece", "cwr"]
    plain = add("n", "len_n", "len_s", "len_q", *flags)
    plain += low("first", "opening", "len_min") + high("last", "len_max")
    for side in SIDES:
        plain += add(*[f"{c}_{side}" for c in ("head", "psh", "urg", "data")])
        plain += add(f"len_{side}_n", f"len_{side}_s", f"len_{side}_q")
        plain += low(f"len_{side}_min", f"seg_{side}", f"win_{side}") + high(f"len_{side}_max")

    gaps = ["iat", "iat_a", "iat_b"]
    runs = s.groupBy(*key, "session", "run").agg(
        *plain,
        F.sum(F.col("pauses") + F.coalesce((F.col("_b") > SECOND).cast("int"), F.lit(0))).alias("pauses"),
        F.max(F.when(rested, F.col("_b"))).alias("idle"),
        *_gap_merge("iat", F.col("_b")),
        *_gap_merge("iat_a", F.col("_ba")),
        *_gap_merge("iat_b", F.col("_bb")),
    )
    lasted = F.col("last") - F.col("first")
    flows = runs.groupBy(*key, "session").agg(
        *plain,
        *add("pauses", *[f"{g}_{x}" for g in gaps for x in ("n", "s", "q")]),
        *high(*[f"{g}_max" for g in gaps]),
        *low(*[f"{g}_min" for g in gaps]),
        *_gap_aggs(F.when(lasted > 0, lasted), "act"),
        *_gap_aggs(F.col("idle"), "rest"),
    )
    bulk = _bulks(sided, s.select(*key, "slice", "session"), int(bulk_seconds * SECOND), bulk_packets, parts)
    return _flow_columns(flows.join(bulk, [*key, "session"], "left"))


def _flow_columns(flows: DataFrame) -> DataFrame:
    forward_a = F.col("opening.side") == "a"

    def pick(name: str, forward: bool) -> Column:
        a, b = F.col(name.format("a")), F.col(name.format("b"))
        return F.when(forward_a, a).otherwise(b) if forward else F.when(forward_a, b).otherwise(a)

    stats = ("n", "s", "q", "max", "min")
    wide = flows.select(
        "*",
        *[pick("len_{}_" + x, True).alias(f"lf_{x}") for x in stats],
        *[pick("len_{}_" + x, False).alias(f"lb_{x}") for x in stats],
        *[pick("iat_{}_" + x, True).alias(f"if_{x}") for x in stats],
        *[pick("iat_{}_" + x, False).alias(f"ib_{x}") for x in stats],
        (F.col("last") - F.col("first")).cast("double").alias("duration"),
    )

    def rate(amount: Column) -> Column:
        return F.coalesce(F.try_divide(amount.cast("double") * SECOND, F.col("duration")), F.lit(0.0))

    def four(prefix: str, name: str) -> list[Column]:
        return [
            _zero(f"{name}_max").alias(f"{prefix} Max"),
            _zero(f"{name}_min").alias(f"{prefix} Min"),
            _mean(name).alias(f"{prefix} Mean"),
            F.sqrt(_variance(name)).alias(f"{prefix} Std"),
        ]

    def spell(prefix: str, name: str) -> list[Column]:
        return [
            _mean(name).alias(f"{prefix} Mean"),
            F.sqrt(_variance(name)).alias(f"{prefix} Std"),
            _zero(f"{name}_max").alias(f"{prefix} Max"),
            _zero(f"{name}_min").alias(f"{prefix} Min"),
        ]

    def per_subflow(c: str) -> Column:
        return F.coalesce(F.floor(F.try_divide(F.col(c).cast("double"), F.col("pauses").cast("double"))), F.lit(0)).cast("double")

    def number(c: Column) -> Column:
        return F.coalesce(c, F.lit(0)).cast("double")

    def bulk(forward: bool, amount: str, per: str, unit: int = 1) -> Column:
        total, n = pick(f"{amount}_{{}}", forward), pick(f"{per}_{{}}", forward)
        return F.coalesce(F.floor(F.try_divide((total * unit).cast("double"), F.nullif(n, F.lit(0)).cast("double"))), F.lit(0)).cast("double")

    bulks = [
        bulk(forward, amount, per, unit).alias(f"{d} {name} Avg")
        for d, forward in (("Fwd", True), ("Bwd", False))
        for name, amount, per, unit in (("Byts/b", "bytes", "bulks", 1), ("Pkts/b", "packets", "bulks", 1), ("Blk Rate", "bytes", "lasted", SECOND))
    ]
    ends = [F.col(f"opening.{c}").cast("string") for c in ("src_ip", "dst_ip", "src_port", "dst_port")]
    return wide.select(
        F.concat_ws("-", *ends, F.col("protocol").cast("string")).alias("Flow ID"),
        F.col("opening.src_ip").alias("Src IP"),
        F.col("opening.src_port").alias("Src Port"),
        F.col("opening.dst_ip").alias("Dst IP"),
        F.col("opening.dst_port").alias("Dst Port"),
        F.col("protocol").alias("Protocol"),
        F.date_format(F.timestamp_micros("first"), "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("Timestamp"),
        F.col("duration").alias("Flow Duration"),
        number(F.col("lf_n")).alias("Tot Fwd Pkts"),
        number(F.col("lb_n")).alias("Tot Bwd Pkts"),
        _zero("lf_s").alias("TotLen Fwd Pkts"),
        _zero("lb_s").alias("TotLen Bwd Pkts"),
        *four("Fwd Pkt Len", "lf"),
        *four("Bwd Pkt Len", "lb"),
        rate(F.col("len_s")).alias("Flow Byts/s"),
        rate(F.col("n")).alias("Flow Pkts/s"),
        *spell("Flow IAT", "iat"),
        _zero("if_s").alias("Fwd IAT Tot"),
        *spell("Fwd IAT", "if"),
        _zero("ib_s").alias("Bwd IAT Tot"),
        *spell("Bwd IAT", "ib"),
        number(pick("psh_{}", True)).alias("Fwd PSH Flags"),
        number(pick("psh_{}", False)).alias("Bwd PSH Flags"),
        number(pick("urg_{}", True)).alias("Fwd URG Flags"),
        number(pick("urg_{}", False)).alias("Bwd URG Flags"),
        number(pick("head_{}", True)).alias("Fwd Header Len"),
        number(pick("head_{}", False)).alias("Bwd Header Len"),
        rate(F.col("lf_n")).alias("Fwd Pkts/s"),
        rate(F.col("lb_n")).alias("Bwd Pkts/s"),
        _zero("len_min").alias("Pkt Len Min"),
        _zero("len_max").alias("Pkt Len Max"),
        _mean("len").alias("Pkt Len Mean"),
        F.sqrt(_variance("len")).alias("Pkt Len Std"),
        _variance("len").alias("Pkt Len Var"),
        *[number(F.col(c)).alias(f"{c.upper()} Flag Cnt") for c in ("fin", "syn", "rst", "psh", "ack", "urg")],
        number(F.col("cwr")).alias("CWE Flag Count"),
        number(F.col("ece")).alias("ECE Flag Cnt"),
        F.coalesce(F.try_divide(F.col("lb_n").cast("double"), F.col("lf_n").cast("double")), F.lit(0.0)).alias("Down/Up Ratio"),
        F.try_divide(F.col("len_s").cast("double"), F.col("n").cast("double")).alias("Pkt Size Avg"),
        _mean("lf").alias("Fwd Seg Size Avg"),
        _mean("lb").alias("Bwd Seg Size Avg"),
        *bulks,
        per_subflow("lf_n").alias("Subflow Fwd Pkts"),
        per_subflow("lf_s").alias("Subflow Fwd Byts"),
        per_subflow("lb_n").alias("Subflow Bwd Pkts"),
        per_subflow("lb_s").alias("Subflow Bwd Byts"),
        number(pick("win_{}.win", True)).alias("Init Fwd Win Byts"),
        number(pick("win_{}.win", False)).alias("Init Bwd Win Byts"),
        number(pick("data_{}", True)).alias("Fwd Act Data Pkts"),
        number(pick("seg_{}", True)).alias("Fwd Seg Size Min"),
        *spell("Active", "act"),
        *spell("Idle", "rest"),
    )
