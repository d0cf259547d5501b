"""Queries on sessions, packets, file inventories and file round trips."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from flowwarden.bindings import base as B
from flowwarden.bindings.registry import query, sql_round, sql_ts, table, text_ts
from flowwarden.functions import scalars as S
from flowwarden.functions.scalars import lines_to_list, list_to_lines, rounded
from flowwarden.operators import detect as D
from flowwarden.operators import packets as N
from flowwarden.operators import windows as W
from flowwarden.operators.blocks import to_block_alerts
from flowwarden.operators.positions import ordered_position
from flowwarden.plans.blocking import block
from flowwarden.plans.detection import detect
from flowwarden.schema import DetectConfig
from flowwarden.session import scratch_path
from flowwarden.sources import inventory as I
from flowwarden.sources import readers, writers
from flowwarden.sources import sweep
from flowwarden.sources.state import StateTable

GAP_HOURS = 6


def _events(spark, sf):
    return table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))


@query(
    "session_flows",
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {GAP_HOURS} HOURS THEN 0 ELSE 1 END AS n FROM events),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, CAST(session AS BIGINT) AS session, count(*) AS events, {sql_ts('min(ts)')} AS started, {sql_ts('max(ts)')} AS ended,
  {sql_round('(epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0', 4)} AS duration, {sql_round('sum(value)', 4)} AS value
FROM s GROUP BY user_id, session""",
)
def session_flows(spark, sf):
    s = N.session_flows(_events(spark, sf), ["user_id"], "ts", GAP_HOURS * 3600.0, sums=["value"])
    return s.select(
        "user_id", "session", "events", text_ts("started").alias("started"), text_ts("ended").alias("ended"),
        rounded("duration", 4).alias("duration"), rounded("value", 4).alias("value"),
    )


@query(
    "session_windows",
    f"""WITH g AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= INTERVAL {GAP_HOURS} HOURS THEN 0 ELSE 1 END AS n FROM events),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g)
SELECT user_id, {sql_ts('min(ts)')} AS started, {sql_ts(f'max(ts) + INTERVAL {GAP_HOURS} HOURS')} AS closes, count(*) AS events
FROM s GROUP BY user_id, session""",
)
def session_windows(spark, sf):
    s = N.time_sessions(_events(spark, sf), ["user_id"], "ts", f"{GAP_HOURS} hours")
    return s.select("user_id", text_ts("session_window.start").alias("started"), text_ts("session_window.end").alias("closes"), "events")


@query(
    "iat_stats",
    f"""WITH g AS (SELECT user_id, (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id))) / 1000000.0 AS gap FROM events)
SELECT user_id, count(*) AS events, {sql_round('coalesce(avg(gap), 0)', 3)} AS iat_mean, {sql_round('coalesce(stddev_samp(gap), 0)', 3)} AS iat_std,
  {sql_round('coalesce(max(gap), 0)', 3)} AS iat_max, {sql_round('coalesce(min(gap), 0)', 3)} AS iat_min FROM g GROUP BY user_id""",
)
def iat_stats(spark, sf):
    s = N.iat_stats(_events(spark, sf), ["user_id"], "ts")
    return s.select("user_id", "events", *[rounded(c, 3).alias(c) for c in ("iat_mean", "iat_std", "iat_max", "iat_min")])


PACKETS = """packets AS (
  SELECT event_id, epoch_us(ts) AS t, '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS user_ip,
         event_id % 3 <> 0 AS outbound, event_id % 1400 AS payload, 20 + 4 * (event_id % 3) AS header, event_id % 256 AS flags,
         event_id % 65536 AS win
  FROM events)"""

# Packets between a user (port 40000) and one server (port 22), in both directions.
HOUR_US = 3_600_000_000


def flat_name(name: str) -> str:
    """A column of a flow file as a name of this package's queries."""
    return re.sub("[^a-z0-9]+", "_", name.lower()).strip("_")


def _stats(prefix: str, value: str, where: str, seconds: bool = False) -> dict[str, str]:
    """Largest, smallest, mean and deviation in SQL; times in seconds."""
    kept = f" FILTER (WHERE {where})" if where else ""
    out = {k: f"coalesce({f}({value}){kept}, 0)" for k, f in (("Max", "max"), ("Min", "min"), ("Mean", "avg"), ("Std", "stddev_samp"))}
    wide = {k: f"CAST({e} AS DOUBLE)" for k, e in out.items() if k in ("Max", "Min")}
    fine = {k: sql_round(f"{e} / 1000000" if seconds else e, 2 if seconds else 4) for k, e in out.items() if k not in wide}
    return {f"{prefix} {k}": e for k, e in (wide | fine).items()}


def _count(where: str = "", of: str = "*") -> str:
    return f"CAST(count({of}){f' FILTER (WHERE {where})' if where else ''} AS DOUBLE)"


def _total(value: str, where: str) -> str:
    return f"CAST(coalesce(sum({value}) FILTER (WHERE {where}), 0) AS DOUBLE)"


def _per_second(amount: str) -> str:
    return sql_round(f"CASE WHEN max(t) > min(t) THEN ({amount}) * 1000000.0 / (max(t) - min(t)) ELSE 0 END", 6)


def packet_columns() -> dict[str, str]:
    """Every column of a flow file as an SQL aggregate over the packets `r` of a flow, joined with `act`, `lazy` and `bulk`."""
    sides = (("Fwd", "fwd"), ("Bwd", "NOT fwd"))
    user, server = "user_ip", "'192.168.1.10'"
    src, dst = f"CASE WHEN first_out THEN {user} ELSE {server} END", f"CASE WHEN first_out THEN {server} ELSE {user} END"
    sport, dport = "CASE WHEN first_out THEN 40000 ELSE 22 END", "CASE WHEN first_out THEN 22 ELSE 40000 END"
    c = {
        "Flow ID": f"{src} || '-' || {dst} || '-' || ({sport}) || '-' || ({dport}) || '-6'", "Src IP": src, "Src Port": sport, "Dst IP": dst,
        "Dst Port": dport, "Protocol": "6", "Timestamp": sql_ts("make_timestamp(min(t))"), "Flow Duration": "CAST(max(t) - min(t) AS DOUBLE)",
    }
    for d, where in sides:
        c |= {f"Tot {d} Pkts": _count(where), f"TotLen {d} Pkts": _total("payload", where)} | _stats(f"{d} Pkt Len", "payload", where)
        c |= {f"{d} IAT Tot": _total("side_gap", where)} | _stats(f"{d} IAT", "side_gap", where, True)
        c |= {f"{d} PSH Flags": _count(f"flags & 8 <> 0 AND {where}"), f"{d} URG Flags": _count(f"flags & 32 <> 0 AND {where}")}
        c |= {f"{d} Header Len": _total("header", where), f"{d} Pkts/s": _per_second(f"count(*) FILTER (WHERE {where})")}
        c |= {f"{d} Seg Size Avg": sql_round(f"coalesce(avg(payload) FILTER (WHERE {where}), 0)", 4)}
        c |= {f"Init {d} Win Byts": f"CAST(coalesce(arg_min(win, (t, event_id)) FILTER (WHERE {where}), 0) AS DOUBLE)"}
        pauses = "count(*) FILTER (WHERE inner_gap > 1000000)"
        for name, amount in (("Pkts", f"count(*) FILTER (WHERE {where})"), ("Byts", f"coalesce(sum(payload) FILTER (WHERE {where}), 0)")):
            c[f"Subflow {d} {name}"] = f"CAST(CASE WHEN {pauses} > 0 THEN floor(CAST({amount} AS DOUBLE) / {pauses}) ELSE 0 END AS DOUBLE)"
        for name, amount, per in (("Byts/b", "bytes", "bulks"), ("Pkts/b", "packets", "bulks"), ("Blk Rate", "1000000.0 * bytes", "lasted")):
            amount = amount.replace("bytes", f"{d}_bytes").replace("packets", f"{d}_packets")
            c[f"{d} {name} Avg"] = f"CAST(coalesce(any_value(CASE WHEN {d}_{per} > 0 THEN floor(CAST({amount} AS DOUBLE) / {d}_{per}) END), 0) AS DOUBLE)"
    c |= {"Flow Byts/s": _per_second("sum(payload)"), "Flow Pkts/s": _per_second("count(*)")} | _stats("Flow IAT", "inner_gap", "", True)
    c |= _stats("Pkt Len", "payload", "") | {"Pkt Len Var": sql_round("coalesce(var_samp(payload), 0)", 4)}
    for name, bit in (("FIN", 1), ("SYN", 2), ("RST", 4), ("PSH", 8), ("ACK", 16), ("URG", 32), ("ECE", 64)):
        c[f"{name} Flag Cnt"] = _count(f"flags & {bit} <> 0")
    c |= {"CWE Flag Count": _count("flags & 128 <> 0"), "Pkt Size Avg": sql_round("avg(payload)", 4)}
    c |= {"Down/Up Ratio": sql_round("count(*) FILTER (WHERE NOT fwd) / CAST(count(*) FILTER (WHERE fwd) AS DOUBLE)", 6)}
    c |= {"Fwd Act Data Pkts": _count("fwd AND payload > 0"), "Fwd Seg Size Min": "CAST(coalesce(min(header) FILTER (WHERE fwd), 0) AS DOUBLE)"}
    c |= _stats("Idle", "inner_gap", f"inner_gap > {HOUR_US}", True)
    for k in ("Max", "Min", "Mean", "Std"):
        value = f"coalesce(any_value(active_{k.lower()}), 0)"
        c[f"Active {k}"] = f"CAST({value} AS DOUBLE)" if k in ("Max", "Min") else sql_round(f"{value} / 1000000", 2)
    return c


_SIDE_BULKS = ", ".join(
    f"count(*) FILTER (WHERE {w}) AS {d}_bulks, coalesce(sum(n) FILTER (WHERE {w}), 0) AS {d}_packets, "
    f"coalesce(sum(bytes) FILTER (WHERE {w}), 0) AS {d}_bytes, coalesce(sum(lasted) FILTER (WHERE {w}), 0) AS {d}_lasted"
    for d, w in (("Fwd", "fwd"), ("Bwd", "NOT fwd"))
)
PACKET_FLOWS = f"""WITH {PACKETS},
g AS (SELECT *, t - lag(t) OVER w AS gap FROM packets WINDOW w AS (PARTITION BY user_ip ORDER BY t, event_id)),
s AS (SELECT *, sum(CASE WHEN gap <= {GAP_HOURS * HOUR_US} THEN 0 ELSE 1 END) OVER (PARTITION BY user_ip ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS session FROM g),
o AS (SELECT *, first_value(outbound) OVER (PARTITION BY user_ip, session ORDER BY t, event_id) AS first_out,
             CASE WHEN t > min(t) OVER (PARTITION BY user_ip, session) THEN gap END AS inner_gap FROM s),
d AS (SELECT *, outbound = first_out AS fwd,
             t - lag(t) OVER (PARTITION BY user_ip, session, outbound ORDER BY t, event_id) AS side_gap FROM o),
r AS (SELECT *, sum(CASE WHEN inner_gap > {HOUR_US} THEN 1 ELSE 0 END) OVER (PARTITION BY user_ip, session ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS run FROM d),
runs AS (SELECT user_ip, session, max(t) - min(t) AS lasted FROM r GROUP BY user_ip, session, run),
act AS (SELECT user_ip, session, {", ".join(f"{f}(lasted) FILTER (WHERE lasted > 0) AS active_{n}" for n, f in (("mean", "avg"), ("max", "max"), ("min", "min"), ("std", "stddev_samp")))}
        FROM runs GROUP BY user_ip, session),
pay AS (SELECT *, CASE WHEN lag(fwd) OVER w = fwd AND t - lag(t) OVER w <= {2 * HOUR_US} THEN 0 ELSE 1 END AS begins FROM d WHERE payload > 0
        WINDOW w AS (PARTITION BY user_ip, session ORDER BY t, event_id)),
burst AS (SELECT *, sum(begins) OVER (PARTITION BY user_ip, session ORDER BY t, event_id ROWS UNBOUNDED PRECEDING) AS b FROM pay),
bulks AS (SELECT user_ip, session, any_value(fwd) AS fwd, count(*) AS n, sum(payload) AS bytes, max(t) - min(t) AS lasted
          FROM burst GROUP BY user_ip, session, b HAVING count(*) >= 2),
bulk AS (SELECT user_ip, session, {_SIDE_BULKS} FROM bulks GROUP BY user_ip, session)
SELECT {", ".join(f"{e} AS {flat_name(n)}" for n, e in packet_columns().items())}
FROM r JOIN act USING (user_ip, session) LEFT JOIN bulk USING (user_ip, session) GROUP BY user_ip, session, first_out"""


def _packets(spark, sf):
    e = _events(spark, sf)
    event, user = F.col("event_id"), F.col("user_id")
    user_ip = F.concat(F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string"))
    out, server = event % 3 != 0, F.lit("192.168.1.10")
    return e.select(
        "ts",
        F.when(out, user_ip).otherwise(server).alias("src_ip"),
        F.when(out, 40000).otherwise(22).alias("src_port"),
        F.when(out, server).otherwise(user_ip).alias("dst_ip"),
        F.when(out, 22).otherwise(40000).alias("dst_port"),
        F.lit(6).alias("protocol"),
        (event % 1400 + 40).cast("int").alias("length"),
        (20 + 4 * (event % 3)).cast("int").alias("header_length"),
        (event % 1400).cast("int").alias("payload_length"),
        (event % 256).cast("int").alias("tcp_flags"),
        (event % 65536).cast("int").alias("win"),
    )


@query("packet_flows", PACKET_FLOWS)
def packet_flows(spark, sf):
    """Flows from packets with all columns of a flow file; two packets of one side within two hours are a bulk here."""
    f = N.flows_from_packets(
        _packets(spark, sf), gap_seconds=GAP_HOURS * 3600.0, active_seconds=3600.0, slice_seconds=60.0, bulk_seconds=7200.0, bulk_packets=2
    )

    def shown(name):
        c = F.col(f"`{name}`")
        timed = " IAT " in f" {name}" or name.startswith(("Active", "Idle"))
        if timed and name.endswith(("Mean", "Std")):
            return rounded(c / 1000000, 2)
        if name.endswith(("Mean", "Std", "Var", "Size Avg")):
            return rounded(c, 4)
        return rounded(c, 6) if name.endswith(("/s", "Ratio")) else c

    return f.select(*[shown(n).alias(flat_name(n)) for n in f.columns])


# One file per hour of events; odd hours are flow files, even hours captures.
INVENTORY = """inventory AS (
  SELECT '/data/' || CASE WHEN h % 2 = 0 THEN 'pcap' ELSE 'csv' END || '/capture_' || strftime(d, '%Y%m%d_%H') || '0000.pcap'
         || CASE WHEN h % 2 = 0 THEN '' ELSE '_Flow.csv' END AS path,
         n % 40 AS length, last AS mtime
  FROM (SELECT date_trunc('hour', ts) AS d, hour(date_trunc('hour', ts)) AS h, count(*) AS n, max(ts) AS last FROM events GROUP BY 1, 2))"""


def _inventory(spark, sf):
    hours = _events(spark, sf).groupBy(F.date_trunc("hour", "ts").alias("d")).agg(F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"))
    even = F.hour("d") % 2 == 0
    path = F.concat(
        F.lit("/data/"), F.when(even, "pcap").otherwise("csv"), F.lit("/capture_"), F.date_format("d", "yyyyMMdd_HH"), F.lit("0000.pcap"),
        F.when(even, "").otherwise("_Flow.csv"),
    )
    return hours.select(path.alias("path"), (F.col("n") % 40).alias("length"), F.col("last").alias("modificationTime"))


NOW = "2024-01-30 20:00:00"


def _now():
    return F.to_timestamp(F.lit(NOW))


@query(
    "retention_expired",
    f"""WITH {INVENTORY} SELECT path, length, {sql_ts('mtime')} AS mtime FROM inventory
WHERE path LIKE '%.csv' AND mtime < TIMESTAMP '{NOW}' - INTERVAL 30 MINUTES""",
)
def retention_expired(spark, sf):
    gone = I.expired_files(_inventory(spark, sf), _now(), 30, ["*.csv"])
    return gone.select("path", "length", text_ts("modificationTime").alias("mtime"))


@query(
    "settled_files",
    f"""WITH {INVENTORY}, n AS (SELECT *, max(mtime) OVER (PARTITION BY regexp_replace(path, '/[^/]*$', '')) AS newest FROM inventory)
SELECT path, length FROM n WHERE length >= 24 AND mtime <= TIMESTAMP '{NOW}' - INTERVAL 5 SECONDS AND mtime < newest""",
)
def settled_files(spark, sf):
    return I.settled_files(_inventory(spark, sf), _now()).select("path", "length")


@query(
    "alert_roundtrip",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS, B.WINDOWS)
    + f""", offsets AS (SELECT window_id, file, coalesce(sum(flow_count) OVER (PARTITION BY window_id ORDER BY file_seq
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM slots),
placed AS (SELECT event_id, row_number() OVER (PARTITION BY file ORDER BY event_id) - 1 AS row_pos FROM flows),
d AS (SELECT window_id, h.*, before + row_pos AS flow_index FROM hits h JOIN placed USING (event_id) JOIN offsets USING (file))
SELECT 'SSH_BF_' || replace(src_ip, '.', '') || '_' || strftime(window_ts, '%Y%m%d%H%M%S') AS alert_id, {sql_ts('window_ts')} AS alert_ts,
  src_ip AS attacker_ip, n_flows AS total_flows, conf_avg, conf_min, conf_max, b0, b1, b2, b3, b4, flow_list, n_targets, source_csvs
FROM (SELECT window_id, src_ip, count(*) AS n_flows, {B.CONFIDENCE}, count(DISTINCT (dst_ip, dst_port)) AS n_targets,
             string_agg(flow_index || ' ' || dst_ip || ' ' || src_port || ' ' || flow_ts, ';' ORDER BY flow_index) AS flow_list
      FROM d GROUP BY window_id, src_ip)
JOIN windows USING (window_id)""",
)
def alert_roundtrip(spark, sf):
    """Alert documents written as JSON and read back."""
    config = DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES)
    placed = ordered_position(B.flows(spark, sf), ["event_id"], ["file"], name="row_pos")
    placed = placed.withColumn("row_pos", F.col("row_pos") - 1)
    files = W.file_table(placed)
    found = D.hits(placed, config)
    windows = W.window_table(files, B.N_FILES)
    alerts = D.alerts_from(W.window_groups(found, files, B.N_FILES), windows, config)
    detail = W.flow_index(found, files, B.N_FILES)
    documents = writers.alert_documents(alerts, detail, W.window_targets(found, files, B.N_FILES, "row_pos"))
    path = scratch_path(spark, "alerts")
    writers.write_alerts(documents, path)
    back = readers.read_alerts(spark, path)

    def line(f):
        return F.concat_ws(" ", f["flow_index"].cast("string"), f["dst_ip"], f["src_port"].cast("string"), f["timestamp"])

    return back.select(
        "alert_id", text_ts("timestamp").alias("alert_ts"), "attacker_ip", "total_flows", *B.flat_confidence(),
        F.array_join(F.transform("flows", line), ";").alias("flow_list"), F.size("targets").cast("bigint").alias("n_targets"),
        F.array_join("source_csvs", ",").alias("source_csvs"),
    )


@query(
    "flow_csv_roundtrip",
    B.with_(B.FLOWS) + "SELECT src_ip, dst_ip, src_port, dst_port, protocol, flow_ts, duration, CAST(event_id AS DOUBLE) AS total_fwd_packets FROM flows",
)
def flow_csv_roundtrip(spark, sf):
    """Flows written as CSV files with the source header and read back."""
    f = B.flows(spark, sf)
    header = {"src_ip": "Src IP", "src_port": "Src Port", "dst_ip": "Dst IP", "dst_port": "Dst Port", "protocol": "Protocol",
              "flow_ts": "Timestamp", "duration": "Flow Duration", "event_id": "Tot Fwd Pkts"}
    path = scratch_path(spark, "flows")
    writers.write_flow_csv(f.select(*[F.col(k).alias(v) for k, v in header.items()]), path)
    back = readers.read_flows(spark, path, header=list(header.values()))
    total = F.col("`Tot Fwd Pkts`").cast("double").alias("total_fwd_packets")
    return back.select("src_ip", "dst_ip", "src_port", "dst_port", "protocol", "flow_ts", "duration", total)


BLOCK_ALERTS_SQL = (
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS, B.WINDOWS)
        + f"""SELECT 'SSH_BF_' || replace(src_ip, '.', '') || '_' || strftime(window_ts, '%Y%m%d%H%M%S') AS alert_id, src_ip AS ip,
      {sql_ts('window_ts')} AS alert_ts, conf_avg AS confidence, n_flows AS total_flows,
      'alert_' || replace(src_ip, '.', '_') || '_' || strftime(window_ts, '%Y%m%d_%H%M%S') || '.json' AS alert_file
    FROM (SELECT s.window_id, h.src_ip, count(*) AS n_flows, {B.CONFIDENCE} FROM hits h JOIN slots s ON h.file = s.file GROUP BY s.window_id, h.src_ip)
    JOIN windows USING (window_id)"""
)


@query("alerts_to_blocks", BLOCK_ALERTS_SQL)
def alerts_to_blocks(spark, sf):
    """Alerts to documents, some of them in several parts, read back as the block policy takes them: each alert once."""
    path = scratch_path(spark, "alerts")
    writers.write_alerts(_alert_parts(spark, sf), path)
    return _taken(readers.read_alerts(spark, path))


def _taken(documents):
    taken = to_block_alerts(documents)
    return taken.select("alert_id", "ip", text_ts("ts").alias("alert_ts"), "confidence", "total_flows", "alert_file")


def _alert_parts(spark, sf):
    config = DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES)
    placed = ordered_position(B.flows(spark, sf), ["event_id"], ["file"], name="row_pos")
    placed = placed.withColumn("row_pos", F.col("row_pos") - 1)
    files = W.file_table(placed)
    found = D.hits(placed, config)
    alerts = D.alerts_from(W.window_groups(found, files, B.N_FILES), W.window_table(files, B.N_FILES), config)
    targets = W.window_targets(found, files, B.N_FILES, "row_pos")
    return writers.alert_documents(alerts, W.flow_index(found, files, B.N_FILES), targets, part_rows=3)


@query("stream_alert_files", BLOCK_ALERTS_SQL)
def stream_alert_files(spark, sf):
    """The same documents as a stream of files, split by line."""
    root = scratch_path(spark, "alert-stream")
    writers.write_alerts(_alert_parts(spark, sf), f"{root}/inbox")
    stream = readers.stream_alerts(spark, f"{root}/inbox/*", by_line=True)
    writer = stream.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint")
    writer.trigger(availableNow=True).start().awaitTermination()
    return _taken(spark.read.schema(stream.schema).parquet(f"{root}/out"))


@query(
    "stats_roundtrip",
    B.with_(B.FLOWS, B.HITS, B.FILES, B.SLOTS, B.WINDOWS)
    + f"""SELECT window_id, 'window_' || n_files || '_csvs' AS csv_filename, total_flows, attack_flows, unique_attackers, unique_attackers AS in_maps,
  attack_flows AS map_flows, greatest(CAST(ceil(unique_attackers / 20.0) AS BIGINT), 1) AS parts, {sql_ts('window_ts')} AS stats_ts
FROM (SELECT s.window_id, count(*) AS attack_flows, count(DISTINCT src_ip) AS unique_attackers FROM hits h JOIN slots s ON h.file = s.file GROUP BY s.window_id)
JOIN windows USING (window_id)""",
)
def stats_roundtrip(spark, sf):
    """Statistics documents in parts, written as JSON and read back: together the maps hold every attacker and hit."""
    flows = B.flows(spark, sf)
    config = DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES)
    files = W.file_table(flows)
    groups, windows = W.window_groups(D.hits(flows, config), files, B.N_FILES), W.window_table(files, B.N_FILES)
    kept = W.existing_windows(groups, windows)
    path = scratch_path(spark, "stats")
    for _ in range(2):  # a window that is written again replaces itself
        writers.write_stats(writers.stats_documents(D.window_stats(kept, windows, config), D.window_attackers(kept), part_rows=20), path)
    schema = "window_id bigint, timestamp timestamp, csv_filename string, total_flows bigint, attack_flows bigint, unique_attackers bigint, attackers map<string,bigint>"
    back = spark.read.schema(schema).json(path)
    hits = F.aggregate(F.coalesce(F.map_values("attackers"), F.array().cast("array<bigint>")), F.lit(0).cast("bigint"), lambda a, x: a + x)
    return back.groupBy("window_id", "csv_filename", "total_flows", "attack_flows", "unique_attackers", text_ts("timestamp").alias("stats_ts")).agg(
        F.sum(F.size("attackers")).alias("in_maps"), F.sum(hits).alias("map_flows"), F.count(F.lit(1)).alias("parts")
    )


@query(
    "nothing_found",
    """SELECT 'files' AS what, count(DISTINCT date_trunc('day', ts)) AS n FROM events
UNION ALL SELECT w, count(*) FILTER (WHERE event_id < 0) FROM events, (VALUES ('alerts'), ('stats'), ('episodes'), ('aliases'), ('no files')) t(w) GROUP BY w""",
)
def nothing_found(spark, sf):
    """Files without a hit give windows and nothing else, and no flows at all give no files."""
    flows, config = B.flows(spark, sf), DetectConfig(threshold=B.THRESHOLD, window_files=B.N_FILES)
    run = detect(flows.withColumn("p", F.lit(0.0)), config)
    none = detect(flows.filter("event_id < 0"), config)
    now = F.to_timestamp(F.lit(NOW))
    policy = block(to_block_alerts(run.alerts), B.whitelist(spark), now, now)
    parts = {"files": run.files, "alerts": run.alerts, "stats": run.stats, "episodes": policy.episodes, "aliases": policy.active, "no files": none.files}
    counts = [df.agg(F.lit(what).alias("what"), F.count(F.lit(1)).alias("n")) for what, df in parts.items()]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


MIXED = {"Src IP": "src_ip", "Dst Port": "dst_port", "Protocol": "protocol", "Flow Duration": "duration", "Tot Fwd Pkts": "event_id"}
MIXED_SQL = B.with_(B.FLOWS) + """SELECT event_id, src_ip, CASE WHEN event_id % 5 = 1 THEN 0 ELSE dst_port END AS dst_port, protocol, duration,
  CASE WHEN event_id % 5 = 2 THEN CASE WHEN event_id % 3 = 0 THEN 'Protocol' ELSE 'more, or "less"' END END AS extra FROM flows"""


def write_mixed(f, path):
    """Flow files with five headers: another order, a column that is absent, one that is not known (with values that
    are a name of the format, or hold a comma and quotes), quoted names, and a byte order mark."""
    names = list(MIXED)
    orders = [names, [n for n in reversed(names) if n != "Dst Port"], ["Extra", *names[2:], *names[:2]], names, names[::-1]]
    more = F.when(F.col("event_id") % 3 == 0, "Protocol").otherwise('more, or "less"')
    for part, order in enumerate(orders):
        rows = f.filter(F.col("event_id") % 5 == part).withColumn("more", more)
        out = rows.select(*[F.col(MIXED.get(n, "more")).alias(("\ufeff" if part == 4 and not i else "") + n) for i, n in enumerate(order)])
        out.write.option("header", True).option("quoteAll", part == 3).option("escape", '"').csv(f"{path}/{part}")


def mixed_rows(back):
    event = F.col("`Tot Fwd Pkts`").cast("bigint").alias("event_id")
    return back.select(event, "src_ip", "dst_port", "protocol", "duration", F.col("Extra").alias("extra"))


@query("mixed_headers", MIXED_SQL)
def mixed_headers(spark, sf):
    """Flow files with five headers, each read by its first line."""
    path = scratch_path(spark, "mixed")
    write_mixed(B.flows(spark, sf), path)
    return mixed_rows(readers.read_flows(spark, f"{path}/*"))


@query(
    "two_sensors",
    B.with_(B.FLOWS)
    + """, named AS (SELECT event_id % 2 AS sensor, file, count(*) AS flow_count FROM flows GROUP BY 1, 2),
seq AS (SELECT *, row_number() OVER (ORDER BY file, sensor) AS file_seq FROM named)
SELECT sensor, file, file_seq, flow_count FROM seq""",
)
def two_sensors(spark, sf):
    """Files of two sensors with the same base names stay apart: the full path is their identity."""
    f = B.flows(spark, sf).withColumn("sensor", F.col("event_id") % 2)
    full = F.concat(F.lit("/sensor"), F.col("sensor").cast("string"), F.lit("/"), F.col("file"))
    files = W.file_table(f.withColumn("file", full))
    sensor = F.substring("file", 8, 1).cast("bigint").alias("sensor")
    return files.select(sensor, F.element_at(F.split("file", "/"), -1).alias("file"), "file_seq", "flow_count")


@query(
    "iat_regular",
    f"""WITH t AS (SELECT event_id % 7 AS k, event_id, event_id * 60000000 + event_id * 7919 % 11 AS us FROM events),
g AS (SELECT k, us - lag(us) OVER (PARTITION BY k ORDER BY event_id) AS gap FROM t)
SELECT k, count(*) AS events, {sql_round('avg(gap)', 3)} AS mean_us, {sql_round('stddev_samp(gap)', 3)} AS std_us,
  CAST(max(gap) AS DOUBLE) AS max_us, CAST(min(gap) AS DOUBLE) AS min_us FROM g GROUP BY k""",
)
def iat_regular(spark, sf):
    """Gaps of seven minutes that differ by microseconds: their small deviation is not lost."""
    e = table(spark, sf, "events").select("event_id", (F.col("event_id") % 7).alias("k"))
    timed = e.withColumn("ts", F.timestamp_micros(F.col("event_id") * 60_000_000 + F.col("event_id") * 7919 % 11))
    stats = N.iat_stats(timed, ["k"], "ts")
    micro = [rounded(F.col(f"iat_{a}") * 1e6, 3).alias(f"{b}_us") for a, b in (("mean", "mean"), ("std", "std"), ("max", "max"), ("min", "min"))]
    return stats.select("k", "events", *micro)


@query(
    "state_and_history",
    """WITH e AS (SELECT user_id, min(event_id) AS a, max(event_id) AS b FROM events GROUP BY user_id)
SELECT '10.0.0.' || user_id AS ip, CASE WHEN user_id % 2 = 0 THEN b ELSE a END AS attempt_count, CAST(1 AS BIGINT) AS history_rows FROM e WHERE user_id % 5 <> 0""",
)
def state_and_history(spark, sf):
    """State saved, read back, upserted and closed; history of a batch written twice counts once."""
    users = _events(spark, sf).groupBy("user_id").agg(F.min("event_id").alias("a"), F.max("event_id").alias("b"))
    ip = F.concat(F.lit("10.0.0."), F.col("user_id").cast("string")).alias("ip")
    root = scratch_path(spark, "state")
    schema = "ip string, attempt_count bigint"
    writers.save_state(users.select(ip, F.col("a").alias("attempt_count")), root, 1)
    state = writers.load_state(spark, root, 1, schema)
    changed = writers.upsert_state(state, users.filter("user_id % 2 = 0").select(ip, F.col("b").alias("attempt_count")))
    writers.save_state(changed, root, 2)
    gone = users.filter("user_id % 5 = 0").select(ip)
    left = writers.close_blocks(writers.load_state(spark, root, 2, schema), gone)
    history = left.select("ip", F.lit("202401").alias("month"))
    for _ in range(2):
        writers.append_history(history, f"{root}/history", "run-1")
    rows = readers.read_table(spark, f"{root}/history", "ip string, month string").groupBy("ip").agg(F.count(F.lit(1)).alias("history_rows"))
    return left.join(rows, "ip").select("ip", "attempt_count", "history_rows")


@query("whitelist_file", "SELECT c_name AS entry, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS reason FROM customer")
def whitelist_file(spark, sf):
    """A whitelist written as documents of one entry and read back; an absent file is an empty list."""
    c = table(spark, sf, "customer")
    reason = F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))
    path = scratch_path(spark, "whitelist")
    writers.write_whitelist(c.select(F.col("c_name").alias("entry"), reason.alias("reason")), path)
    found = readers.read_whitelist(spark, path).unionByName(readers.read_whitelist(spark, f"{path}-absent"))
    return found.select("entry", "reason")


@query(
    "left_window_files",
    B.with_(B.FLOWS, B.FILES) + f"SELECT file FROM files WHERE file_seq <= (SELECT max(file_seq) FROM files) - {B.N_FILES}",
)
def left_window_files(spark, sf):
    """Processed files that the newest window no longer holds."""
    files = W.file_table(B.flows(spark, sf))
    newest = files.agg(F.max("file_seq").alias("top"))
    window = files.filter(F.col("file_seq") > newest.scalar() - B.N_FILES)
    return I.left_window(files, window)


@query(
    "text_lines",
    """SELECT item_id, len(l) AS n_lines, array_to_string(l, chr(10)) AS lines
FROM (SELECT item_id, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM benchmark)""",
)
def text_lines(spark, sf):
    """Alias text to its entries and back."""
    items = table(spark, sf, "benchmark").withColumn("l", lines_to_list("text"))
    return items.select("item_id", F.size("l").cast("bigint").alias("n_lines"), list_to_lines("l").alias("lines"))


STATE_BATCHES = 8
STATE_SQL = f"""WITH e AS (SELECT user_id, event_id, CAST(dayofyear(ts) * {STATE_BATCHES} // 31 AS BIGINT) AS batch FROM events),
b AS (SELECT user_id, batch, max(event_id) AS newest, count(*) AS n FROM e WHERE (user_id + batch) % 3 <> 0 GROUP BY user_id, batch),
z AS (SELECT user_id, max(batch) AS batch FROM b GROUP BY user_id)
SELECT '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS ip, batch, newest, n FROM b JOIN z USING (user_id, batch) WHERE newest % 7 <> 0"""


@query("state_many_batches", STATE_SQL)
def state_many_batches(spark, sf):
    """State after many batches of new, replaced and leaving rows, compacted in between; one batch is written twice."""
    batch = F.floor(F.dayofyear("ts") * STATE_BATCHES / 31).cast("bigint")
    user = F.col("user_id")
    ip = F.concat(F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string"))
    e = _events(spark, sf).select(user, ip.alias("ip"), "event_id", batch.alias("batch")).filter((user + F.col("batch")) % 3 != 0)
    sums = e.groupBy("ip", "batch").agg(F.max("event_id").alias("newest"), F.count(F.lit(1)).alias("n"))
    state = StateTable(spark, scratch_path(spark, "state"), "ip string, batch bigint, newest bigint, n bigint", buckets=16)
    for b in [r["batch"] for r in sums.select("batch").distinct().orderBy("batch").collect()]:  # a few batches, by the calendar
        mine = sums.filter(F.col("batch") == b)
        for _ in range(2 if b == 3 else 1):
            state.apply(b, mine.filter("newest % 7 <> 0"), mine.filter("newest % 7 = 0").select("ip"))
        if b % 3 == 2:
            state.compact(least=2)
    return state.read()


SWEEP_POLICIES = (("csv", 30 * 24 * 60), ("pcap", 20 * 24 * 60))
SWEEP_SQL = f"""WITH {INVENTORY}, f AS (SELECT *, CASE WHEN path LIKE '%.csv' THEN 'csv' ELSE 'pcap' END AS folder FROM inventory),
j AS (SELECT *, CASE WHEN folder = 'csv' THEN mtime < TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAYS ELSE mtime < TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 20 DAYS END AS old,
  folder = 'csv' AND hour(mtime) >= 12 AS moves FROM f)
SELECT folder, count(*) FILTER (WHERE old) AS deleted, count(*) FILTER (WHERE NOT old AND moves) AS moved, count(*) FILTER (WHERE NOT old AND NOT moves) AS kept,
  CAST(0 AS BIGINT) AS again FROM j GROUP BY folder"""


@query("archive_and_retention", SWEEP_SQL)
def archive_and_retention(spark, sf):
    """Real files, one an hour of events: old ones are deleted by folder, others archived; a second run changes nothing."""
    root = scratch_path(spark, "sweep")
    listed = _inventory(spark, sf).withColumn("folder", F.when(F.col("path").endswith(".csv"), "csv").otherwise("pcap"))
    named = listed.select(F.lit("x").alias("value"), "folder", S.base_name("path").alias("name"))
    named.write.partitionBy("folder", "name").text(f"{root}/data")
    name = F.regexp_extract("path", "/name=([^/]+)/", 1)
    times = listed.select(S.base_name("path").alias("name"), F.col("modificationTime").alias("seen"))

    def now_there():
        # A folder stands for a file's name; what it is told of its age comes from the events.
        files = I.file_inventory(spark, f"{root}/data/*/*").withColumn("name", name).join(times, "name")
        return files.select("path", "length", F.col("seen").alias("modificationTime"), "name")

    folder = F.regexp_extract("path", "/folder=([^/]+)/", 1)
    base = f"{root}/data".removeprefix("file:")
    policies = [sweep.Policy(f, f"{base}/folder={f}", ("part-*",), minutes) for f, minutes in SWEEP_POLICIES]
    now = F.to_timestamp(F.lit("2024-02-10 00:00:00"))
    runs = []
    for again in (0, 1):
        gone = sweep.carry_out(sweep.retention_plan(now_there(), now, policies), f"{root}/journal/delete-{again}")
        late = now_there().filter((folder == "csv") & (F.hour("modificationTime") >= 12))
        moves = sweep.archive_plan(late, f"{root}/archive").withColumn("target", F.concat(F.lit(f"{root}/archive/"), name))
        runs.append(gone.unionByName(sweep.carry_out(moves, f"{root}/journal/move-{again}")).withColumn("folder", folder))
    done = F.col("outcome") == "done"
    first = runs[0].groupBy("folder").agg(F.count_if(done & (F.col("action") == "delete")).alias("deleted"), F.count_if(done & (F.col("action") == "move")).alias("moved"))
    left = I.file_inventory(spark, f"{root}/data/*/*").groupBy(folder.alias("folder")).agg(F.count(F.lit(1)).alias("kept"))
    second = runs[1].groupBy("folder").agg(F.count_if(done).alias("again"))
    both = first.join(left, "folder", "full").join(second, "folder", "left")
    return both.select("folder", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("deleted", "moved", "kept", "again")])
