"""Flows and alerts derived from the events table.

There are no captures among the driver tables, so each event stands for one flow: its user is the
source, its type the target, its day the capture file, and its probability is an integer rule that
both engines evaluate alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowwarden.bindings.registry import sql_round, table
from flowwarden.schema import BUCKETS
from flowwarden.session import local_column

HOSTS = {"click": "192.168.1.10", "view": "192.168.1.11", "error": "192.168.1.12", "signup": "192.168.1.13"}
OTHER_HOST = "192.168.1.14"
N_FILES = 5
THRESHOLD = 0.70


def flows(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    host = F
    for kind, address in HOSTS.items():
        host = host.when(F.col("event_type") == kind, address)
    user, event = F.col("user_id"), F.col("event_id")
    return e.select(
        "event_id",
        "ts",
        "user_id",
        F.concat(F.lit("10.0."), F.floor(user / 256).cast("string"), F.lit("."), (user % 256).cast("string")).alias("src_ip"),
        host.otherwise(OTHER_HOST).alias("dst_ip"),
        (1024 + event % 60000).cast("int").alias("src_port"),
        F.when(event % 3 == 0, 22).when(event % 2 == 0, 80).otherwise(443).alias("dst_port"),
        F.when(event % 3 == 0, 6).otherwise(17).alias("protocol"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("flow_ts"),
        F.col("value").alias("duration"),
        ((event * 7919 % 10001) / F.lit(10000.0)).alias("p"),
        F.concat(F.lit("capture_"), F.date_format("ts", "yyyyMMdd"), F.lit("_000000.pcap_Flow.csv")).alias("file"),
    )


_HOST_SQL = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in HOSTS.items())

FLOWS = f"""flows AS (
  SELECT event_id, ts, user_id,
         '10.0.' || (user_id // 256) || '.' || (user_id % 256) AS src_ip,
         CASE event_type {_HOST_SQL} ELSE '{OTHER_HOST}' END AS dst_ip,
         CAST(1024 + event_id % 60000 AS INTEGER) AS src_port,
         CASE WHEN event_id % 3 = 0 THEN 22 WHEN event_id % 2 = 0 THEN 80 ELSE 443 END AS dst_port,
         CASE WHEN event_id % 3 = 0 THEN 6 ELSE 17 END AS protocol,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS flow_ts,
         value AS duration,
         CAST(event_id * 7919 % 10001 AS DOUBLE) / 10000.0 AS p,
         'capture_' || strftime(ts, '%Y%m%d') || '_000000.pcap_Flow.csv' AS file,
         date_trunc('day', ts) AS capture_ts
  FROM events)"""

HITS = f"hits AS (SELECT * FROM flows WHERE p > 0.5 AND p >= {THRESHOLD})"

FILES = """files AS (
  SELECT file, any_value(capture_ts) AS capture_ts, count(*) AS flow_count,
         row_number() OVER (ORDER BY file) AS file_seq
  FROM flows GROUP BY file)"""

SLOTS = f"""slots AS (
  SELECT w.file_seq AS window_id, f.file, f.file_seq, f.flow_count, f.capture_ts
  FROM files w JOIN files f ON f.file_seq BETWEEN w.file_seq - {N_FILES - 1} AND w.file_seq)"""

FIXED_SLOTS = f"""slots AS (
  SELECT (file_seq - 1) // {N_FILES} + 1 AS window_id, file, file_seq, flow_count, capture_ts FROM files)"""

WINDOWS = """windows AS (
  SELECT window_id, string_agg(file, ',' ORDER BY file_seq) AS source_csvs, count(*) AS n_files,
         CAST(sum(flow_count) AS BIGINT) AS total_flows, max(capture_ts) AS window_ts
  FROM slots GROUP BY window_id)"""


def bucket_counts(prefix: str = "b") -> str:
    """Histogram columns of the hits `h` in SQL."""
    parts = []
    for i, (_, low, high) in enumerate(BUCKETS):
        end = f"p <= {high}" if i == len(BUCKETS) - 1 else f"p < {high}"
        parts.append(f"count(*) FILTER (WHERE p >= {low} AND {end}) AS {prefix}{i}")
    return ", ".join(parts)


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


CONFIDENCE = f"""{sql_round('sum(p) / count(*)', 4)} AS conf_avg, {sql_round('min(p)', 4)} AS conf_min,
  {sql_round('max(p)', 4)} AS conf_max, {bucket_counts()}"""

SEVERITY = """CASE WHEN total_flows >= 100 THEN 'CRITICAL' WHEN total_flows >= 50 THEN 'HIGH'
  WHEN total_flows >= 10 THEN 'MEDIUM' ELSE 'LOW' END"""


def flat_confidence() -> list:
    return [
        F.col("confidence.average").alias("conf_avg"),
        F.col("confidence.min").alias("conf_min"),
        F.col("confidence.max").alias("conf_max"),
        *[F.col("confidence.breakdown")[name].alias(f"b{i}") for i, (name, _, _) in enumerate(BUCKETS)],
    ]


# --- alerts for the block policy -------------------------------------------------------------

AS_OF = "2024-01-29 00:00:00"
EARLIER = "2024-01-20 00:00:00"
WHITELIST = ("10.0.0.5", "10.0.0.77", "10.0.0.16/28", "10.0.0.33/24", "10.0.9", "banana/8")


def whitelist(spark: SparkSession, entries=WHITELIST) -> DataFrame:
    return local_column(spark, "entry", list(entries))


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert per event with p >= 0.70; most users are kept out of the permanent tier."""
    f = flows(spark, sf_dir)
    units = F.col("event_id") * 7919 % 10001
    lowered = F.when((F.col("user_id") % 4 != 0) & (units >= 9500), units - 2000).otherwise(units)
    stamp = F.date_format("ts", "yyyyMMdd_HHmmss")
    return f.filter(units >= 7000).select(
        F.col("src_ip").alias("ip"),
        "ts",
        F.col("event_id").alias("alert_id"),
        (lowered / F.lit(10000.0)).alias("confidence"),
        (1 + F.col("event_id") % 120).alias("total_flows"),
        F.concat(F.lit("alert_"), F.replace("src_ip", F.lit("."), F.lit("_")), F.lit("_"), stamp, F.lit(".json")).alias(
            "alert_file"
        ),
    )


ALERTS = """alerts AS (
  SELECT src_ip AS ip, ts, event_id AS alert_id,
         CAST(CASE WHEN user_id % 4 <> 0 AND event_id * 7919 % 10001 >= 9500
              THEN event_id * 7919 % 10001 - 2000 ELSE event_id * 7919 % 10001 END AS DOUBLE) / 10000.0 AS confidence,
         1 + event_id % 120 AS total_flows,
         'alert_' || replace(src_ip, '.', '_') || '_' || strftime(ts, '%Y%m%d_%H%M%S') || '.json' AS alert_file
  FROM flows WHERE event_id * 7919 % 10001 >= 7000)"""

TIERED = """tiered AS (
  SELECT *, CASE tier WHEN '30min' THEN 1800 WHEN '8hours' THEN 28800 WHEN '24hours' THEN 86400 END AS dur,
         'ssh_block_' || tier AS alias
  FROM (SELECT *, CASE WHEN confidence < 0.70 THEN NULL WHEN confidence < 0.75 THEN '30min'
                       WHEN confidence < 0.85 THEN '8hours' WHEN confidence < 0.95 THEN '24hours'
                       ELSE 'permanent' END AS tier FROM alerts)
  WHERE tier IS NOT NULL)"""


def episode_ctes(as_of: str | None, suffix: str = "") -> str:
    """The block rule, alert by alert, in SQL."""
    bound = f"WHERE ts <= TIMESTAMP '{as_of}'" if as_of else ""
    s = suffix
    return f"""lagged{s} AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lag(dur) OVER w AS prev_dur
  FROM tiered {bound} WINDOW w AS (PARTITION BY ip ORDER BY ts, alert_id)),
flagged{s} AS (
  SELECT *, CASE WHEN prev_ts IS NULL THEN 1
                 WHEN prev_dur IS NOT NULL AND ts >= prev_ts + to_seconds(prev_dur) THEN 1 ELSE 0 END AS opens
  FROM lagged{s}),
counted{s} AS (
  SELECT *, sum(opens) OVER (PARTITION BY ip ORDER BY ts, alert_id ROWS UNBOUNDED PRECEDING) AS ep FROM flagged{s}),
lasting{s} AS (
  SELECT *, min(CASE WHEN opens = 1 AND tier = 'permanent' THEN ep END) OVER (PARTITION BY ip) AS perm FROM counted{s}),
acts{s} AS (
  SELECT *, row_number() OVER (PARTITION BY ip, episode ORDER BY ts, alert_id) AS attempt_count
  FROM (SELECT *, CAST(least(ep, coalesce(perm, ep)) AS BIGINT) AS episode FROM lasting{s})),
sizes{s} AS (SELECT ip, episode, max(attempt_count) AS n FROM acts{s} GROUP BY ip, episode),
episodes{s} AS (
  SELECT a.ip, a.episode, a.ts AS blocked_at, z.ts + to_seconds(z.dur) AS unblock_at, a.tier, a.alias,
         a.confidence AS confidence_avg, a.total_flows, a.alert_id, a.alert_file,
         CASE WHEN a.tier <> 'permanent' AND z.dur IS NOT NULL
                   {f"AND z.ts + to_seconds(z.dur) <= TIMESTAMP '{as_of}'" if as_of else ""}
              THEN 'closed' ELSE 'active' END AS status,
         s.n AS attempt_count, CASE WHEN s.n > 1 THEN z.ts END AS last_attempt
  FROM sizes{s} s
  JOIN acts{s} a ON a.ip = s.ip AND a.episode = s.episode AND a.attempt_count = 1
  JOIN acts{s} z ON z.ip = s.ip AND z.episode = s.episode AND z.attempt_count = s.n)"""


def whitelist_sql(entries=WHITELIST) -> str:
    """Whitelist, its valid IPv4 networks, and a macro-free number of an address, in SQL."""
    values = ", ".join(f"('{e}')" for e in entries)
    base = "split_part(entry, '/', 1)"
    return f"""wl(entry) AS (VALUES {values}),
nets AS (
  SELECT lo, lo + size - 1 AS hi FROM (
    SELECT {ip_number(base)} AS lo,
           CAST(pow(2, 32 - TRY_CAST(split_part(entry, '/', 2) AS INTEGER)) AS BIGINT) AS size
    FROM wl WHERE contains(entry, '/'))
  WHERE lo IS NOT NULL AND size IS NOT NULL AND lo % size = 0)"""


def ip_number(e: str) -> str:
    octet = "(0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
    parts = " + ".join(
        f"TRY_CAST(split_part({e}, '.', {i + 1}) AS BIGINT) * {256 ** (3 - i)}" for i in range(4)
    )
    return f"CASE WHEN regexp_full_match({e}, '{octet}(\\.{octet}){{3}}') THEN {parts} END"


def listed(ip: str) -> str:
    """SQL predicate: the address is whitelisted."""
    return (
        f"({ip_number(ip)} IS NOT NULL AND ({ip} IN (SELECT entry FROM wl WHERE NOT contains(entry, '/')) "
        f"OR EXISTS (SELECT 1 FROM nets WHERE {ip_number(ip)} BETWEEN lo AND hi)))"
    )
