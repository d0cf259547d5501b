"""Queries on the whitelist, block episodes, history, counters and lists."""

from __future__ import annotations

from pyspark.sql import functions as F

from flowwarden.bindings import base as B
from flowwarden.bindings.registry import query, sql_round, sql_ts, table, text_ts
from flowwarden.functions import netaddr as N
from flowwarden.functions import scalars as S
from flowwarden.operators import blocks as K
from flowwarden.operators import retry as R
from flowwarden.operators import whitelist as L

CUSTOMER_LIST = ("10.0.0.5", "10.0.1.77", "10.0.2.16/28", "10.0.0.33/24", "10.0.4.0/22", "10.0.1.9/32", "10.0.3.0/255.255.255.240")

ADDRESSES = """addresses AS (
  SELECT c_custkey, CASE WHEN c_custkey % 97 = 0 THEN '10.0.0.999'
         ELSE '10.' || (c_custkey // 65536) || '.' || (c_custkey // 256 % 256) || '.' || (c_custkey % 256) END AS ip
  FROM customer)"""


def _addresses(spark, sf):
    key = F.col("c_custkey")
    parts = [F.floor(key / 65536), F.floor(key / 256) % 256, key % 256]
    text = F.concat_ws(".", F.lit("10"), *[p.cast("string") for p in parts])
    return table(spark, sf, "customer").select("c_custkey", F.when(key % 97 == 0, "10.0.0.999").otherwise(text).alias("ip"))


def _customer_list_sql() -> str:
    # The netmask form is written as a prefix length here.
    return B.whitelist_sql(tuple(e.replace("/255.255.255.240", "/28") for e in CUSTOMER_LIST))


@query("whitelist_antijoin", B.with_(ADDRESSES, _customer_list_sql()) + f"SELECT c_custkey, ip FROM addresses WHERE NOT {B.listed('ip')}")
def whitelist_antijoin(spark, sf):
    return L.whitelist_antijoin(_addresses(spark, sf), B.whitelist(spark, CUSTOMER_LIST))


@query("whitelist_skipped", B.with_(ADDRESSES, _customer_list_sql()) + f"SELECT c_custkey, ip FROM addresses WHERE {B.listed('ip')}")
def whitelist_skipped(spark, sf):
    return L.whitelist_skipped(_addresses(spark, sf), B.whitelist(spark, CUSTOMER_LIST))


@query(
    "address_numbers",
    B.with_(ADDRESSES)
    + f"""SELECT c_custkey, ip, coalesce({B.ip_number('ip')}, -1) AS ip_num, {B.ip_number('ip')} IS NOT NULL AS valid,
  coalesce({B.ip_number('ip')} BETWEEN 167773184 AND 167774207, false) AS in_net FROM addresses""",
)
def address_numbers(spark, sf):
    a = _addresses(spark, sf)
    net = N.ip_in_cidr("ip", F.lit("10.0.4.0/22"))
    return a.select("c_custkey", "ip", F.coalesce(N.ip_to_num("ip"), F.lit(-1)).alias("ip_num"), N.is_valid_ip("ip").alias("valid"), net.alias("in_net"))


INTAKE = f"""intake AS (
  SELECT *, CASE WHEN {B.ip_number('ip')} IS NULL OR confidence IS NULL THEN 'invalid'
                 WHEN confidence < 0.70 THEN 'below_threshold'
                 WHEN {B.listed('ip')} THEN 'whitelisted' ELSE 'accepted' END AS status
  FROM (SELECT event_id, ts, CASE WHEN event_id % 53 = 0 THEN NULL WHEN event_id % 59 = 0 THEN 'unknown' ELSE src_ip END AS ip,
               CASE WHEN event_id % 61 = 0 THEN NULL
                    WHEN event_id % 5 = 0 THEN CAST(event_id * 7919 % 10001 - 3000 AS DOUBLE) / 10000.0
                    ELSE p END AS confidence
        FROM flows))"""


def _intake(spark, sf):
    f = B.flows(spark, sf)
    e = F.col("event_id")
    ip = F.when(e % 53 == 0, F.lit(None).cast("string")).when(e % 59 == 0, "unknown").otherwise(F.col("src_ip"))
    low = (e * 7919 % 10001 - 3000) / F.lit(10000.0)
    conf = F.when(e % 61 == 0, F.lit(None).cast("double")).when(e % 5 == 0, low).otherwise(F.col("p"))
    alerts = f.select("event_id", "ts", ip.alias("ip"), conf.alias("confidence"))
    return K.alert_intake(alerts, B.whitelist(spark))


# Both families for every customer, and a list that grows with them: addresses and networks of many lengths.
LONG_LIST = f"""c AS (SELECT c_custkey AS k, c_custkey // 256 AS hi, c_custkey % 256 AS lo FROM customer),
a AS (SELECT k, hi, lo, '10.' || (hi // 256) || '.' || (hi % 256) || '.' || lo AS v4,
        '2001:db8:0:0:0:0:' || format('{{:x}}', hi) || ':' || format('{{:x}}', lo) AS v6 FROM c),
wl AS (SELECT CASE WHEN k % 32 = 3 THEN '10.' || (hi // 256) || '.' || (hi % 256) || '.' || (lo - lo % 8) || '/29'
               WHEN k % 97 = 5 THEN '10.' || (hi // 256) || '.' || (hi % 256) || '.' || (lo - lo % 64) || '/26' WHEN k % 5 = 0 THEN v4 END AS entry FROM a),
nets AS (SELECT lo, lo + size - 1 AS hi FROM (
    SELECT {B.ip_number("split_part(entry, '/', 1)")} AS lo, CASE split_part(entry, '/', 2) WHEN '29' THEN 8 WHEN '26' THEN 64 ELSE 1 END AS size FROM wl)),
six AS (SELECT DISTINCT hi FROM a WHERE k % 1000 = 300)
SELECT k AS c_custkey, 4 AS family, EXISTS (SELECT 1 FROM nets WHERE {B.ip_number("v4")} BETWEEN nets.lo AND nets.hi) AS whitelisted FROM a
UNION ALL SELECT k, 6, k % 11 = 0 OR hi IN (SELECT hi FROM six) FROM a"""


@query("whitelist_long", "WITH " + LONG_LIST)
def whitelist_long(spark, sf):
    """A whitelist of thousands of IPv4 and IPv6 entries against all addresses of both families."""
    k = F.col("c_custkey")
    hi, lo = F.floor(k / 256), k % 256
    def low(c):
        return F.lower(F.hex(c))

    def v4(last):
        return F.concat_ws(".", F.lit("10"), F.floor(hi / 256).cast("string"), (hi % 256).cast("string"), last.cast("string"))

    def v6(last):
        return F.concat(F.lit("2001:db8:0:0:0:0:"), low(hi), F.lit(":"), last)

    keys = table(spark, sf, "customer").select("c_custkey")
    net4 = F.when(k % 32 == 3, F.concat(v4(lo - lo % 8), F.lit("/29"))).when(k % 97 == 5, F.concat(v4(lo - lo % 64), F.lit("/26"))).when(k % 5 == 0, v4(lo))
    net6 = F.when(k % 1000 == 300, v6(F.lit("0/112")))
    entries = keys.select(F.explode(F.array(net4, net6, F.when(k % 11 == 0, v6(low(lo))))).alias("entry"))
    both = F.inline(F.array(F.struct(F.lit(4).alias("family"), v4(lo).alias("ip")), F.struct(F.lit(6).alias("family"), v6(low(lo)).alias("ip"))))
    return L.flag_whitelisted(keys.select("c_custkey", both), entries).drop("ip")


@query("alert_intake", B.with_(B.FLOWS, B.whitelist_sql(), INTAKE) + "SELECT event_id, ip, confidence, status FROM intake")
def alert_intake(spark, sf):
    return _intake(spark, sf).select("event_id", "ip", "confidence", "status")


@query(
    "block_tiers",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED)
    + f"SELECT alert_id, ip, confidence, tier, alias, {sql_ts('ts + to_seconds(dur)')} AS unblock_at FROM tiered",
)
def block_tiers(spark, sf):
    out = K.block_tiers(B.alerts(spark, sf))
    return out.select("alert_id", "ip", "confidence", "tier", "alias", text_ts("unblock_at").alias("unblock_at"))


@query(
    "block_actions",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED, B.episode_ctes(None))
    + f"""SELECT ip, {sql_ts('ts')} AS ts, alert_id, tier, episode, CASE WHEN attempt_count = 1 THEN 'block' ELSE 'reset' END AS action,
  attempt_count, {sql_ts('ts + to_seconds(dur)')} AS unblock_at FROM acts""",
)
def block_actions(spark, sf):
    out = K.block_actions(B.alerts(spark, sf))
    return out.select(
        "ip", text_ts("ts").alias("ts"), "alert_id", "tier", "episode", "action", "attempt_count", text_ts("unblock_at").alias("unblock_at")
    )


def _as_of(text: str = B.AS_OF):
    return F.to_timestamp(F.lit(text))


def _episodes(spark, sf, as_of: str = B.AS_OF):
    return K.block_episodes(B.alerts(spark, sf), as_of=_as_of(as_of))


EPISODES = B.with_(B.FLOWS, B.ALERTS, B.TIERED, B.episode_ctes(B.AS_OF))
STATE_COLUMNS = f"""ip, {sql_ts('blocked_at')} AS blocked_at, {sql_ts('unblock_at')} AS unblock_at, tier, alias, confidence_avg,
  total_flows, alert_id, alert_file, status, attempt_count, {sql_ts('last_attempt')} AS last_attempt"""


def _state(df):
    times = {"blocked_at", "unblock_at", "last_attempt"}
    names = ["ip", "blocked_at", "unblock_at", "tier", "alias", "confidence_avg", "total_flows", "alert_id", "alert_file",
             "status", "attempt_count", "last_attempt"]
    return [text_ts(c).alias(c) if c in times else F.col(c) for c in names]


@query("block_episodes", EPISODES + f"SELECT episode, {STATE_COLUMNS} FROM episodes")
def block_episodes(spark, sf):
    out = _episodes(spark, sf)
    return out.select("episode", *_state(out))


@query("active_blocks", EPISODES + f"SELECT {STATE_COLUMNS} FROM episodes WHERE status = 'active'")
def active_blocks(spark, sf):
    out = K.active_blocks(_episodes(spark, sf))
    return out.select(*_state(out))


@query(
    "block_history",
    EPISODES
    + f"""SELECT strftime(unblock_at, '%Y%m') AS month, ip, {sql_ts('blocked_at')} AS blocked_at, {sql_ts('unblock_at')} AS unblocked_at,
  tier, confidence_avg, total_flows, attempt_count AS attempts FROM episodes WHERE status = 'closed'""",
)
def block_history(spark, sf):
    h = K.block_history(_episodes(spark, sf))
    return h.withColumn("blocked_at", text_ts("blocked_at")).withColumn("unblocked_at", text_ts("unblocked_at"))


@query(
    "history_per_ip",
    EPISODES
    + f"""SELECT strftime(unblock_at, '%Y%m') AS month, ip, count(*) AS n_blocks,
  string_agg({sql_ts('blocked_at')} || ' ' || tier || ' ' || attempt_count, ';' ORDER BY blocked_at) AS blocks
FROM episodes WHERE status = 'closed' GROUP BY 1, 2""",
)
def history_per_ip(spark, sf):
    nested = K.history_per_ip(K.block_history(_episodes(spark, sf)))

    def line(b):
        return F.concat_ws(" ", text_ts(b["blocked_at"]), b["tier"], b["attempts"].cast("string"))

    return nested.select(
        "month", "ip", F.size("blocks").cast("bigint").alias("n_blocks"), F.array_join(F.transform("blocks", line), ";").alias("blocks")
    )


@query(
    "block_counters",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED, B.episode_ctes(B.AS_OF), B.whitelist_sql(), INTAKE)
    + """SELECT count(*) AS total_blocks, CAST(sum(attempt_count - 1) AS BIGINT) AS block_timer_resets,
  count(*) FILTER (WHERE status = 'active') AS currently_blocked,
  count(*) FILTER (WHERE status = 'active' AND tier = '30min') AS active_30min,
  count(*) FILTER (WHERE status = 'active' AND tier = '8hours') AS active_8hours,
  count(*) FILTER (WHERE status = 'active' AND tier = '24hours') AS active_24hours,
  count(*) FILTER (WHERE status = 'active' AND tier = 'permanent') AS active_permanent,
  count(*) FILTER (WHERE status = 'closed') AS total_unblocks,
  (SELECT count(*) FROM intake WHERE status = 'whitelisted') AS skipped_whitelisted,
  (SELECT count(*) FROM intake WHERE status = 'below_threshold') AS skipped_below_threshold,
  (SELECT count(*) FROM intake WHERE status = 'invalid') AS skipped_invalid,
  CAST(2419200 AS BIGINT) AS uptime_seconds
FROM episodes""",
)
def block_counters(spark, sf):
    started = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    return K.block_counters(_intake(spark, sf), _episodes(spark, sf), started, _as_of())


@query(
    "persistent_attackers",
    EPISODES + "SELECT ip, max(attempt_count) AS max_attempts FROM episodes GROUP BY ip HAVING max(attempt_count) - 1 >= 2",
)
def persistent_attackers(spark, sf):
    return K.persistent_attackers(_episodes(spark, sf), 2)


@query(
    "expired_blocks",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED)
    + f"""SELECT alert_id, ip, tier, {sql_ts('ts + to_seconds(dur)')} AS unblock_at FROM tiered
WHERE dur IS NOT NULL AND ts + to_seconds(dur) <= TIMESTAMP '{B.AS_OF}'""",
)
def expired_blocks(spark, sf):
    state = K.block_tiers(B.alerts(spark, sf))
    return K.expired_blocks(state, _as_of()).select("alert_id", "ip", "tier", text_ts("unblock_at").alias("unblock_at"))


@query(
    "retry_step",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED, B.whitelist_sql())
    + f""", newest AS (SELECT ip, arg_max(alert_id, (ts, alert_file, alert_id)) AS alert_id FROM tiered GROUP BY ip),
queue AS (
  SELECT t.ip, t.tier, t.alias, t.confidence, t.alert_id, CAST(1 + t.alert_id % 6 AS INTEGER) AS attempts,
         t.ts AS last_attempt, TIMESTAMP '{B.AS_OF}' + to_seconds(t.alert_id % 7 - 4) AS next_retry
  FROM newest n JOIN tiered t ON t.ip = n.ip AND t.alert_id = n.alert_id),
judged AS (
  SELECT *, CASE WHEN next_retry > TIMESTAMP '{B.AS_OF}' THEN 'waiting' WHEN attempts >= 5 THEN 'gave_up'
                 WHEN {B.listed('ip')} THEN 'whitelisted' WHEN alert_id % 2 = 0 THEN 'blocked' ELSE 'requeued' END AS result
  FROM queue)
SELECT ip, tier, alias, confidence, result, CASE WHEN result = 'requeued' THEN attempts + 1 ELSE attempts END AS attempts,
  {sql_ts(f"CASE WHEN result = 'requeued' THEN TIMESTAMP '{B.AS_OF}' ELSE last_attempt END")} AS last_attempt,
  {sql_ts(f"CASE WHEN result = 'requeued' THEN TIMESTAMP '{B.AS_OF}' + to_seconds(30) ELSE next_retry END")} AS next_retry
FROM judged""",
)
def retry_step(spark, sf):
    tiered = K.block_tiers(B.alerts(spark, sf))
    picked = tiered.groupBy("ip").agg(
        F.max_by(F.struct("tier", "alias", "confidence", "alert_id", "ts"), F.struct("ts", "alert_file", "alert_id")).alias("r")
    )
    queue = picked.select(
        "ip", "r.tier", "r.alias", "r.confidence", "r.alert_id", (1 + F.col("r.alert_id") % 6).cast("int").alias("attempts"),
        F.col("r.ts").alias("last_attempt"), (_as_of() + F.make_dt_interval(secs=F.col("r.alert_id") % 7 - 4)).alias("next_retry"),
    )
    outcomes = queue.select("ip", (F.col("alert_id") % 2 == 0).alias("success"))
    step = R.retry_step(queue, outcomes, _as_of(), whitelist=B.whitelist(spark))
    return step.select(
        "ip", "tier", "alias", "confidence", "result", "attempts",
        text_ts("last_attempt").alias("last_attempt"), text_ts("next_retry").alias("next_retry"),
    )


@query(
    "retry_enqueue",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED)
    + f"""SELECT ip, arg_max(tier, (ts, alert_file)) AS tier, arg_max(confidence, (ts, alert_file)) AS confidence, 1 AS attempts,
  {sql_ts(f"TIMESTAMP '{B.AS_OF}' + to_seconds(30)")} AS next_retry FROM tiered GROUP BY ip""",
)
def retry_enqueue(spark, sf):
    failed = K.block_tiers(B.alerts(spark, sf)).withColumnRenamed("total_flows", "flows")
    empty = spark.createDataFrame([], "ip string, tier string, alias string, confidence double, flows bigint, alert_file string, "
                                      "blocked_at timestamp, attempts int, last_attempt timestamp, next_retry timestamp")
    out = R.enqueue(empty, failed, _as_of())
    return out.select("ip", "tier", "confidence", "attempts", text_ts("next_retry").alias("next_retry"))


@query(
    "alias_contents",
    EPISODES
    + """SELECT alias, 0 AS part, count(*) AS entries, string_agg(ip, chr(10) ORDER BY ip) AS content
FROM episodes WHERE status = 'active' GROUP BY alias""",
)
def alias_contents(spark, sf):
    return K.alias_contents(K.active_blocks(_episodes(spark, sf)))


@query(
    "alias_diff",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED, B.episode_ctes(B.AS_OF), B.episode_ctes(B.EARLIER, "_old"))
    + """, want AS (SELECT DISTINCT alias, ip FROM episodes WHERE status = 'active'),
have AS (SELECT DISTINCT alias, ip FROM episodes_old WHERE status = 'active')
SELECT alias, ip, 'add' AS change FROM (SELECT * FROM want EXCEPT SELECT * FROM have)
UNION ALL SELECT alias, ip, 'remove' AS change FROM (SELECT * FROM have EXCEPT SELECT * FROM want)""",
)
def alias_diff(spark, sf):
    want = K.active_blocks(_episodes(spark, sf))
    have = K.active_blocks(_episodes(spark, sf, B.EARLIER))
    return K.alias_diff(want, have)


@query(
    "block_labels",
    B.with_(B.FLOWS, B.ALERTS, B.TIERED)
    + f"""SELECT alert_id, strftime(ts, '%Y%m') AS month, date_diff('second', TIMESTAMP '2024-01-01', date_trunc('second', ts)) AS uptime,
  'Blocked by ML: ' || printf('%.2f', {sql_round('confidence * 100', 2)}) || '% confidence, ' || total_flows || ' flows' AS description,
  ip || ':' || (alert_id % 65536) AS target, coalesce(dur, 0) AS seconds FROM tiered""",
)
def block_labels(spark, sf):
    t = K.block_tiers(B.alerts(spark, sf))
    start = F.to_timestamp(F.lit("2024-01-01 00:00:00"))
    return t.select(
        "alert_id",
        S.month_key("ts").alias("month"),
        S.elapsed_seconds(start, "ts").alias("uptime"),
        S.block_description("confidence", "total_flows").alias("description"),
        S.target_key("ip", F.col("alert_id") % 65536).alias("target"),
        S.or_default(S.tier_seconds("tier"), 0).cast("int").alias("seconds"),
    )


@query(
    "set_changes",
    """WITH old AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'F'),
new AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderstatus = 'O')
SELECT coalesce(o.k, n.k) AS k, CASE WHEN o.k IS NULL THEN 'added' ELSE 'removed' END AS change
FROM old o FULL JOIN new n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL""",
)
def set_changes(spark, sf):
    """Customers that have open orders but no finished ones, and the other way round."""
    orders = table(spark, sf, "orders")

    def having(status):
        return orders.filter(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"))

    return L.set_changes(having("F"), having("O"), "k")
