import ipaddress
import random

from pyspark.sql import functions as F

from flowwarden.functions import netaddr as N
from flowwarden.operators import whitelist as L
from tests.conftest import rows

ADDRESSES = [
    "1.2.3.4", "01.2.3.4", "256.1.1.1", "1.2.3", "", "unknown", "::", "::1", "1::", "fe80::1", "2001:db8:0:0:1:0:0:1", "2001:DB8::FFFF",
    "1:2:3:4:5:6:7:8", "1:2:3:4:5:6:7::", "::2:3:4:5:6:7:8", "1:2:3:4:5:6:7:8:9", "1::2::3", "::ffff:1.2.3.4", "::ffff:1.2.3.400",
    "1:2:3:4:5:6:1.2.3.4", "12345::", ":::", "1:2:3:4:5:6:7:8::", "g::1", ":1", "1:", "1.2.3.4 ", "0.0.0.0", "255.255.255.255",
    "10.0.0.15", "10.0.0.16", "10.0.0.31", "10.0.0.32", "10.0.0.77", "10.255.255.255", "11.0.0.0",
]
ENTRIES = [
    "10.0.0.0/8", "10.0.0.1/8", "1.2.3.4/32", "10.0.0.0/255.0.0.0", "10.0.0.0/0.255.255.255", "10.0.0.0/255.0.255.0", "10.0.0.0/33",
    "10.0.0.0/-1", "x/8", "2001:db8::/32", "2001:db8::1/32", "::/0", "0.0.0.0/0", "::1/128", "fe80::/10", "10.0.0.16/28", "10.0.0.0/08",
    "10.0.0.0/", "10.0.0.0/8/8", "::/129", "fe80::/a", "128.0.0.0/1", "10.0.0.64/27",
]


def address(x):
    try:
        return ipaddress.ip_address(x)
    except ValueError:
        return None


def net(x):
    try:
        return ipaddress.ip_network(x)
    except ValueError:
        return None


def test_addresses_like_the_standard_library(spark):
    df = spark.createDataFrame([(a,) for a in ADDRESSES], "ip string")
    for r in df.select("ip", N.ip_key("ip").alias("k"), N.ip_to_num("ip").alias("n"), N.is_valid_ip("ip").alias("v")).collect():
        a = address(r.ip)
        want = None if a is None else (f"4{int(a):08x}" if a.version == 4 else f"6{int(a):032x}")
        assert (r.k, r.v) == (want, a is not None), r.ip
        assert r.n == (int(a) if a is not None and a.version == 4 else None)


def test_containment_like_the_standard_library(spark):
    pairs = [(a, e) for a in ADDRESSES for e in ENTRIES]
    df = spark.createDataFrame(pairs, "ip string, e string").select("ip", "e", N.ip_in_cidr("ip", "e").alias("hit"))
    for r in df.collect():
        a, n = address(r.ip), net(r.e)
        assert r.hit == (a is not None and n is not None and a in n), (r.ip, r.e)


def test_ranges(spark):
    df = spark.createDataFrame([("10.0.0.16/28",), ("0.0.0.0/0",), ("10.0.0.33/24",), ("::/0",)], "e string")
    got = [r[0] and tuple(r[0]) for r in df.select(N.cidr_range("e")).collect()]
    assert got == [(167772176, 167772191), (0, 4294967295), None, None]


def listed(ip, entries):
    a = address(ip)
    return a is not None and any((net(e) is not None and a in net(e)) if "/" in e else ip == e for e in entries)


def test_whitelist_both_ways(spark):
    entries = ["1.2.3.4", "::1", "10.0.0.16/28", "10.0.0.1/8", "fe80::/10", "nonsense", "nonsense/8", "10.0.0.64/27", "10.0.0.77"]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ADDRESSES)], "i int, ip string")
    wl = spark.createDataFrame([(e,) for e in entries], "entry string")
    want = {i: listed(a, entries) for i, a in enumerate(ADDRESSES)}
    for chunk in (1024, 2, 1):  # one chunk, or chunks that networks of earlier ones reach into
        got = {r["i"]: r["whitelisted"] for r in L.flag_whitelisted(df, wl, chunk=chunk).collect()}
        assert got == want
    kept, gone = L.whitelist_antijoin(df, wl), L.whitelist_skipped(df, wl)
    assert kept.count() + gone.count() == len(ADDRESSES) and gone.count() == sum(want.values())


def test_empty_whitelist(spark):
    df = spark.createDataFrame([("1.2.3.4",)], "ip string")
    wl = spark.createDataFrame([], "entry string")
    assert L.flag_whitelisted(df, wl).first()["whitelisted"] is False


def test_long_list_of_nested_networks(spark):
    rng = random.Random(4)
    entries = [None, "10.0.0.1/8", "0.0.0.0/33"]
    for _ in range(300):
        if rng.random() < 0.5:
            bits = rng.randint(8, 32)
            entries.append(str(ipaddress.ip_network((rng.randrange(1 << 12) << 20 | rng.randrange(1 << 8), bits), strict=False)))
        else:
            bits = rng.randint(20, 128)
            entries.append(str(ipaddress.ip_network((0x20010DB8 << 96 | rng.randrange(1 << 16) << rng.choice([0, 40, 80]), bits), strict=False)))
    nets = [ipaddress.ip_network(e) for e in entries[3:]]
    # Both ends of every network, and the addresses beside them.
    ends = {(n.version, max(0, min(int(x) + d, 2 ** (32 if n.version == 4 else 128) - 1))) for n in nets for x in (n[0], n[-1]) for d in (-1, 0, 1)}
    probes = [str(ipaddress.IPv4Address(a) if v == 4 else ipaddress.IPv6Address(a)) for v, a in ends]
    want = {p: any(ipaddress.ip_address(p) in n for n in nets) for p in probes}
    df = spark.createDataFrame([(p,) for p in probes], "ip string")
    wl = spark.createDataFrame([(e,) for e in entries], "entry string")
    for chunk in (1024, 7):
        found = L.flag_whitelisted(df, wl, chunk=chunk)
        assert {r["ip"]: r["whitelisted"] for r in found.collect()} == want
    assert any(want.values()) and not all(want.values())
    # One join with the chunks, however many prefix lengths the list has.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1


def test_set_changes(spark):
    old = spark.createDataFrame([("a",), ("b",), ("b",)], "entry string")
    new = spark.createDataFrame([("b",), ("c",)], "entry string")
    assert rows(L.set_changes(old, new, "entry")) == [("a", "removed"), ("c", "added")]
    assert L.set_changes(old, old, "entry").count() == 0


def test_every_address_in_the_whole_space(spark):
    df = spark.createDataFrame([("8.8.8.8",), ("::1",)], "ip string")
    wl = spark.createDataFrame([("0.0.0.0/0",)], "entry string")
    got = {r["ip"]: r["whitelisted"] for r in L.flag_whitelisted(df, wl).select("ip", F.col("whitelisted")).collect()}
    assert got == {"8.8.8.8": True, "::1": False}
