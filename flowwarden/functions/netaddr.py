"""IP addresses and networks as Column expressions.

An address becomes a fixed-width hex text behind a family mark: `4` + 8 digits or `6` + 32
digits.  A network becomes its prefix length plus the leading hex digits that its prefix fixes,
so that containment is plain equality on (prefix, digits) and a hash join can test it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

V4_OCTET = r"(0|[1-9][0-9]?|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
V4_PATTERN = rf"^{V4_OCTET}(\.{V4_OCTET}){{3}}$"
V6_GROUPS = r"[0-9a-f]{1,4}(:[0-9a-f]{1,4})*"
V6_FULL = r"^[0-9a-f]{1,4}(:[0-9a-f]{1,4}){7}$"
V6_SHORT = rf"^({V6_GROUPS})?::({V6_GROUPS})?$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _hex(number: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(number.cast("bigint"))), width, "0")


def is_v4(ip: Column | str) -> Column:
    return _col(ip).rlike(V4_PATTERN)


def ip_to_num(ip: Column | str) -> Column:
    """IPv4 text -> unsigned 32-bit value in a bigint; null when it is not a strict IPv4 address."""
    ip = _col(ip)
    first_two, last_two = F.substring_index(ip, ".", 2), F.substring_index(ip, ".", -2)
    octets = [
        F.substring_index(first_two, ".", 1),
        F.substring_index(first_two, ".", -1),
        F.substring_index(last_two, ".", 1),
        F.substring_index(last_two, ".", -1),
    ]
    value = F.lit(0).cast("bigint")
    for octet in octets:
        value = value * 256 + octet.try_cast("bigint")
    return F.when(is_v4(ip), value)


def _let(value: Column, body) -> Column:
    """Bind a value used several times, so that its expression is not repeated in the plan.

    The lambda also keeps a long expression out of the generated loop, whose method would
    otherwise grow beyond what the JVM compiles.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _padded(groups: Column) -> Column:
    """Colon-separated hex groups -> their digits, four per group."""
    wide = F.regexp_replace(groups, "([0-9a-f]+)", "000$1")
    return F.regexp_replace(F.regexp_replace(wide, "0*([0-9a-f]{4})(?![0-9a-f])", "$1"), ":", "")


def _v6_digits(ip: Column) -> Column:
    """32 hex digits of an IPv6 text, null when malformed."""
    low = F.lower(ip)
    # A dotted tail (::ffff:1.2.3.4) is turned into two hex groups first.
    tail = _hex(ip_to_num(F.substring_index(low, ":", -1)), 8)
    head = F.regexp_replace(low, "[^:]*$", "")
    plain = F.when(~low.contains("."), low).otherwise(
        F.concat(head, F.regexp_replace(tail, "(....)(....)", "$1:$2"))
    )
    groups = F.regexp_count(plain, F.lit("[0-9a-f]+"))
    left = _padded(F.substring_index(plain, "::", 1))
    right = _padded(F.substring_index(plain, "::", -1))
    # Zeros fill the gap between both halves.
    spread = F.concat(F.left(F.rpad(left, 32, "0"), 32 - F.length(right)), right)
    return F.when(plain.rlike(V6_FULL), _padded(plain)).when(
        plain.rlike(V6_SHORT) & (groups <= 7), spread
    )


def v6_key(ip: Column | str) -> Column:
    """Family mark plus hex digits of an IPv6 address; null for everything else."""
    ip = _col(ip)
    return F.when(ip.contains(":"), _let(ip, lambda x: F.concat(F.lit("6"), _v6_digits(x))))


def ip_key(ip: Column | str) -> Column:
    """Family mark plus hex digits of an address; null when the text is not an address."""
    ip = _col(ip)
    v4 = F.concat(F.lit("4"), _hex(ip_to_num(ip), 8))
    return F.when(ip.contains(":"), v6_key(ip)).otherwise(v4)


def is_valid_ip(ip: Column | str) -> Column:
    ip = _col(ip)
    valid = F.when(ip.contains(":"), v6_key(ip).isNotNull()).otherwise(is_v4(ip))
    return F.coalesce(valid, F.lit(False))


def masked(key: Column | str, prefix: Column | str | int) -> Column:
    """Leading digits of an address key that a prefix length fixes (with the family mark)."""
    key = _col(key)
    bits = F.lit(prefix) if isinstance(prefix, int) else _col(prefix)
    whole = F.floor(bits / 4).cast("int")
    rest = (bits % 4).cast("int")
    nibble = F.conv(F.substring(key, whole + 2, F.lit(1)), 16, 10).cast("int")
    # Zero the free bits of the digit that the prefix cuts through.
    kept = (nibble - nibble % F.pow(F.lit(2.0), 4 - rest).cast("int")).cast("int")
    cut = F.when(rest == 0, F.lit("")).otherwise(F.lower(F.hex(kept)))
    return F.concat(F.substring(key, F.lit(1), whole + 1), cut)


def _prefix_length(text: Column) -> Column:
    """Prefix length from `24`, a netmask or a host mask; null when it is none of them."""
    number = F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))
    bits = F.lpad(F.conv(ip_to_num(text).cast("string"), 10, 2), 32, "0")
    from_netmask = F.when(bits.rlike("^1*0*$"), F.length(F.replace(bits, F.lit("0"), F.lit(""))))
    from_hostmask = F.when(bits.rlike("^0*1*$"), F.length(F.replace(bits, F.lit("1"), F.lit(""))))
    return F.coalesce(number, from_netmask, from_hostmask)


def network(entry: Column | str) -> Column:
    """CIDR text -> struct(prefix, digits); null when malformed or when host bits are set."""
    entry = _col(entry)
    base, suffix = F.substring_index(entry, "/", 1), F.substring_index(entry, "/", -1)
    is_v6 = base.contains(":")
    prefix = F.when(is_v6, F.when(suffix.rlike("^[0-9]+$"), suffix.try_cast("int"))).otherwise(
        _prefix_length(suffix)
    )
    limit = F.when(is_v6, F.lit(128)).otherwise(F.lit(32))
    parsed = F.struct(ip_key(base).alias("key"), F.when(prefix.between(F.lit(0), limit), prefix).alias("prefix"))

    def check(net: Column) -> Column:
        digits = masked(net["key"], net["prefix"])
        whole = F.rpad(digits, F.length(net["key"]), F.lit("0"))
        return F.when(whole == net["key"], F.struct(net["prefix"].alias("prefix"), digits.alias("digits")))

    one_slash = F.size(F.split(entry, "/")) == 2
    return F.when(one_slash, _let(parsed, check))


def cidr_range(entry: Column | str) -> Column:
    """IPv4 CIDR -> struct(lo, hi) of numeric bounds; null when malformed or host bits are set."""
    entry = _col(entry)
    parsed = F.struct(network(entry).alias("net"), ip_to_num(F.substring_index(entry, "/", 1)).alias("lo"))

    def bounds(p: Column) -> Column:
        size = F.pow(F.lit(2.0), 32 - p["net"]["prefix"]).cast("bigint")
        known = p["net"].isNotNull() & p["lo"].isNotNull()
        return F.when(known, F.struct(p["lo"].alias("lo"), (p["lo"] + size - 1).alias("hi")))

    return _let(parsed, bounds)


def ip_in_cidr(ip: Column | str, entry: Column | str) -> Column:
    """True when the address lies in the network; False for anything malformed."""
    both = F.struct(network(entry).alias("net"), ip_key(ip).alias("key"))
    hit = _let(both, lambda b: masked(b["key"], b["net"]["prefix"]) == b["net"]["digits"])
    return F.coalesce(hit, F.lit(False))
