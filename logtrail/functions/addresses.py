"""IP addresses: validity, network prefix, and sortable keys for range lookups."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_IPV4_BODY = _OCTET + r"(?:\." + _OCTET + r"){3}"
_HEXTETS = r"[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4})*+"
_IPV6_FULL = r"\A[0-9a-fA-F]{1,4}(?::[0-9a-fA-F]{1,4}){7}\z"
_IPV6_SHORT = r"\A(?:" + _HEXTETS + r")?::(?:" + _HEXTETS + r")?\z"


def is_ipv4(ip: Column) -> Column:
    return ip.rlike(r"\A" + _IPV4_BODY + r"\z")


def is_ipv6(ip: Column) -> Column:
    """Full, shortened, dotted-tail and scoped spellings."""
    body = F.split_part(ip, F.lit("%"), F.lit(1))
    hextets = F.regexp_replace(body, ":" + _IPV4_BODY + r"\z", ":0:0")
    short = hextets.rlike(_IPV6_SHORT) & (F.regexp_count(hextets, F.lit("[0-9a-fA-F]+")) <= 7)
    scope_ok = ip.rlike(r"\A[^%/]*+(?:%[^%/]++)?\z")
    return ip.contains(":") & scope_ok & (hextets.rlike(_IPV6_FULL) | short)


def network_prefix(ip: Column) -> Column:
    """First four groups of an IPv6 text, first three octets of an IPv4, '' when invalid."""
    return (
        F.when(is_ipv4(ip), F.substring_index(ip, ".", 3))
        .when(is_ipv6(ip), F.substring_index(ip, ":", 4))
        .otherwise("")
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with `value` computed once, so the expression stays small."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _octets_hex(ip: Column) -> Column:
    parts = F.transform(F.split(ip, r"\."), lambda part: F.lpad(F.hex(part.try_cast("int")), 2, "0"))
    return F.lower(F.array_join(parts, ""))


def _tail_as_hextets(body: Column) -> Column:
    """A dotted tail rewritten as two groups."""
    tail_at = F.length(body) - F.length(F.substring_index(body, ":", -1)) + 1
    octets = _octets_hex(F.substring_index(body, ":", -1))
    groups = _let(octets, lambda o: F.concat(o.substr(1, 4), F.lit(":"), o.substr(5, 4)))
    return F.when(body.contains("."), F.concat(body.substr(F.lit(1), tail_at - 1), groups)).otherwise(body)


def _hextets_hex(ip: Column) -> Column:
    padded = _tail_as_hextets(F.lower(F.split_part(ip, F.lit("%"), F.lit(1))))
    for digits in (3, 2, 1):
        padded = F.regexp_replace(padded, r"\b([0-9a-f]{" + str(digits) + r"})\b", "0" * (4 - digits) + "$1")

    def fill(halves: Column) -> Column:
        left, right = halves[0], F.coalesce(F.get(halves, F.lit(1)), F.lit(""))
        return F.concat(left, F.repeat(F.lit("0"), 32 - F.length(left) - F.length(right)), right)

    halves = F.transform(F.split(padded, "::"), lambda half: F.replace(half, F.lit(":"), F.lit("")))
    return _let(halves, fill)


def address_key(ip: Column) -> Column:
    """'4' + 8 hex digits or '6' + 32 hex digits, in address order; null when invalid."""
    return F.when(is_ipv4(ip), F.concat(F.lit("4"), _octets_hex(ip))).when(
        is_ipv6(ip), F.concat(F.lit("6"), _hextets_hex(ip))
    )


def lookup_key(ip: Column) -> Column:
    """address_key, with IPv4-mapped IPv6 addresses looked up as IPv4."""

    def unmap(key: Column) -> Column:
        mapped = key.startswith("6" + "0" * 20 + "ffff")
        return F.when(mapped, F.concat(F.lit("4"), key.substr(26, 8))).otherwise(key)

    return _let(address_key(ip), unmap)


def masked_key(key: Column, prefix_length: Column) -> Column:
    """The first prefix_length bits of a key as hex digits, the last digit masked."""
    digits = F.floor(prefix_length / 4).cast("int")
    head = key.substr(F.lit(2), digits)
    last = key.substr(digits + 2, F.lit(1))
    spare = prefix_length % 4
    masked = (
        F.when(spare == 1, F.translate(last, "0123456789abcdef", "0000000088888888"))
        .when(spare == 2, F.translate(last, "0123456789abcdef", "000044448888cccc"))
        .when(spare == 3, F.translate(last, "0123456789abcdef", "0022446688aaccee"))
        .otherwise("")
    )
    return F.concat(head, masked)
