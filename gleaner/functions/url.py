"""Addresses: identity, display, safety and domain, all built of JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleaner.constants import ID_LENGTH, SAFE_SCHEMES, TRACKING_PREFIX

# RFC 3986, appendix B, with the scheme as letters, digits, + - . only
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def trimmed(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(url, F.lit("")), r"^[\s\x{85}\x{A0}]+|[\s\x{85}\x{A0}]+$", "")


def part(url: Column, group: int) -> Column:
    """1 scheme, 2 authority, 3 path, 4 query, 5 fragment; '' where absent."""
    return F.regexp_extract(url, PARTS, group)


def _kept(query: Column) -> Column:
    return F.array_join(F.filter(F.split(query, "&"), lambda p: (p != "") & ~F.startswith(F.lower(p), F.lit(TRACKING_PREFIX))), "&")


def normalize_url(url: Column) -> Column:
    """The identity of an address: scheme and authority in lower case, no fragment, no tracking parameters, no final slashes."""
    u = trimmed(url)
    scheme, host, path, query = F.lower(part(u, 1)), F.lower(part(u, 2)), F.regexp_replace(part(u, 3), "/+$", ""), _kept(part(u, 4))
    front = F.concat(F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""), F.when(host != "", F.concat(F.lit("//"), host)).otherwise(""))
    return F.concat(front, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def item_id(url: Column) -> Column:
    """The first 12 hex digits of the SHA-256 of the identity; '' without an address."""
    n = normalize_url(url)
    return F.when(n == "", "").otherwise(F.substring(F.sha2(n, 256), 1, ID_LENGTH))


def display_url(url: Column) -> Column:
    """The address without tracking parameters and otherwise untouched."""
    u = trimmed(url)
    bare = F.regexp_extract(u, r"(?s)^([^?#]*)", 1)
    query, fragment = _kept(part(u, 4)), part(u, 5)
    rebuilt = F.concat(bare, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""), F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""))
    return F.when(part(u, 4) == "", u).otherwise(rebuilt)


def host_of(url: Column) -> Column:
    """The host without user and port, lower case."""
    authority = F.regexp_replace(F.lower(part(trimmed(url), 2)), r"^.*@", "")
    return F.regexp_replace(authority, r":\d*$", "")


def unsafe_reason(url: Column) -> Column:
    """Why an address must not become a link, the first of empty, scheme, no_host, no_dot; null if it may."""
    u = trimmed(url)
    host = host_of(url)
    return (
        F.when(u == "", "empty")
        .when(~F.lower(part(u, 1)).isin(*SAFE_SCHEMES), "scheme")
        .when(host == "", "no_host")
        .when(~F.contains(host, F.lit(".")), "no_dot")
    )


def domain_of(url: Column) -> Column:
    """The last two labels of the authority without a leading www.; a shorter one as it is."""
    host = F.regexp_replace(F.lower(part(trimmed(url), 2)), r"^www\.", "")
    labels = F.filter(F.split(host, r"\."), lambda p: p != "")
    return F.when(F.size(labels) > 2, F.array_join(F.slice(labels, -2, 2), ".")).otherwise(host)


def minimal_change(a: Column, b: Column) -> Column:
    """Whether b is a with nothing but tracking parameters taken out: every other component and every other parameter, in
    order and number, is the same."""
    a, b = trimmed(a), trimmed(b)
    same = [part(a, i) == part(b, i) for i in (1, 2, 3, 5)]
    ok = _kept(part(a, 4)) == F.array_join(F.filter(F.split(part(b, 4), "&"), lambda p: p != ""), "&")
    for s in same:
        ok = ok & s
    return ok
