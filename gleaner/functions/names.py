"""Spellings of a publisher's name, and the site an address is on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def name_key(name: Column) -> Column:
    """Letters and digits of name, lower case: 'Foundry  Lantern' and 'foundry-lantern' are one. Blank gives null."""
    key = F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}]+", "")
    return F.when(key != "", key)


def name_core(name: Column) -> Column:
    """name_key without what feeds add: a leading 'The', a trailing 'RSS', '(feed)' or '| Blog'."""
    bare = F.regexp_replace(F.lower(F.trim(name)), r"(?U)[\s ]+", " ")
    bare = F.regexp_replace(bare, r"^\s*the\s+", "")
    bare = F.regexp_replace(bare, r"\s*(?:\((?:feed|rss|atom|blog|news)\)|[|–—-]\s*(?:blog|feed|rss|news|home)|\b(?:rss|atom|feed))\s*$", "")
    return name_key(bare)


def http_host(url: Column) -> Column:
    """The host of an http(s) address, lower case, without user, port and final dot; null for every other address."""
    host = F.regexp_extract(F.trim(F.regexp_replace(url, r"(?U)^\s+|\s+$", "")), r"(?i)^https?:/{2,}(?:[^/?#@\\]*@)?([^/?#:\\@\s]+)", 1)
    host = F.regexp_replace(F.lower(host), r"\.+$", "")
    return F.when(host != "", host)


def host_suffixes(host: Column) -> Column:
    """host and every shorter name it lies under, longest first: a.b.c gives [a.b.c, b.c, c]."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.when(host.isNotNull(), F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(parts, i, n), ".")))
