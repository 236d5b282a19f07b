"""Texts: cleaning, summaries fit for a card, quotes."""

from __future__ import annotations

import html
from collections.abc import Callable
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from gleaner.constants import QUOTE_CHARS, QUOTE_LEAST

WHITE = r"(?U)\s+"


@pandas_udf(T.StringType())
def _unescape(s: pd.Series) -> pd.Series:
    return s.map(html.unescape, na_action="ignore")


def unescape(text: Column) -> Column:
    """One pass of HTML entities; of texts without an ampersand only a null goes to Python."""
    return F.coalesce(_unescape(F.when(F.contains(text, F.lit("&")), text)), text)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def guarded(text: Column, phrases: tuple[str, ...], pattern: str, to: str) -> Column:
    """The pattern replaced, tried only in texts that hold one of the phrases (in lower case), without which it cannot match."""
    holds = lambda x: reduce(Column.__or__, [F.contains(F.lower(x), F.lit(p)) for p in phrases])
    return let(text, lambda x: F.when(holds(x), F.regexp_replace(x, pattern, to)).otherwise(x))


def collapse(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, WHITE, " "), "^ | $", "")


def clean_text(text: Column) -> Column:
    """Entities decoded once, then tag-like runs to spaces, white space collapsed; a lone '<' stays. Null gives ''."""
    return collapse(F.regexp_replace(unescape(F.coalesce(text, F.lit(""))), r"<[a-zA-Z/!][^>]*>", " "))


def last_sentence(text: Column) -> Column:
    """text up to its last sentence's end (a dot after a dot is none), or '' without one."""
    return F.regexp_extract(text, r"(?s)^(.*(?<!\.)[.!?][\"')\]]?)(?=\s|$)", 1)


def sanitise_summary(text: Column) -> Column:
    """A publisher's summary as prose: boilerplate, calls to action, bare addresses, aggregator labels and elision marks
    removed in this order, then cut to the last sentence's end. '' if nothing is left; applying it twice changes nothing."""
    s = clean_text(text)
    for pattern, to, phrases in (
        # patterns whose results must equal, and what each cannot match without (fixed values)
        (r"(?i)^\s*comments\s*$", "", ()),
        (r"(?is)\s*\bthe post\b.*?\bappeared first on\b.*$", "", ("appeared first on",)),
        (r"(?is)\s*\b(?:read more|continue reading|read the full (?:story|article|post)|sign up for|subscribe to|the post appeared first)\b.*$", "",
         ("read more", "continue reading", "read the full", "sign up for", "subscribe to", "the post appeared first")),
        (r"\s*https?://\S+", " ", ("http",)),
        (r"(?i)(?:article url|comments url|points|#\s*comments|comments)\s*:\s*\d*", " ", (":",)),
        (r"\s*\[(?:…|\.\.\.)\]\s*", " ", ("[",)),
    ):
        s = guarded(s, phrases, pattern, to) if phrases else F.regexp_replace(s, pattern, to)
    s = collapse(s)
    s = F.trim(F.regexp_replace(s, r"\s*(?:…|\.\.\.)\s*$", ""))
    s = F.regexp_replace(s, r"^[\s\-–—:;,.]+", "")
    return let(s, lambda x: F.coalesce(F.nullif(F.trim(last_sentence(x)), F.lit("")), x))


def trim_quote(text: Column, cap: int = QUOTE_CHARS, least: int = QUOTE_LEAST) -> Column:
    """text if it fits; else up to the last sentence's end within cap if that is at least `least` long; else cut before a
    word with an ellipsis."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), r"^(?U)\s+|(?U)\s+$", "")
    ended = F.trim(last_sentence(F.substring(t, 1, cap)))
    head = F.substring(t, 1, cap - 1)
    words = F.regexp_replace(F.when(F.contains(head, F.lit(" ")), F.regexp_replace(head, r"(?s) [^ ]*$", "")).otherwise(head), r"[,;:—\- ]+$", "")
    cut = F.concat(F.when(words != "", words).otherwise(head), F.lit("…"))
    return F.when(F.length(t) <= cap, t).when(F.length(ended) >= least, ended).otherwise(cut)
