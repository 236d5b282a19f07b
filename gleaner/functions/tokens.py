"""Tokens, shingles and what a text claims."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

from gleaner.constants import SHINGLE, STOPWORDS


def extract_all(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({pattern})"), 1)


def title_tokens(title: Column) -> Column:
    """Distinct lower-case runs of a-z and 0-9 longer than two that are no stopwords."""
    stop = F.array(*[F.lit(w) for w in STOPWORDS])
    return F.array_distinct(F.filter(extract_all(F.lower(title), "[a-z0-9]+"), lambda t: (F.length(t) > 2) & ~F.array_contains(stop, t)))


def words(text: Column) -> Column:
    """Lower-case words of a-z and 0-9; dotted versions count as one."""
    return extract_all(F.lower(text), r"[a-z0-9]+(?:\.[a-z0-9]+)+|[a-z0-9]+")


def numbers(text: Column) -> Column:
    """Distinct numbers without commas and percent signs; the years 19xx and 20xx are none."""
    raw = F.transform(extract_all(text, r"\d[\d,]*(?:\.\d+)?%?"), lambda t: F.regexp_replace(t, ",", ""))
    return F.array_distinct(F.transform(F.filter(raw, lambda t: ~F.rlike(t, F.lit(r"^(?:19|20)\d{2}$"))), lambda t: F.regexp_replace(t, "%+$", "")))


def names(text: Column, not_names: list[str]) -> Column:
    """Distinct capitalised tokens of at least three characters, joined by . - or +, that are not in not_names; a letter of any
    script beside one makes it no token."""
    found = extract_all(text, r"(?U)\b[A-Z][A-Za-z0-9]*(?:[.\-+][A-Za-z0-9]+)*\b")
    stop = F.array(*[F.lit(w.lower()) for w in not_names]) if not_names else F.array().cast("array<string>")
    return F.array_distinct(F.filter(found, lambda t: (F.length(t) >= 3) & ~F.array_contains(stop, F.lower(t))))


def shingles(words_: Column, n: int = SHINGLE) -> Column:
    """Distinct runs of n consecutive words, joined by spaces; empty below n words."""
    runs = F.transform(F.sequence(F.lit(1), F.size(words_) - n + 1), lambda i: F.array_join(F.slice(words_, i, n), " "))
    return F.when(F.size(words_) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def shingle_overlap(text: Column, source: Column, n: int = SHINGLE) -> Column:
    """Share of the distinct n-word runs of text that source holds; 0 below n words."""
    own = shingles(words(text), n)
    return F.when(F.size(own) > 0, F.size(F.array_intersect(own, shingles(words(source), n))) / F.size(own)).otherwise(F.lit(0.0))


@pandas_udf(T.IntegerType())
def longest_run(a: pd.Series, b: pd.Series) -> pd.Series:
    """The greatest number of consecutive words of a (word arrays) that stand together in b, by a table of run lengths."""
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(0)
            continue
        where: dict[str, list[int]] = {}
        for j, w in enumerate(y):
            where.setdefault(w, []).append(j)
        best, ends = 0, {}
        for w in x:
            now = {j: ends.get(j - 1, 0) + 1 for j in where.get(w, ())}
            best = max(best, max(now.values(), default=0))
            ends = now
        out.append(best)
    return pd.Series(out, dtype="int32")
