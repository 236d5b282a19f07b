"""Days in the forms feeds write them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day_of(text: Column) -> Column:
    """The day as written: an ISO date, alone or before a time, or a month-name date as 'Sep 3, 2026'. Else null."""
    t = F.trim(text)
    iso = F.regexp_extract(t, r"^(\d{4}-\d{2}-\d{2})(?:[T ]\d{1,2}:\d{2}.*)?$", 1)
    named = F.regexp_extract(t, r"(?i)^([a-z]{3})[a-z]*\.? +(\d{1,2},? +\d{4})(?: .*)?$", 1)
    rest = F.regexp_replace(F.regexp_extract(t, r"(?i)^([a-z]{3})[a-z]*\.? +(\d{1,2},? +\d{4})(?: .*)?$", 2), r",? +", " ")
    return F.coalesce(
        F.when(iso != "", F.try_to_date(iso, "yyyy-MM-dd")),
        F.when(named != "", F.try_to_date(F.concat(F.initcap(named), F.lit(" "), rest), "MMM d yyyy")),
    )


def ordinal(text: Column) -> Column:
    """Days since 0001-01-01 plus one of an ISO date; 0 if it cannot be read, so that it sorts last when descending."""
    return F.coalesce(F.datediff(F.try_to_date(text, "yyyy-MM-dd"), F.to_date(F.lit("0001-01-01"))) + 1, F.lit(0))


MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"


def date_text(text: Column) -> Column:
    """The first readable day in a text, of the years 20xx: ISO, 'Sep 3[–5], 2026' (a range's first day), 'Thu, 3 Sep 2026' or
    '9/3/2026'; an impossible day falls through to the next form."""
    t = F.trim(F.coalesce(text, F.lit("")))
    named = rf"(?i)\b{MONTH}\.?\s+(\d{{1,2}})(?:\s*[–-]\s*\d{{1,2}})?,?\s+(20\d{{2}})\b"
    weekday = rf"(?i)\b(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+(\d{{1,2}})\s+{MONTH}\.?,?\s+(20\d{{2}})\b"
    slashed = r"\b(\d{1,2})/(\d{1,2})/(20\d{2})\b"

    def read(pattern: str, month: int, day: int, form: str) -> Column:
        part = lambda i: F.regexp_extract(t, pattern, i)
        name = F.initcap(part(month)) if "MMM" in form else part(month)
        return F.when(part(3) != "", F.try_to_date(F.concat_ws(" ", name, part(day), part(3)), form))

    iso = F.regexp_extract(t, r"\b(20\d{2}-\d{2}-\d{2})", 1)
    return F.coalesce(F.when(iso != "", F.try_to_date(iso, "yyyy-MM-dd")), read(named, 1, 2, "MMM d yyyy"), read(weekday, 2, 1, "MMM d yyyy"), read(slashed, 1, 2, "M d yyyy"))


def api_time(text: Column) -> Column:
    """An interface's stamp as an instant; without an offset it is UTC, and what cannot be read is null."""
    s = F.trim(text)
    zoned = F.rlike(s, F.lit(r"(?:Z|[+-]\d{2}:?\d{2})$"))
    return F.try_to_timestamp(F.when(zoned, s).otherwise(F.concat(s, F.lit("Z"))))


def recent(day: Column, as_of: str, days: int) -> Column:
    """Whether day is at most `days` before as_of; an undated row passes."""
    return F.coalesce(day >= F.date_sub(F.lit(as_of).cast("date"), days), F.lit(True))


def event_window(day: Column, as_of: str, first: int = 2, last: int = 30) -> Column:
    """'soon' for a day from as_of + first to as_of + last, 'UNKNOWN' for none, else 'out'."""
    today = F.lit(as_of).cast("date")
    return F.when(day.isNull(), "UNKNOWN").when(day.between(F.date_add(today, first), F.date_add(today, last)), "soon").otherwise("out")


def staleness(stamp: Column, signals: Column, now: Column, days: int = 7) -> Column:
    """Whether an export is stale: signals were never exported, its stamp lies ahead, or it is `days` old."""
    return F.when(stamp.isNull(), signals > 0).otherwise((stamp > now) | (F.datediff(now, stamp) >= days))
