"""Digests, links, scores over time, calendars and upserts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.constants import CADENCE_DAYS, DEAD_STATUS, HALF_LIFE_DAYS, RELATED, WEIGHTS
from gleaner.functions.url import domain_of, normalize_url


def actions(digests: DataFrame) -> DataFrame:
    """One row per action: theme, slug, type (try, share, read, skip), its index from 0 and its text; a share reads 'what → who'."""
    plain = lambda field: F.transform(F.coalesce(F.col(f"actions.{field}"), F.array().cast("array<string>")), lambda x, i: F.struct(i.alias("idx"), x.alias("text")))
    share = F.transform(
        F.coalesce(F.col("actions.share"), F.array().cast("array<struct<what:string,who:string>>")), lambda x, i: F.struct(i.alias("idx"), F.concat(x["what"], F.lit(" → "), x["who"]).alias("text"))
    )
    kinds = {"try": plain("try"), "share": share, "read": plain("readDeeper"), "skip": plain("skip")}

    def typed(kind: str, items: Column) -> Column:
        return F.transform(items, lambda x: F.struct(F.lit(kind).alias("type"), x["idx"].alias("idx"), x["text"].alias("text")))

    each = F.explode(F.concat(*[typed(k, v) for k, v in kinds.items()]))
    return digests.select("theme", "slug", each.alias("a")).select("theme", "slug", "a.type", "a.idx", "a.text")


def pending(digests: DataFrame) -> DataFrame:
    """Per digest the number of its actions to try and to share, and of its sources beside the count it states."""
    size = lambda c: F.coalesce(F.array_size(c), F.lit(0))
    return digests.select("theme", "slug", (size(F.col("actions.try")) + size(F.col("actions.share"))).alias("pending"), size(F.col("sources")).alias("n_sources"), F.col("itemCount").alias("stated"))


def related(digests: DataFrame, n: int = RELATED) -> DataFrame:
    """For every digest the n newest others of its theme: theme, slug, place, other. The newest n + 1 of a theme serve all
    of its digests, so no pairs of a theme are made."""
    w = Window.partitionBy("theme").orderBy(F.desc("date"), F.asc("slug"))
    newest = digests.select("theme", F.col("slug").alias("other"), F.row_number().over(w).alias("r")).where(F.col("r") <= n + 1)
    top = newest.groupBy("theme").agg(F.transform(F.array_sort(F.collect_list(F.struct("r", "other"))), lambda x: x["other"]).alias("top"))  # n + 1 a theme
    others = F.slice(F.filter("top", lambda x: x != F.col("slug")), 1, n)
    return digests.select("theme", "slug").join(top, "theme").select("theme", "slug", F.posexplode(others).alias("place", "other")).withColumn("place", F.col("place") + 1)


def decayed(digests: DataFrame, as_of: str | None = None, half_life: float = HALF_LIFE_DAYS, weights: dict[str, float] = WEIGHTS, star: float = 0.5) -> DataFrame:
    """theme, slug and score: weight of the theme (0 if unknown) times 0.5^(age / half_life) times 1 + star if starred. The
    last day of the digests is the clock unless as_of is given; a half-life of 0 means no decay."""
    by = F.create_map(*[F.lit(x) for kv in sorted(weights.items()) for x in kv])
    last = F.to_date(F.lit(as_of)) if as_of else F.col("last")
    rows = digests if as_of else digests.join(F.broadcast(digests.agg(F.max("date").alias("last"))), F.lit(True))
    decay = F.pow(F.lit(0.5), F.datediff(last, F.col("date")) / half_life) if half_life else F.lit(1.0)
    score = F.coalesce(by[F.col("theme")], F.lit(0.0)) * decay * (1 + F.when(F.col("starred"), star).otherwise(0.0))
    return rows.select("theme", "slug", "date", F.round(score, 9).alias("score"))


def coverage(digests: DataFrame) -> DataFrame:
    """Every theme and day between the first and last digest, with the digests of the day and whether one was due (Monday to
    Saturday)."""
    span = digests.agg(F.min("date").alias("a"), F.max("date").alias("b")).where("a is not null")
    days = span.select(F.explode(F.sequence("a", "b")).alias("day"))
    themes = digests.select("theme").distinct()
    have = digests.groupBy("theme", F.col("date").alias("day")).agg(F.count("*").alias("digests"))
    # as many rows as themes times days of the calendar, not as digests
    grid = themes.join(F.broadcast(days), F.lit(True))
    return grid.join(have, ["theme", "day"], "left").select("theme", "day", F.coalesce("digests", F.lit(0)).alias("digests"), (F.weekday("day") <= 5).alias("due"))


def gaps(covered: DataFrame) -> DataFrame:
    """Per theme the days due, covered and missed, and the first three missed."""
    missed = F.col("due") & (F.col("digests") == 0)
    first = F.slice(F.array_sort(F.collect_set(F.when(missed, F.col("day")))), 1, 3)  # days of the calendar
    return covered.groupBy("theme").agg(F.count_if("due").alias("due"), F.count_if(F.col("due") & (F.col("digests") > 0)).alias("covered"), F.count_if(missed).alias("missed"),
                                        F.array_join(F.transform(first, lambda d: d.cast("string")), ",").alias("first_missed"))


def cadence(digests: DataFrame, days: int = CADENCE_DAYS) -> DataFrame:
    """The last `days` days up to the newest digest, with the digests and themes of each."""
    last = digests.agg(F.max("date").alias("b"))
    calendar = last.where("b is not null").select(F.explode(F.sequence(F.date_sub("b", days - 1), "b")).alias("day"))
    have = digests.groupBy(F.col("date").alias("day")).agg(F.count("*").alias("digests"), F.count_distinct("theme").alias("themes"))
    return calendar.join(have, "day", "left").select("day", F.coalesce("digests", F.lit(0)).alias("digests"), F.coalesce("themes", F.lit(0)).alias("themes"))


def weeks(digests: DataFrame) -> DataFrame:
    """Digests, items and starred ones by ISO week."""
    week = F.concat(F.extract(F.lit("YEAROFWEEK"), "date").cast("string"), F.lit("-W"), F.lpad(F.weekofyear("date").cast("string"), 2, "0"))
    return digests.groupBy(week.alias("week")).agg(F.count("*").alias("digests"), F.sum(F.coalesce("itemCount", F.lit(0))).alias("items"), F.count_if(F.coalesce("starred", F.lit(False))).alias("starred"))


def verdicts(link_status: DataFrame) -> DataFrame:
    """One verdict per address over all its checks: alive if any check was good (below 400), else dead if any says 404 or 410,
    else unknown; with the number of checks."""
    return link_status.groupBy("url").agg(
        F.when(F.coalesce(F.bool_or(F.col("status").between(200, 399)), F.lit(False)), "alive")
        .when(F.coalesce(F.bool_or(F.col("status").isin(*DEAD_STATUS)), F.lit(False)), "dead").otherwise("unknown").alias("verdict"),
        F.count("*").alias("checks"), F.max("redirects").alias("redirects"),
    )


def without_dead(pool: DataFrame, checked: DataFrame) -> DataFrame:
    """row_no of the pool rows whose address is not dead; a source all of whose rows are dead keeps them (the check is
    doubted, not the source)."""
    rows = pool.select("row_no", F.coalesce("source", F.lit("")).alias("source"), F.trim("url").alias("url"))
    marked = rows.join(checked.select(F.trim("url").alias("url"), "verdict").groupBy("url").agg(F.min("verdict").alias("verdict")), "url", "left").withColumn("dead", F.coalesce(F.col("verdict") == "dead", F.lit(False)))
    doubted = marked.groupBy("source").agg(F.bool_and("dead").alias("all_dead"))
    return marked.join(doubted, "source").where("not dead or all_dead").select("row_no", "source", "dead")


def dangling(digests: DataFrame, pool: DataFrame) -> DataFrame:
    """Cited addresses of digests that no pool row has, by identity: theme, slug, url."""
    cited = digests.select("theme", "slug", F.explode("sources").alias("s")).select("theme", "slug", F.col("s.url").alias("url"))
    have = pool.where("url is not null").select(normalize_url(F.col("url")).alias("page")).distinct()
    return cited.withColumn("page", normalize_url(F.col("url"))).join(have, "page", "left_anti").select("theme", "slug", "url")


def cited_domains(digests: DataFrame) -> DataFrame:
    """Domains by the digests that cite them."""
    cited = digests.select("theme", "slug", F.explode("sources").alias("s"))
    return cited.groupBy(domain_of(F.col("s.url")).alias("domain")).agg(F.count("*").alias("citations"), F.count_distinct("theme", "slug").alias("digests"))


def upsert(held: DataFrame, new: DataFrame, key: list[str], at: str, values: list[str]) -> DataFrame:
    """Last writer wins by instant: a held row stays if it is as late as the new one or later; the whole row is replaced
    otherwise. outcome tells new, updated or retained."""
    h = held.select(*key, F.struct(F.col(at), *values).alias("h"))
    n = new.select(*key, F.struct(F.col(at), *values).alias("n"))
    stays = F.col("n").isNull() | (F.col("h").isNotNull() & (F.col(f"h.{at}") >= F.col(f"n.{at}")))
    outcome = F.when(F.col("h").isNull(), "new").when(stays, "retained").otherwise("updated")
    pick = F.when(stays, F.col("h")).otherwise(F.col("n"))
    return h.join(n, key, "full_outer").select(*key, pick.alias("r"), outcome.alias("outcome")).select(*key, "r.*", "outcome")


def latest(df: DataFrame, key: list[str], at: str, values: list[str]) -> DataFrame:
    """The newest row of each key by an aggregate."""
    return df.groupBy(*key).agg(F.max(F.struct(F.col(at), *values)).alias("r")).select(*key, "r.*")


def crosstab(df: DataFrame, rows: str, columns: str, values: list[str]) -> DataFrame:
    """Counts of columns' values by row, zeros filled, with the total."""
    out = df.groupBy(rows).agg(*[F.count_if(F.coalesce(F.col(columns) == v, F.lit(False))).alias(v) for v in values], F.count("*").alias("total"))
    return out


def dimensions(df: DataFrame, names: list[str]) -> DataFrame:
    """For each numeric column its count, least, most, spread, mean (4 places) and distinct values: columns are turned to
    rows, then one aggregate."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(n).alias("dim"), F.col(n).cast("double").alias("v")) for n in names])).alias("x")).select("x.*")
    return long.groupBy("dim").agg(F.count("v").alias("n"), F.min("v").alias("least"), F.max("v").alias("most"), (F.max("v") - F.min("v")).alias("spread"), F.round(F.avg("v"), 4).alias("mean"),
                                   F.count_distinct("v").alias("values"))


def by_month(digests: DataFrame) -> DataFrame:
    """Every month from the first to the last digest, with its digests."""
    span = digests.agg(F.trunc(F.min("date"), "MM").alias("a"), F.trunc(F.max("date"), "MM").alias("b")).where("a is not null")
    every = span.select(F.explode(F.sequence("a", "b", F.expr("interval 1 month"))).alias("m"))
    have = digests.groupBy(F.trunc("date", "MM").alias("m")).agg(F.count("*").alias("digests"))
    return every.join(have, "m", "left").select(F.date_format("m", "yyyy-MM").alias("month"), F.coalesce("digests", F.lit(0)).alias("digests"))


def violations(digests: DataFrame) -> DataFrame:
    """theme, slug, rule for each rule broken: count (itemCount is not the number of sources), format, tldr, title, source_url."""
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rules = {
        "count": ~F.equal_null("itemCount", F.array_size("sources")), "format": F.col("format").isNull() | ~F.col("format").isin("daily", "weekly"), "tldr": blank("tldr"), "title": blank("title"),
        "source_url": F.coalesce(F.exists("sources", lambda s: ~F.rlike(F.coalesce(s["url"], F.lit("")), F.lit("^https?://"))), F.lit(False)),
    }
    broken = F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in rules.items()]))
    return digests.select("theme", "slug", F.explode(broken).alias("rule"))


def listing(digests: DataFrame) -> DataFrame:
    """Per theme the digests with something to try, to share, weekly ones, and those of the last 7 and 30 days."""
    rows = digests.join(F.broadcast(digests.agg(F.max("date").alias("last"))), F.lit(True))
    age, some = F.datediff("last", "date"), lambda f: F.coalesce(F.array_size(F.col(f"actions.{f}")), F.lit(0)) > 0
    return rows.groupBy("theme").agg(F.count_if(some("try")).alias("with_try"), F.count_if(some("share")).alias("with_share"), F.count_if(F.coalesce(F.col("format") == "weekly", F.lit(False))).alias("weekly"),
                                     F.count_if(age <= 7).alias("week"), F.count_if(age <= 30).alias("month"))


def signal_key(theme: str, slug: str, kind: str, idx: str) -> Column:
    return F.concat_ws(":", F.lit("wl"), theme, slug, kind, F.col(idx).cast("string"))


def parse_keys(keys: DataFrame) -> DataFrame:
    """key, theme, slug, type, idx of five-part keys; others are left out."""
    p = F.split("key", ":")
    idx = F.get(p, F.lit(4)).try_cast("int")
    return keys.where((F.size(p) == 5) & (F.get(p, F.lit(0)) == "wl") & idx.isNotNull()).select(
        "key", F.get(p, F.lit(1)).alias("theme"), F.get(p, F.lit(2)).alias("slug"), F.get(p, F.lit(3)).alias("type"), idx.alias("idx")
    )


def signal_texts(parsed: DataFrame, acts: DataFrame) -> DataFrame:
    return parsed.join(acts, ["theme", "slug", "type", "idx"]).select("key", "theme", "slug", "type", "idx", "text")


def instant(stamp: Column) -> Column:
    """A stamp with an offset as an instant: Z, +0200 and +02:00 are read, and minutes without seconds."""
    s = F.regexp_replace(F.trim(stamp), r"([+-]\d{2})(\d{2})$", "$1:$2")
    s = F.regexp_replace(s, r"(T\d{2}:\d{2})(Z|[+-]\d{2}:\d{2})$", "$1:00$2")
    return F.when(F.rlike(s, F.lit(r"(?:Z|[+-]\d{2}:\d{2})$")), F.try_to_timestamp(s))
