"""The pool and the ledger: collapsing arrivals, what is new, expiry, indexes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.constants import MAX_AGE_DAYS, POOL_CAP
from gleaner.functions.dates import day_of
from gleaner.functions.text import sanitise_summary


def entity_of(entity: Column) -> Column:
    return F.lower(F.trim(F.coalesce(entity, F.lit(""))))


def collapse_batch(batch: DataFrame) -> DataFrame:
    """One row per id: the first arrival's fields, the summary with the longest sanitised body (the earliest of equals), the
    first filled entity and substance, and how many rows fell together. Rows without an id pass one by one."""
    body = F.length(sanitise_summary(F.col("summary")))
    rows = batch.withColumn("_key", F.when(F.coalesce("id", F.lit("")) != "", F.col("id")).otherwise(F.concat(F.lit("#"), "row_no"))).withColumn("_body", body)
    first = lambda c: F.min_by(F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)), F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col("row_no"))).alias(c)
    return rows.groupBy("_key").agg(
        F.min("row_no").alias("row_no"), F.min_by("id", "row_no").alias("id"), F.min_by("source", "row_no").alias("source"), F.min_by("title", "row_no").alias("title"),
        F.min_by("url", "row_no").alias("url"), F.max_by("summary", F.struct("_body", -F.col("row_no"))).alias("summary"),
        first("entity"), first("substance"), F.count("*").alias("copies"),
    ).drop("_key")


def outcomes(batch: DataFrame, ledger: DataFrame) -> DataFrame:
    """row_no and outcome of every arrival, the first that holds: no_id, ledger (its id is in the ledger), repeat (an earlier
    arrival has its id), added. The first of equal ids is found by an aggregate, so a hot id is no hot task."""
    listed = ledger.where("id is not null and id != ''").select("id").distinct().withColumn("listed", F.lit(True))
    known = batch.where("id is not null and id != ''")
    first = known.groupBy("id").agg(F.min("row_no").alias("first_row"))
    with_id = known.select("row_no", "id").join(first, "id").join(listed, "id", "left")
    outcome = F.when(F.col("listed"), "ledger").when(F.col("first_row") < F.col("row_no"), "repeat").otherwise("added")
    without = batch.where("id is null or id = ''").select("row_no", F.lit("no_id").alias("outcome"))
    return with_id.select("row_no", outcome.alias("outcome")).unionByName(without)


def ledger_index(ledger: DataFrame) -> DataFrame:
    """entity and the latest day (published, else date) the ledger dealt with it, as the greatest string."""
    when = F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.col("date"))
    return ledger.select(entity_of(F.col("entity")).alias("entity"), when.alias("day")).where("entity != ''").groupBy("entity").agg(F.max("day").alias("day"))


def days_since_entity(pool: DataFrame, ledger: DataFrame) -> DataFrame:
    """row_no, entity, days since the ledger last had the entity, of the rows whose entity it knows."""
    index = ledger_index(ledger).select("entity", F.try_to_date("day", "yyyy-MM-dd").alias("last")).where("last is not null")
    rows = pool.select("row_no", entity_of(F.col("entity")).alias("entity"), day_of(F.col("first_seen")).alias("seen")).where("entity != '' and seen is not null")
    return rows.join(index, "entity").select("row_no", "entity", F.datediff("seen", "last").alias("days"))


def prune(pool: DataFrame, as_of: str, max_age: int = MAX_AGE_DAYS, cap: int = POOL_CAP) -> DataFrame:
    """row_no, id and status of every row: expired (older than max_age days), over_cap (beyond the cap newest by first_seen and
    id as strings), kept. An unreadable day counts as as_of. Top cap rows are taken by a limit, not by a window."""
    today = F.to_date(F.lit(as_of))
    seen = F.coalesce(F.try_to_date("first_seen", "yyyy-MM-dd"), today)
    rows = pool.select("row_no", F.coalesce("id", F.lit("")).alias("id"), F.coalesce("first_seen", F.lit("")).alias("raw"), (F.datediff(today, seen) > max_age).alias("old"))
    newest = rows.where("not old").orderBy(F.desc("raw"), F.desc("id"), F.asc("row_no")).limit(cap).select("row_no", F.lit(True).alias("top"))
    return rows.join(newest, "row_no", "left").select("row_no", "id", F.when(F.col("old"), "expired").when(F.col("top"), "kept").otherwise("over_cap").alias("status"))


def arrivals(pool: DataFrame) -> DataFrame:
    """Per day: rows, ids seen for the first time ever, their distinct sources, and whether it is the first day."""
    rows = pool.select("row_no", day_of(F.col("first_seen")).alias("day"), F.nullif("id", F.lit("")).alias("id"), "source").where("day is not null")
    first = rows.where("id is not null").groupBy("id").agg(F.min(F.struct("day", "row_no", "source")).alias("f")).select("f.*")
    new = first.groupBy("day").agg(F.count("*").alias("new"), F.count_distinct(F.nullif("source", F.lit(""))).alias("sources"))
    every = rows.groupBy("day").agg(F.count("*").alias("fetched"))
    start = rows.agg(F.min("day").alias("first_day"))
    return every.join(new, "day", "left").join(F.broadcast(start), F.lit(True)).select(
        "day", "fetched", F.coalesce("new", F.lit(0)).alias("new"), F.coalesce("sources", F.lit(0)).alias("sources"), (F.col("day") == F.col("first_day")).alias("cold_start")
    )


def supply(by_day: DataFrame) -> DataFrame:
    """Mean (2 places), median and least of the new arrivals over the days after the first."""
    return by_day.where("not cold_start").agg(
        F.count("*").alias("days"), F.round(F.avg("new"), 2).alias("mean"), F.median("new").alias("median"), F.min("new").alias("least"), F.max("new").alias("most")
    )


def top_sources(pool: DataFrame) -> DataFrame:
    """The source with most rows of each day (the least name of equals) and its share of the day's rows, 3 places."""
    n = pool.select(day_of(F.col("first_seen")).alias("day"), "source").where("day is not null and source is not null").groupBy("day", "source").agg(F.count("*").alias("n"))
    # max of (n, then the least name) by a pair of aggregates, without a sort
    top = n.groupBy("day").agg(F.max("n").alias("n"), F.sum("n").alias("total"))
    return n.join(top, ["day", "n"]).groupBy("day", "n", "total").agg(F.min("source").alias("source")).select("day", "source", F.round(F.col("n") / F.col("total"), 3).alias("share"))


def rebuild_ledger(published: DataFrame) -> DataFrame:
    """The first row of each id, by day and then url."""
    day = F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.col("date"))
    rows = published.where("coalesce(id, '') != ''").select("id", F.coalesce("url", F.lit("")).alias("url"), F.coalesce(day, F.lit("")).alias("day"))
    return rows.groupBy("id").agg(F.min(F.struct("day", "url")).alias("f"), F.count("*").alias("rows")).select("id", "f.day", "f.url", "rows")


def windowed(df: DataFrame, by: list[str], order: list[Column], name: str = "place") -> DataFrame:
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))


def source_filtered(pool: DataFrame, source_dim: DataFrame) -> DataFrame:
    """row_no and name of the rows whose title and summary match their source's pattern (any case; no pattern passes), and of
    those the first filter_cap of a day by row_no."""
    dim = source_dim.select("name", "filter_regex", "filter_cap")
    text = F.concat(F.coalesce("title", F.lit("")), F.lit(" "), F.coalesce("summary", F.lit("")))
    rows = pool.select("row_no", F.col("source").alias("name"), day_of(F.col("first_seen")).alias("day"), text.alias("text")).where("day is not null").join(dim, "name")
    passed = rows.where(F.col("filter_regex").isNull() | F.regexp_like("text", F.concat(F.lit("(?i)"), "filter_regex"))).drop("text")
    # the greatest cap as a literal is a limit before the shuffle, so that no source's whole day meets in a task
    most = source_dim.agg(F.max("filter_cap")).head()[0] or 0
    capped = windowed(passed.where("filter_cap is not null"), ["day", "name"], [F.asc("row_no")]).where(F.col("place") <= most).where("place <= filter_cap").drop("place")
    return passed.where("filter_cap is null").unionByName(capped).select("row_no", "name")


def holds_term(columns: list[str], terms: list[str]) -> Column:
    """Whether any term stands in the columns' text, in any case, or without spaces in the text without spaces. No terms at
    all are an error: a blocklist that was not read must not let everything pass."""
    terms = [t.strip().lower() for t in terms if t.strip()]
    if not terms:
        raise ValueError("the list of blocked terms is empty")
    hay = F.lower(F.concat_ws(" ", *columns))
    squashed = F.replace(hay, F.lit(" "), F.lit(""))
    found = F.lit(False)
    for t in terms:
        found = found | F.contains(hay, F.lit(t)) | F.contains(squashed, F.lit(t.replace(" ", "")))
    return found
