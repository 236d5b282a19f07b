"""State transitions: a state and a batch give the next state as tables; nothing is changed in place.

Every transition returns DataFrames that are written as a new snapshot (gleaner.sources.files.Snapshots), so a failed run leaves the
old state and a repeated one finds nothing to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.functions.url import unsafe_reason
from gleaner.operators.pool import entity_of, prune

#: The outcomes of an arrival, the first that holds; counters hold all of them.
OUTCOMES = ("no_id", "ledger", "pool", "repeat", "blocked", "unsafe", "added")


def filled(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) != ""


def current(pool: DataFrame) -> DataFrame:
    """The pool by id: rows without one vanish, of equal ids the last by row_no stays. By an aggregate, so that a hot id is no hot
    task."""
    rest = [c for c in pool.columns if c != "row_no"]
    last = pool.where(filled("id")).groupBy("id").agg(F.max_by(F.struct("row_no", *rest), "row_no").alias("r"))
    return last.select("r.*").select(pool.columns)


def admitted(batch: DataFrame, pool: DataFrame, ledger: DataFrame, blocked: Column | None = None) -> DataFrame:
    """batch with outcome: what becomes of every arrival against the ledger, the pool and the batch itself."""
    listed = ledger.where(filled("id")).select("id").distinct().withColumn("_listed", F.lit(True))
    held = pool.where(filled("id")).select("id").distinct().withColumn("_held", F.lit(True))
    first = batch.where(filled("id")).groupBy("id").agg(F.min("row_no").alias("_first"))
    facts = first.join(listed, "id", "left").join(held, "id", "left")
    outcome = (
        F.when(~filled("id"), "no_id").when(F.col("_listed"), "ledger").when(F.col("_held"), "pool").when(F.col("_first") < F.col("row_no"), "repeat")
        .when(F.coalesce(blocked, F.lit(False)) if blocked is not None else F.lit(False), "blocked").when(unsafe_reason(F.col("url")).isNotNull(), "unsafe").otherwise("added")
    )
    return batch.join(facts, "id", "left").select(*batch.columns, outcome.alias("outcome"))


def ingest(pool: DataFrame, batch: DataFrame, ledger: DataFrame, day: Column, blocked: Column | None = None) -> DataFrame:
    """The next pool: what it holds, as it is, and the added arrivals with first_seen set to day where they have none. Taking the
    same batch again adds nothing and refreshes no first_seen."""
    held = current(pool)
    new = admitted(batch, held, ledger, blocked).where("outcome = 'added'").drop("outcome")
    return held.unionByName(new.withColumn("first_seen", F.when(filled("first_seen"), F.col("first_seen")).otherwise(day)).select(held.columns))


def counted(rows: DataFrame, column: str, vocabulary: tuple[str, ...]) -> DataFrame:
    """(column, n) for every word of the vocabulary, zero where none has it; other values are left out."""
    words = rows.sparkSession.createDataFrame([(i, w) for i, w in enumerate(vocabulary)], f"at int, {column} string")
    n = rows.groupBy(column).agg(F.count("*").alias("n"))
    return words.join(n, column, "left").select("at", column, F.coalesce("n", F.lit(0)).alias("n"))


def retire(pool: DataFrame, ledger: DataFrame, as_of: str) -> tuple[DataFrame, DataFrame]:
    """(pool, ledger) after pruning: rows too old or over the cap leave the pool and enter the ledger, once an id, with their status
    and as_of as its day; ids that the ledger has are not entered again."""
    status = prune(pool, as_of).select("row_no", "status")
    marked = pool.join(status, "row_no")
    kept = marked.where("status = 'kept'").select(pool.columns)
    gone = marked.where("status != 'kept'").where(filled("id")).groupBy("id").agg(F.min_by(F.struct("url", "status", "entity"), "row_no").alias("r"))
    new = gone.join(ledger.where(filled("id")).select("id").distinct(), "id", "left_anti")
    entry = new.select("id", "r.url", "r.status", F.lit(None).cast("string").alias("published"), F.lit(as_of).alias("date"), "r.entity")
    return kept, ledger.select(entry.columns).unionByName(entry)


def check_edition(edition: DataFrame, edition_day: str, as_of: str) -> None:
    """Refuses an edition of another day, an empty one, and one with a row that has no id, before anything is written."""
    if edition_day != as_of:
        raise ValueError(f"the edition is of {edition_day}, not of {as_of}")
    n, missing = edition.agg(F.count("*"), F.count(F.when(~filled("id"), 1))).head()
    if not n:
        raise ValueError("the edition is empty")
    if missing:
        raise ValueError(f"{missing} rows of the edition have no id")


def newly_published(edition: DataFrame, pool: DataFrame, ledger: DataFrame, as_of: str, again_after: int = 180) -> DataFrame:
    """The ledger's new rows for an edition (id, url): the entity comes from the pool. An id published at most again_after days ago
    is not entered again, so a repeated run enters nothing."""
    when = F.try_to_date(F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.col("date")), "yyyy-MM-dd")
    last = ledger.where("status = 'published'").where(filled("id")).groupBy("id").agg(F.max(when).alias("_last"))
    known = current(pool).select("id", entity_of(F.col("entity")).alias("entity"))
    new = edition.groupBy("id").agg(F.min("url").alias("url")).join(last, "id", "left").where(F.col("_last").isNull() | (F.datediff(F.lit(as_of).cast("date"), "_last") > again_after))
    return new.join(known, "id", "left").select("id", "url", F.lit("published").alias("status"), F.lit(as_of).alias("published"), F.lit(as_of).alias("date"), F.nullif("entity", F.lit("")).alias("entity"))


def publish(edition: DataFrame, pool: DataFrame, ledger: DataFrame, as_of: str, again_after: int = 180) -> tuple[DataFrame, DataFrame]:
    """(pool, ledger) after an edition came out: its ids leave the pool and are entered as published."""
    entry = newly_published(edition, pool, ledger, as_of, again_after)
    rest = pool.join(edition.select("id").distinct(), "id", "left_anti").select(pool.columns)
    return rest, ledger.select(entry.columns).unionByName(entry)


def veto(offered: DataFrame, order: DataFrame, cap: int = 7, per_source: int = 1, per_domain: int = 2) -> DataFrame:
    """A chooser's order (day, pos, row_no) over the offered rows (day, row_no, source, domain): day, pos, row_no, outcome, the first
    of not_offered, duplicate, over_cap, source_capped, domain_capped that holds, else taken.

    A fold over one day's order. What can never be taken is told before: rows that were not offered and repeats; of a source and a
    domain all but the first `cap` can be taken by no walk, and the rest of the order is short."""
    import pandas as pd

    first = order.groupBy("day", "row_no").agg(F.min("pos").alias("_first"))
    named = order.join(first, ["day", "row_no"]).join(offered.select("day", "row_no", "source", "domain", F.lit(True).alias("_known")), ["day", "row_no"], "left")
    early = F.when(F.col("_known").isNull(), "not_offered").when(F.col("pos") > F.col("_first"), "duplicate")
    told = named.withColumn("outcome", early)
    done = told.where("outcome is not null").select("day", "pos", "row_no", "outcome")

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        out, sources, domains, n = [], {}, {}, 0
        for r in rows.sort_values("pos").itertuples(index=False):
            if n >= cap:
                what = "over_cap"
            elif sources.get(r.source, 0) >= per_source:
                what = "source_capped"
            elif domains.get(r.domain, 0) >= per_domain:
                what = "domain_capped"
            else:
                what, n = "taken", n + 1
                sources[r.source] = sources.get(r.source, 0) + 1
                domains[r.domain] = domains.get(r.domain, 0) + 1
            out.append((r.day, r.pos, r.row_no, what))
        return pd.DataFrame(out, columns=["day", "pos", "row_no", "outcome"])

    open_rows = told.where("outcome is null").select("day", "pos", "row_no", "source", "domain")
    walked = open_rows.groupBy("day").applyInPandas(walk, "day date, pos bigint, row_no bigint, outcome string")
    return done.select("day", F.col("pos").cast("bigint").alias("pos"), "row_no", "outcome").unionByName(walked)


def updated(held: DataFrame, changes: DataFrame, key: list[str], value: str, at: str) -> DataFrame:
    """A key-value state after changes: the last change of a key by `at` replaces its value; a null or empty value deletes the key."""
    last = changes.groupBy(*key).agg(F.max_by(F.struct(F.col(value).alias("v"), F.col(at).alias("t")), at).alias("c"))
    both = held.join(last, key, "full_outer")
    now = both.select(*key, F.when(F.col("c").isNotNull(), F.col("c.v")).otherwise(F.col(value)).alias(value), F.coalesce(F.col("c.t"), F.col(at)).alias(at))
    return now.where(filled(value) if dict(now.dtypes)[value] == "string" else F.col(value).isNotNull())


def signals_valid(signals: DataFrame, now: str, schema: int) -> DataFrame:
    """The whole table or an error: version 2, keys of five parts, stamps with an offset not more than a day ahead, at least one
    row. All violations are counted in one pass before anything is merged."""
    from gleaner.operators.digests import instant

    if schema != 2:
        raise ValueError(f"signals of version {schema}")
    t, today = instant(F.col("seen_at")), F.to_timestamp(F.lit(now))
    bad_key = ~F.coalesce(F.rlike("key", F.lit(r"^wl(?::[^:]+){3}:\d+$")), F.lit(False))
    n, keys, stamps, ahead = signals.agg(F.count("*"), F.count_if(bad_key), F.count_if(t.isNull()), F.count_if(F.coalesce(t > today + F.expr("interval 1 day"), F.lit(False)))).head()
    if not n or keys or stamps or ahead:
        raise ValueError(f"{n} signals, {keys} bad keys, {stamps} stamps without an offset, {ahead} in the future")
    return signals


def matched(items: DataFrame, returned: DataFrame, key: str) -> DataFrame:
    """Every key of items or returned with what became of it: matched, omitted (not returned) or unknown (returned but no item)."""
    a, b = items.select(key).distinct().withColumn("_a", F.lit(True)), returned.select(key).distinct().withColumn("_b", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.select(key, F.when(F.col("_a").isNull(), "unknown").when(F.col("_b").isNull(), "omitted").otherwise("matched").alias("outcome"))


def samples(rows: DataFrame, by: str, key: str, most: int = 3) -> DataFrame:
    """by, n and the least `most` keys of each group; the least are kept by partial aggregates, never a whole group."""
    out = rows.groupBy(by).agg(F.count("*").alias("n"), F.min(key).alias("_1"))
    found, last = out, ["_1"]
    for i in range(2, most + 1):
        more = rows.join(F.broadcast(found.select(by, last[-1])), by).where(F.col(key) > F.col(last[-1])).groupBy(by).agg(F.min(key).alias(f"_{i}"))  # one row a reason
        found = found.join(more, by, "left")
        last.append(f"_{i}")
    return found.select(by, "n", F.array_compact(F.array(*last)).alias("samples"))
