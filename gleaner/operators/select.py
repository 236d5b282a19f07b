"""Ranking and choosing: a total order, greedy diversity, near-duplicate titles, nearest days."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.constants import PER_DOMAIN, PER_SOURCE, SHORTLIST, TITLE_JACCARD, UNKNOWN_TIER
from gleaner.functions.dates import day_of, ordinal
from gleaner.functions.tokens import title_tokens
from gleaner.functions.url import domain_of


def tiered(pool: DataFrame, source_dim: DataFrame) -> DataFrame:
    """pool with tier and source_cap of its source; unknown sources have tier 9 and no cap of their own."""
    dim = source_dim.groupBy("name").agg(F.min("tier").alias("tier"), F.min("shortlist_per_source").alias("source_cap")).withColumnRenamed("name", "source")
    return pool.join(dim, "source", "left").withColumn("tier", F.coalesce("tier", F.lit(UNKNOWN_TIER)))


def order() -> list[Column]:
    """Tier up, first_seen down, date down (unreadable last), id up, row_no up."""
    return [F.asc("tier"), F.desc("seen"), F.desc("dated"), F.asc("key"), F.asc("row_no")]


def orderable(pool: DataFrame, source_dim: DataFrame) -> DataFrame:
    """The rows with a readable day and what their order depends on."""
    return tiered(pool, source_dim).select(
        "row_no", day_of(F.col("first_seen")).alias("day"), "tier", "source_cap", F.coalesce("source", F.lit("")).alias("source"), domain_of(F.col("url")).alias("domain"),
        ordinal(F.col("first_seen")).alias("seen"), ordinal(F.col("date")).alias("dated"), F.coalesce("id", F.lit("")).alias("key"),
    ).where("day is not null")


def ranked(pool: DataFrame, source_dim: DataFrame) -> DataFrame:
    """Every row with its place in its day's total order. Range partitions of day and order are sorted alone, so that a large day
    is many tasks; a day's places start after the rows of the days before."""
    placed = global_rank(orderable(pool, source_dim), [F.asc("day"), *order()])
    first = placed.groupBy("day").agg(F.min("place").alias("_first"))
    return placed.join(F.broadcast(first), "day").withColumn("place", (F.col("place") - F.col("_first") + 1).cast("int")).drop("_first")  # one row a day


def global_rank(df: DataFrame, order_by: list[Column], name: str = "place") -> DataFrame:
    """A dense position over all rows without one task that sees them all: range partitions are sorted alone and shifted by
    the number of rows before them (one number a partition)."""
    from gleaner.session import written

    n = max(2, df.rdd.getNumPartitions())
    parts = written(df.repartitionByRange(n, *order_by).withColumn("_part", F.spark_partition_id()))
    counts = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))).select("_part", F.coalesce("_before", F.lit(0)).alias("_before"))
    within = parts.withColumn(name, F.row_number().over(Window.partitionBy("_part").orderBy(*order_by)))
    return within.join(F.broadcast(before), "_part").withColumn(name, F.col(name) + F.col("_before")).drop("_part", "_before")


def diversify(rows: DataFrame, limit: int = SHORTLIST, per_source: int = PER_SOURCE, per_domain: int = PER_DOMAIN) -> DataFrame:
    """The shortlist of each day: rows (as orderable gives them, or with a place) in their order, one skipped if its source or else its domain is at its cap; a
    skipped row uses up neither. A source may have its own cap.

    The walk is a fold, but of one (source, domain) pair only the first min(caps) rows can ever be taken. The rest is left out
    before a day's rows meet in one task, by a limit that is a literal and so is applied before the shuffle too; what is left
    of a day is ranked."""
    by = [F.asc("place")] if "place" in rows.columns else order()
    w = Window.partitionBy("day", "source", "domain").orderBy(*by)
    few = rows.withColumn("cap", F.coalesce("source_cap", F.lit(per_source))).withColumn("nth", F.row_number().over(w)).where(F.col("nth") <= per_domain).where("nth <= cap")
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("day").orderBy(*by)))

    def walk(day: pd.DataFrame) -> pd.DataFrame:
        taken, by_source, by_domain = [], {}, {}
        for r in day.sort_values("place").itertuples(index=False):
            if len(taken) >= limit:
                break
            if by_source.get(r.source, 0) >= r.cap or by_domain.get(r.domain, 0) >= per_domain:
                continue
            by_source[r.source] = by_source.get(r.source, 0) + 1
            by_domain[r.domain] = by_domain.get(r.domain, 0) + 1
            taken.append((r.day, r.row_no, len(taken) + 1))
        return pd.DataFrame(taken, columns=["day", "row_no", "pick"])

    return few.select("day", "row_no", "place", "source", "domain", "cap").groupBy("day").applyInPandas(walk, "day date, row_no bigint, pick int")


def near_titles(pool: DataFrame, t: float = TITLE_JACCARD) -> DataFrame:
    """Pairs of one day's titles whose tokens overlap by t or more (Jaccard), a < b by row_no, equal token sets as one.

    Equal sets are joined to their least row first; two sets must share one of their rarest n - ceil(t n) + 1 tokens in one
    total order of tokens, so only rows with such a token in common meet."""
    rows = pool.select("row_no", day_of(F.col("first_seen")).alias("day"), F.array_sort(title_tokens(F.col("title"))).alias("tokens")).where("day is not null and size(tokens) > 0")
    sets = rows.groupBy("day", "tokens").agg(F.min("row_no").alias("row_no"))
    freq = sets.select("day", F.explode("tokens").alias("token")).groupBy("day", "token").agg(F.count("*").alias("df"))
    each = sets.select("day", "row_no", F.size("tokens").alias("n"), F.explode("tokens").alias("token")).join(freq, ["day", "token"])
    at = F.row_number().over(Window.partitionBy("day", "row_no").orderBy("df", "token"))  # a title's tokens
    prefix = each.withColumn("at", at).where(F.col("at") <= F.col("n") - F.ceil(F.col("n") * t - 1e-9) + 1).select("day", "token", "row_no", "n")
    a, b = prefix.withColumnsRenamed({"row_no": "a", "n": "na"}), prefix.withColumnsRenamed({"row_no": "b", "n": "nb"})
    meet = a.join(b, ["day", "token"]).where((F.col("a") < F.col("b")) & (F.least("na", "nb") >= t * F.greatest("na", "nb") - 1e-9)).select("a", "b").distinct()
    x, y = sets.select(F.col("row_no").alias("a"), F.col("tokens").alias("ta")), sets.select(F.col("row_no").alias("b"), F.col("tokens").alias("tb"))
    both = F.size(F.array_intersect("ta", "tb"))
    scored = meet.join(x, "a").join(y, "b").withColumn("similarity", both / (F.size("ta") + F.size("tb") - both))
    return scored.where(F.col("similarity") >= t).select("a", "b", F.round("similarity", 6).alias("similarity"))


def clusters(pairs: DataFrame) -> DataFrame:
    """(row_no, cluster) of all rows in pairs: the least row reachable. Labels pass along pairs until none changes; each
    round is a written table."""
    from gleaner.session import written

    both = written(pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = written(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("row_no"), F.least("a", "m").alias("cluster")))
    while True:
        near = both.join(label, both["b"] == label["row_no"]).groupBy("a").agg(F.min("cluster").alias("near"))
        # one jump: the label of the label
        far = label.select(F.col("row_no").alias("cluster"), F.col("cluster").alias("far"))
        new = written(label.join(near, label["row_no"] == near["a"]).join(far, "cluster", "left").select("row_no", F.col("cluster").alias("old"), F.least("cluster", "near", "far").alias("cluster")))
        if new.where("old != cluster").isEmpty():
            return new.select("row_no", "cluster")
        label = new.select("row_no", "cluster")


def nearest_days(left: DataFrame, right: DataFrame) -> DataFrame:
    """Every (theme, day) of left with the nearest earlier and the nearest later day of right in the theme: one sort of both
    sides together, no join by inequality."""
    both = left.select("theme", "day", F.lit(1).alias("ask")).distinct().unionByName(right.select("theme", "day", F.lit(0).alias("ask")).distinct())
    by_day = Window.partitionBy("theme").orderBy(F.unix_date("day"))
    held = F.when(F.col("ask") == 0, F.col("day"))
    out = both.withColumn("earlier", F.max(held).over(by_day.rangeBetween(Window.unboundedPreceding, -1)))
    out = out.withColumn("later", F.min(held).over(by_day.rangeBetween(1, Window.unboundedFollowing)))
    return out.where("ask = 1").select("theme", "day", "earlier", "later")
