"""Queries of the training-data operators, each over its whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleaner.functions.dates import day_of
from gleaner.llm import dominance, encode, packing, residue, seen, similar, splitting, sql, truncation
from gleaner.session import ship

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue.residue(_read(spark, sf_dir, "pool")).select("row_no")


def _cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The endings of all pool rows but those of p1_found."""
    pool = _read(spark, sf_dir, "pool")
    return truncation.truncated(pool.join(p1_found(spark, sf_dir), "row_no", "left_anti"))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut(spark, sf_dir).where("cut").select("row_no").distinct()


def p2_source_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return truncation.source_shares(_cut(spark, sf_dir))


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return seen.seen_before(_read(spark, sf_dir, "pool"), _read(spark, sf_dir, "ledger")).select("row_no")


def p3_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and rows known before of every batch."""
    pool, day = _read(spark, sf_dir, "pool"), F.col("day")
    known = seen.seen_before(pool, _read(spark, sf_dir, "ledger")).groupBy("day").agg(F.count("*").alias("known"))
    every = pool.select(day_of(F.col("first_seen")).alias("day")).where(day.isNotNull()).groupBy("day").agg(F.count("*").alias("n"))
    return every.join(known, "day", "left").select("day", "n", F.coalesce("known", F.lit(0)).alias("known"))


def p3_probe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last batch taken against the persisted cells of all earlier ones: its rows known, and how much of the cells it read."""
    pool, ledger = _read(spark, sf_dir, "pool"), _read(spark, sf_dir, "ledger")
    day = day_of(F.col("first_seen"))
    last = pool.agg(F.max(day)).head()[0]
    history = seen.new_history(pool)
    history.take(pool.where(day.isNull() | (day < F.lit(last))), ledger)
    known = history.take(pool.where(day == F.lit(last)))
    figures = [F.lit(int(n)).cast("bigint").alias(k) for k, n in sorted(history.figures.items())]
    return known.groupBy().agg(F.count("*").alias("known")).select(F.lit(last).alias("day"), "known", *figures)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.similar_rows(_read(spark, sf_dir, "pool"), leave_out=p1_found(spark, sf_dir)).select("row_a", "row_b")


def p4_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar.groups(_read(spark, sf_dir, "pool"), leave_out=p1_found(spark, sf_dir))


def p4_pairs_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs of all rows with a title and a summary, those of p1_found included."""
    found = similar.similar_rows(_read(spark, sf_dir, "pool"))
    return found.select("row_a", "row_b", F.round("similarity", 9).alias("similarity"))


def _capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = dominance.scored(_read(spark, sf_dir, "pool"), _read(spark, sf_dir, "source_dim"), _read(spark, sf_dir, "quality_score"))
    return dominance.cap(rows, share=DOMINANT)


#: A contributor is dominant above this share of all rows.
DOMINANT = 0.02


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir).where("dominant").select("row_no")


def p5_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _capped(spark, sf_dir).where("keep").select("row_no", "contributor", "score")


def p6_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode.encode(_read(spark, sf_dir, "documents"))


def p6_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The round trip of all texts."""
    return encode.decode(p6_ids(spark, sf_dir))


def p7_packed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.sizes(_read(spark, sf_dir, "documents")))


def p7_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.containers(p7_packed(spark, sf_dir))


def p7_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row over all containers: documents packed, containers beyond a capacity, and whether they are at most two percent more
    than the tokens need."""
    c = packing.containers(p7_packed(spark, sf_dir))
    n = lambda test: F.count(F.when(test, 1))
    cost = packing.COST * float(packing.CAPACITY) ** 2
    return c.agg(
        F.sum("documents").alias("documents"), n(F.col("tokens") > packing.CAPACITY).alias("over_tokens"), n(F.col("items") > packing.DOCUMENTS).alias("over_documents"),
        n((F.col("cost") > cost) & (F.col("with_tokens") > 1)).alias("over_cost"), (F.count("*") <= F.ceil(F.sum("tokens") / packing.CAPACITY) * 1.02 + 1).alias("filled"),
    )


def p8_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row over all pieces: documents and characters they hold, pieces above the limit, out of order, or with a wrong overlap."""
    after = Window.partitionBy("doc_id").orderBy("piece")  # the pieces of one text
    p = p8_pieces(spark, sf_dir).select("doc_id", "piece", "begin", "start", "end", "tokens", F.lag("end").over(after).alias("last_end"), F.lag("start").over(after).alias("last_start"))
    n = lambda test: F.count(F.when(test, 1))
    return p.agg(
        F.countDistinct("doc_id").alias("documents"), F.sum(F.col("end") - F.col("start")).alias("chars"), n(F.col("tokens") > splitting.LIMIT).alias("over_limit"),
        n(F.coalesce("last_end", F.lit(0)) != F.col("start")).alias("gaps"), n((F.col("begin") > F.col("start")) | (F.col("begin") < F.coalesce("last_start", F.lit(0)))).alias("bad_overlap"),
        n((F.col("piece") > 0) & (F.col("begin") == F.col("start"))).alias("without_overlap"),
    )


def p8_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splitting.split(_read(spark, sf_dir, "documents"))


def p8_rejoined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts put together again from their pieces without the overlaps."""
    own = F.substring(F.col("text"), F.col("start") - F.col("begin") + 1, F.col("end") - F.col("start"))
    parts = p8_pieces(spark, sf_dir).select("doc_id", F.struct("piece", own.alias("own")).alias("p"))
    return parts.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list("p")), lambda p: p["own"]), "").alias("text"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (p1_found, p2_found, p2_source_shares, p3_found, p3_batches, p3_probe, p4_found, p4_groups, p4_pairs_all, p5_found, p5_kept, p6_ids, p6_decoded, p7_packed, p7_containers, p7_fill, p8_bounds, p8_pieces, p8_rejoined)}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
