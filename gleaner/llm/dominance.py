"""Capping records per dominant contributor.

A row's contributor is the site its address is on (the longest site of the dimension that equals the host or ends it after
a dot); a row without an http(s) address is its source's, in any spelling. A contributor with more than `share` of all rows
is dominant and keeps only as many rows, those of the best score.

The cutoff of every contributor is found by parallel bisection: all hold bounds on the cutoff score; one pass counts the
rows between the bounds in 32 steps for all contributors together, and each takes the step in which its limit falls. The
bounds are scores that occur, so they always close. Rows with the cutoff score are then bisected by row number the same
way. No contributor's rows are ever collected or sorted together.

Defined results: a row with neither a known site nor a known source has no contributor and is never capped; a null, NaN or
out-of-range score (below 0 or above 1) ranks below every rating, ties go to the smaller row_no; an empty pool gives
none; a repeated row_no in the scores counts with its best valid score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.names import host_suffixes, http_host, name_core, name_key
from gleaner.session import written

#: The dimension is looked up as a literal map up to this many rows; a larger one is joined.
MAP_ROWS = 5_000
STEPS = 32


def contributors(pool: DataFrame, source_dim: DataFrame) -> DataFrame:
    """row_no and contributor of every pool row; null where there is none."""
    rows = pool.select("row_no", http_host(F.col("url")).alias("host"), name_key(F.col("source")).alias("spelt"), name_core(F.col("source")).alias("core"))
    dim = source_dim.where("site is not null").select(name_key(F.col("name")).alias("key"), name_core(F.col("name")).alias("core"), F.lower(F.trim("site")).alias("site"))
    held = dim.limit(MAP_ROWS + 1).collect()
    if len(held) <= MAP_ROWS:
        sites = {r["site"]: r["site"] for r in held}
        keys, cores = {}, {}
        for r in held:  # a name of several sites means the least of them, as in the join below
            for table, k in ((keys, r["key"]), (cores, r["core"])):
                if k:
                    table[k] = min(table.get(k, r["site"]), r["site"])
        look = lambda table, key: _map(table)[key] if table else F.lit(None).cast("string")
        by_host = F.get(F.filter(F.transform(host_suffixes(F.col("host")), lambda s: look(sites, s)), lambda s: s.isNotNull()), F.lit(0))
        by_name = F.coalesce(look(keys, F.col("spelt")), look(cores, F.col("core")))
        return rows.select("row_no", F.when(F.col("host").isNotNull(), by_host).otherwise(by_name).alias("contributor"))
    suffix = rows.where("host is not null").select("row_no", F.posexplode(host_suffixes(F.col("host"))).alias("pos", "site"))
    by_host = suffix.join(dim.select("site").distinct(), "site").groupBy("row_no").agg(F.min_by("site", "pos").alias("by_host"))
    plain = dim.groupBy("key").agg(F.min("site").alias("by_key"))
    bare = dim.groupBy("core").agg(F.min("site").alias("by_core"))
    named = rows.join(plain, rows["spelt"] == plain["key"], "left").join(bare, "core", "left").join(by_host, "row_no", "left")
    return named.select("row_no", F.when(F.col("host").isNotNull(), F.col("by_host")).otherwise(F.coalesce("by_key", "by_core")).alias("contributor"))


def _map(table: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in sorted(table.items()) for x in kv])


def scored(pool: DataFrame, source_dim: DataFrame, scores: DataFrame) -> DataFrame:
    """row_no, contributor and score (-1 where there is no valid rating) of every pool row, as a table."""
    valid = scores.where(F.col("score").between(0, 1) & ~F.isnan("score")).groupBy("row_no").agg(F.max("score").alias("score"))
    return written(contributors(pool, source_dim).join(valid, "row_no", "left").withColumn("score", F.coalesce("score", F.lit(-1.0))))


def bisect(rows: DataFrame, limits: DataFrame, value: str) -> DataFrame:
    """(contributor, cutoff, below) for each contributor of limits (contributor, need): the need-th smallest value among
    rows, and how many are smaller. Every contributor needs at most as many as it has."""
    tables = []
    found = rows.join(limits, "contributor").groupBy("contributor").agg(F.min(value).alias("lo"), F.max(value).alias("hi"), F.first("need").alias("need"))
    bounds = written(found.withColumn("below", F.lit(0).cast("bigint")))
    while True:
        done = bounds.where("lo = hi").select("contributor", F.col("lo").alias("cutoff"), "below")
        tables.append(done)
        still = bounds.where("lo < hi")
        if still.isEmpty():
            break
        v, lo, hi = F.col(value), F.col("lo"), F.col("hi")
        step = F.least(F.floor((v.cast("double") - lo) / (hi.cast("double") - lo) * STEPS), F.lit(STEPS - 1))
        counts = rows.join(still, "contributor").where((v >= lo) & (v <= hi)).groupBy("contributor", step.alias("step")).agg(
            F.count("*").alias("n"), F.min(v).alias("least"), F.max(v).alias("most"), F.first("need").alias("need"), F.first("below").alias("below")
        )
        upto = F.sum("n").over(Window.partitionBy("contributor").orderBy("step"))  # at most STEPS rows each
        falls = counts.withColumn("upto", F.col("below") + upto).where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
        bounds = written(falls.select("contributor", F.col("least").alias("lo"), F.col("most").alias("hi"), "need", (F.col("upto") - F.col("n")).alias("below")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def cap(rows: DataFrame, share: float | None = None, most: int | None = None) -> DataFrame:
    """rows (row_no, contributor, score) with n (rows of the contributor), dominant and keep.

    The limit of a contributor is the least of floor(share * all rows) and most; keep is false beyond it."""
    total = rows.count()
    limit = min(x for x in (int(share * total) if share is not None else None, most) if x is not None)
    sizes = rows.where("contributor is not null").groupBy("contributor").agg(F.count("*").alias("n"))
    over = written(sizes.where(F.col("n") > limit))
    need = F.lit(limit).cast("bigint")
    if limit > 0:
        down = rows.withColumn("rank", -F.col("score"))
        cut = written(bisect(down, over.select("contributor", need.alias("need")), "rank").withColumnRenamed("cutoff", "score_cut"))
        ties = rows.join(cut, "contributor").where(F.col("score") == -F.col("score_cut")).select("contributor", "row_no")
        tie = bisect(written(ties), cut.select("contributor", (need - F.col("below")).alias("need")), "row_no").select("contributor", F.col("cutoff").alias("last_row"))
        edge = cut.join(tie, "contributor").select("contributor", (-F.col("score_cut")).alias("score_cut"), "last_row")
    else:
        edge = over.select("contributor", F.lit(float("inf")).alias("score_cut"), F.lit(-1).cast("bigint").alias("last_row"))
    marked = rows.join(over, "contributor", "left").join(edge, "contributor", "left")
    within = (F.col("score") > F.col("score_cut")) | ((F.col("score") == F.col("score_cut")) & (F.col("row_no") <= F.col("last_row")))
    return marked.select("row_no", "contributor", "score", "n", F.col("n").isNotNull().alias("dominant"), F.coalesce(within, F.lit(True)).alias("keep"))
