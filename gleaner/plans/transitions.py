"""Queries of state transitions, joins of the two states, recency and health, with the SQL that DuckDB checks them against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import dates
from gleaner.functions.dates import day_of
from gleaner.functions.url import domain_of
from gleaner.operators import digests, select, state
from gleaner.plans import sql as S
from gleaner.plans.catalog import AS_OF, query, table

_SPLIT = f"""d AS (SELECT *, {S.day('first_seen')} AS day FROM pool), m AS (SELECT max(day) AS last FROM d),
batch AS (SELECT d.* FROM d, m WHERE day = last), held AS (SELECT d.* FROM d, m WHERE day IS NULL OR day < last),
cur AS (SELECT id, max(row_no) AS row_no FROM held WHERE coalesce(id, '') <> '' GROUP BY 1),
un AS (WITH {S.PARTS} SELECT row_no, u, scheme, auth, host FROM ident),
o AS (SELECT b.row_no, b.id, CASE WHEN coalesce(b.id, '') = '' THEN 'no_id' WHEN b.id IN (SELECT id FROM ledger WHERE id IS NOT NULL) THEN 'ledger'
  WHEN b.id IN (SELECT id FROM cur) THEN 'pool' WHEN min(b.row_no) OVER (PARTITION BY b.id) < b.row_no THEN 'repeat'
  WHEN u = '' OR scheme NOT IN ('http', 'https') OR host = '' OR NOT contains(host, '.') THEN 'unsafe' ELSE 'added' END AS outcome
  FROM batch b JOIN un USING (row_no))"""


def _batch(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows of the last day, those before, and the ledger."""
    pool = table(spark, d, "pool")
    day = day_of(F.col("first_seen"))
    last = F.broadcast(pool.agg(F.max(day).alias("_last")))  # one row
    both = pool.withColumn("_day", day).join(last, F.lit(True))
    return both.where("_day = _last").select(pool.columns), both.where("_day is null or _day < _last").select(pool.columns), table(spark, d, "ledger")


@query(f"WITH {_SPLIT} SELECT row_no, id FROM cur UNION ALL SELECT row_no, id FROM o WHERE outcome = 'added'")
def pool_ingested(spark: SparkSession, d: str) -> DataFrame:
    """The pool after the last day's batch."""
    batch, held, ledger = _batch(spark, d)
    return state.ingest(held, batch, ledger, F.lit(AS_OF)).select("row_no", "id")


@query(f"""WITH {_SPLIT}, v AS (SELECT unnest(['no_id', 'ledger', 'pool', 'repeat', 'blocked', 'unsafe', 'added']) AS outcome)
SELECT outcome, coalesce(n, 0) AS n FROM v LEFT JOIN (SELECT outcome, count(*) AS n FROM o GROUP BY 1) USING (outcome)""")
def ingest_counters(spark: SparkSession, d: str) -> DataFrame:
    batch, held, ledger = _batch(spark, d)
    return state.counted(state.admitted(batch, state.current(held), ledger), "outcome", state.OUTCOMES).select("outcome", "n")


_PRUNED = f"""p AS (SELECT *, coalesce(first_seen, '') AS raw, date_diff('day', coalesce(CASE WHEN regexp_full_match(first_seen, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(first_seen AS DATE) END, DATE '{AS_OF}'), DATE '{AS_OF}') > 14 AS old FROM pool),
t AS (SELECT row_no FROM p WHERE NOT old ORDER BY raw DESC, coalesce(id, '') DESC, row_no LIMIT 600),
s AS (SELECT *, CASE WHEN old THEN 'expired' WHEN row_no IN (SELECT row_no FROM t) THEN 'kept' ELSE 'over_cap' END AS st FROM p)"""


@query(f"""WITH {_PRUNED}, g AS (SELECT id, arg_min(coalesce(url, '∅'), row_no) AS url, arg_min(st, row_no) AS status FROM s WHERE st <> 'kept' AND coalesce(id, '') <> '' AND id NOT IN (SELECT id FROM ledger WHERE id IS NOT NULL) GROUP BY 1)
SELECT id, url, status, '{AS_OF}' AS date FROM g UNION ALL SELECT coalesce(id, '∅'), coalesce(url, '∅'), coalesce(status, '∅'), coalesce(date, '∅') FROM ledger""")
def pool_retired(spark: SparkSession, d: str) -> DataFrame:
    """The ledger after pruning."""
    _, ledger = state.retire(table(spark, d, "pool"), table(spark, d, "ledger"), AS_OF)
    return ledger.select(*[F.coalesce(c, F.lit("∅")).alias(c) for c in ("id", "url", "status", "date")])


@query(f"WITH {_PRUNED} SELECT row_no FROM s WHERE st = 'kept'")
def pool_kept(spark: SparkSession, d: str) -> DataFrame:
    return state.retire(table(spark, d, "pool"), table(spark, d, "ledger"), AS_OF)[0].select("row_no")


_EDITION = """e AS (SELECT p.id, min(p.url) AS url FROM pool p JOIN (SELECT row_no, max(score) AS score FROM quality_score WHERE score BETWEEN 0.9 AND 1 GROUP BY 1) q USING (row_no) WHERE coalesce(p.id, '') <> '' GROUP BY 1)"""


def _edition(spark: SparkSession, d: str) -> DataFrame:
    good = table(spark, d, "quality_score").where("score between 0.9 and 1").select("row_no").distinct()
    return table(spark, d, "pool").where("coalesce(id, '') != ''").join(good, "row_no", "left_semi").select("id", "url")


@query(f"""WITH {_EDITION}, l AS (SELECT id, max(CASE WHEN regexp_full_match(coalesce(nullif(trim(published), ''), date), '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(coalesce(nullif(trim(published), ''), date) AS DATE) END) AS last FROM ledger WHERE status = 'published' AND coalesce(id, '') <> '' GROUP BY 1),
c AS (SELECT id, arg_max(coalesce(entity, ''), row_no) AS entity FROM pool WHERE coalesce(id, '') <> '' GROUP BY 1)
SELECT e.id, e.url, nullif(lower(trim(c.entity)), '') AS entity FROM e LEFT JOIN l USING (id) LEFT JOIN c USING (id) WHERE last IS NULL OR date_diff('day', last, DATE '{AS_OF}') > 180""")
def ledger_published(spark: SparkSession, d: str) -> DataFrame:
    """What the best rated rows add to the ledger when they come out."""
    return state.newly_published(_edition(spark, d), table(spark, d, "pool"), table(spark, d, "ledger"), AS_OF).select("id", "url", "entity")


@query(f"WITH {_EDITION} SELECT row_no FROM pool WHERE id IS NULL OR id NOT IN (SELECT id FROM e)")
def pool_unpublished(spark: SparkSession, d: str) -> DataFrame:
    return state.publish(_edition(spark, d), table(spark, d, "pool"), table(spark, d, "ledger"), AS_OF)[0].select("row_no")


@query()
def veto_outcomes(spark: SparkSession, d: str) -> DataFrame:
    """A chooser that names a day's shortlist from the end, each row twice, and a row that was not offered."""
    from gleaner.plans.catalog import diverse_shortlist

    picks = diverse_shortlist(spark, d)
    rows = table(spark, d, "pool").select("row_no", F.coalesce("source", F.lit("")).alias("source"), domain_of(F.col("url")).alias("domain"))
    offered = picks.join(rows, "row_no").select("day", "row_no", "source", "domain")
    back = (F.lit(1000) - F.col("pick")).cast("bigint").alias("pos")
    order = picks.select("day", back, "row_no").unionByName(picks.select("day", (back + 1000).alias("pos"), "row_no")).unionByName(picks.where("pick = 1").select("day", F.lit(0).cast("bigint").alias("pos"), (-F.col("row_no")).alias("row_no")))
    return state.veto(offered, order).groupBy("day", "outcome").agg(F.count("*").alias("n"))


@query("""SELECT row_no, CASE WHEN l.id IS NOT NULL THEN 'ledger' ELSE 'open' END AS state
FROM pool p LEFT JOIN (SELECT DISTINCT id FROM ledger WHERE coalesce(id, '') <> '') l USING (id)""")
def pool_rechecked(spark: SparkSession, d: str) -> DataFrame:
    """Every pool row with whether the ledger has its id by now; rows stay, so that the reason can be counted."""
    listed = table(spark, d, "ledger").where("coalesce(id, '') != ''").select("id").distinct().withColumn("_l", F.lit(True))
    return table(spark, d, "pool").select("row_no", "id").join(listed, "id", "left").select("row_no", F.when(F.col("_l"), "ledger").otherwise("open").alias("state"))


@query("""WITH i AS (SELECT DISTINCT row_no FROM pool), r AS (SELECT DISTINCT row_no FROM quality_score WHERE score IS NOT NULL)
SELECT CASE WHEN i.row_no IS NULL THEN 'unknown' WHEN r.row_no IS NULL THEN 'omitted' ELSE 'matched' END AS outcome, count(*) AS n FROM i FULL JOIN r ON i.row_no = r.row_no GROUP BY 1""")
def ratings_matched(spark: SparkSession, d: str) -> DataFrame:
    got = state.matched(table(spark, d, "pool"), table(spark, d, "quality_score").where("score is not null"), "row_no")
    return got.groupBy("outcome").agg(F.count("*").alias("n"))


@query(f"WITH {_SPLIT} SELECT outcome, count(*) AS n, list_sort(list(row_no))[1:3] AS samples FROM o GROUP BY 1")
def outcome_samples(spark: SparkSession, d: str) -> DataFrame:
    batch, held, ledger = _batch(spark, d)
    return state.samples(state.admitted(batch, state.current(held), ledger), "outcome", "row_no")


# ---- days


@query(r"""WITH f AS (SELECT row_no, trim(coalesce(date, '')) AS t FROM pool), m AS (SELECT row_no, t,
  try_cast(regexp_extract(t, '\b(20\d{2}-\d{2}-\d{2})', 1) AS DATE) AS iso,
  regexp_extract(t, '(?i)\b(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?\s+(\d{1,2})(?:\s*[–-]\s*\d{1,2})?,?\s+(20\d{2})\b', ['m', 'd', 'y']) AS n,
  regexp_extract(t, '(?i)\b(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*,?\s+(\d{1,2})\s+(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?,?\s+(20\d{2})\b', ['d', 'm', 'y']) AS w,
  regexp_extract(t, '\b(\d{1,2})/(\d{1,2})/(20\d{2})\b', ['m', 'd', 'y']) AS s FROM f)
SELECT row_no, coalesce(iso, try_strptime(n.m || ' ' || n.d || ' ' || n.y, '%b %d %Y')::DATE, try_strptime(w.m || ' ' || w.d || ' ' || w.y, '%b %d %Y')::DATE, try_strptime(s.m || ' ' || s.d || ' ' || s.y, '%m %d %Y')::DATE) AS day FROM m""")
def date_texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", dates.date_text(F.col("date")).alias("day"))


@query(f"""WITH r AS (SELECT row_no, {S.day('date')} AS day FROM pool)
SELECT row_no, day IS NULL OR day >= DATE '{AS_OF}' - 7 AS recent, CASE WHEN day IS NULL THEN 'UNKNOWN' WHEN day BETWEEN DATE '{AS_OF}' + 2 AND DATE '{AS_OF}' + 30 THEN 'soon' ELSE 'out' END AS event FROM r""")
def recency(spark: SparkSession, d: str) -> DataFrame:
    """Whether a row is of the last seven days, and whether its day lies in the window of events; undated rows pass."""
    day = day_of(F.col("date"))
    return table(spark, d, "pool").select("row_no", dates.recent(day, AS_OF, 7).alias("recent"), dates.event_window(day, AS_OF).alias("event"))


@query(f"SELECT theme, slug, date FROM digest WHERE date < DATE '{AS_OF}' - 10 AND NOT coalesce(starred, false)")
def digests_past_retention(spark: SparkSession, d: str) -> DataFrame:
    """Digests older than ten days without a star: a list, nothing is deleted."""
    old = F.col("date") < F.date_sub(F.lit(AS_OF).cast("date"), 10)
    return table(spark, d, "digest").where(old & ~F.coalesce("starred", F.lit(False))).select("theme", "slug", "date")


@query(f"""WITH p AS (SELECT {S.day('first_seen')} AS day FROM pool), l AS (SELECT count(*) FILTER (status = 'published') AS published, count(*) FILTER (status IN ('expired', 'over_cap')) AS retired FROM ledger)
SELECT (SELECT count(*) FROM pool) AS pool, published, retired, (SELECT min(day) FROM p) AS oldest, (SELECT max(day) FROM p) AS newest, date_diff('day', (SELECT max(day) FROM p), DATE '{AS_OF}') > 2 AS stale FROM l""")
def pool_health(spark: SparkSession, d: str) -> DataFrame:
    day, s = day_of(F.col("first_seen")), F.col("status")
    left = table(spark, d, "pool").agg(F.count("*").alias("pool"), F.min(day).alias("oldest"), F.max(day).alias("newest"))
    right = table(spark, d, "ledger").agg(F.count_if(s == "published").alias("published"), F.count_if(s.isin("expired", "over_cap")).alias("retired"))
    return left.join(F.broadcast(right), F.lit(True)).select("pool", "published", "retired", "oldest", "newest", (F.datediff(F.lit(AS_OF).cast("date"), "newest") > 2).alias("stale"))


# ---- signals of users as a key-value state


@query("""WITH e AS (SELECT user_id, event_type, arg_max(value, ts) AS v, max(ts) AS ts, ts >= TIMESTAMP '2024-01-16' AS late, arg_max(value < 20, ts) AS del FROM events GROUP BY user_id, event_type, ts >= TIMESTAMP '2024-01-16'),
h AS (SELECT * FROM e WHERE NOT late AND NOT del), n AS (SELECT * FROM e WHERE late)
SELECT coalesce(h.user_id, n.user_id) AS user_id, coalesce(h.event_type, n.event_type) AS event_type, CASE WHEN n.user_id IS NOT NULL THEN CASE WHEN n.del THEN NULL ELSE n.v END ELSE h.v END AS value
FROM h FULL JOIN n ON h.user_id = n.user_id AND h.event_type = n.event_type WHERE CASE WHEN n.user_id IS NOT NULL THEN NOT n.del ELSE true END""")
def state_updated(spark: SparkSession, d: str) -> DataFrame:
    """The state of the first half of the events after the changes of the second; values below 20 count as empty and delete."""
    e = table(spark, d, "events").select("user_id", "event_type", F.when(F.col("value") >= 20, F.col("value")).alias("value"), "ts")
    at = F.lit("2024-01-16").cast("timestamp_ntz")
    key = ["user_id", "event_type"]
    held = state.updated(e.limit(0), e.where(F.col("ts") < at), key, "value", "ts")
    return state.updated(held, e.where(F.col("ts") >= at), key, "value", "ts").select(*key, "value")


@query("""WITH a AS (SELECT theme, slug, len(actions."try") AS t, len(actions.share) AS s FROM digest)
SELECT d.theme, d.slug, coalesce(starred, false) AS starred, coalesce(t, 0) > 0 AS noted, coalesce(s, 0) > 0 AS done FROM digest d JOIN a USING (theme, slug)""")
def digest_boosts(spark: SparkSession, d: str) -> DataFrame:
    """Flags of every digest: signals of its actions are gathered once a digest before they are joined."""
    rows = table(spark, d, "digest")
    kinds = digests.actions(rows).groupBy("theme", "slug").agg(F.bool_or(F.col("type") == "try").alias("noted"), F.bool_or(F.col("type") == "share").alias("done"))
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)).alias(c)
    return rows.select("theme", "slug", "starred").join(kinds, ["theme", "slug"], "left").select("theme", "slug", flag("starred"), flag("noted"), flag("done"))


# ---- order and sets


@query(f"""WITH d AS (SELECT *, {S.day('first_seen')} AS day FROM pool)
SELECT row_no, row_number() OVER (ORDER BY day, coalesce(trim(entity), '') <> '', row_no) AS place FROM d WHERE day IS NOT NULL""")
def repositories_last(spark: SparkSession, d: str) -> DataFrame:
    """All days' rows in order, in each day those about a repository after the others, else as they came."""
    rows = table(spark, d, "pool").select("row_no", day_of(F.col("first_seen")).alias("day"), (F.trim(F.coalesce("entity", F.lit(""))) != "").alias("repo")).where("day is not null")
    return select.global_rank(rows, [F.asc("day"), F.asc("repo"), F.asc("row_no")]).select("row_no", F.col("place").cast("bigint").alias("place"))


@query(f"""WITH d AS (SELECT *, {S.day('first_seen')} AS day FROM pool)
SELECT day, coalesce(source, '') AS source, count(*) AS n, coalesce(min(pos) = 1 AND max(pos) = count(*) AND count(DISTINCT pos) = count(*), false) AS sequential FROM d WHERE day IS NOT NULL GROUP BY 1, 2""")
def positions_sequential(spark: SparkSession, d: str) -> DataFrame:
    """Whether the positions of a source's day are 1 to n, each once: by aggregates, no rows are put in order."""
    rows = table(spark, d, "pool").select(day_of(F.col("first_seen")).alias("day"), F.coalesce("source", F.lit("")).alias("source"), "pos").where("day is not null")
    whole = (F.min("pos") == 1) & (F.max("pos") == F.count("*")) & (F.count_distinct("pos") == F.count("*"))
    return rows.groupBy("day", "source").agg(F.count("*").alias("n"), F.coalesce(whole, F.lit(False)).alias("sequential"))


@query("""SELECT origin, count(*) AS n, count(url) AS with_url FROM (SELECT 'pool' AS origin, url FROM pool UNION ALL SELECT 'ledger', url FROM ledger UNION ALL SELECT 'checks', url FROM link_status) GROUP BY 1""")
def addresses_together(spark: SparkSession, d: str) -> DataFrame:
    """The bag of all tables' addresses; nothing falls together."""
    one = lambda t, name: table(spark, d, t).select(F.lit(name).alias("origin"), "url")
    return one("pool", "pool").unionByName(one("ledger", "ledger")).unionByName(one("link_status", "checks")).groupBy("origin").agg(F.count("*").alias("n"), F.count("url").alias("with_url"))
