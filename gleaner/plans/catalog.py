"""Every query of the core, by name, with the SQL that DuckDB checks it against. Each runs over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleaner.functions import text, tokens, url
from gleaner.functions.dates import day_of
from gleaner.operators import digests, pool, select
from gleaner.plans import sql as S
from gleaner.session import ship
from gleaner.sources import files

Query = Callable[[SparkSession, str], DataFrame]
AS_OF = "2026-09-20"
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle is not None:
            SQL[f.__name__] = oracle
        return f

    return add


def queries() -> dict[str, Query]:
    from gleaner.plans import transitions  # noqa: F401  registers its queries

    return QUERIES


def oracle_sql() -> dict[str, str]:
    from gleaner.plans import transitions  # noqa: F401

    return SQL


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# ---- addresses


@query(f"WITH {S.PARTS} SELECT row_no, page, CASE WHEN page = '' THEN '' ELSE sha256(page)[1:12] END AS item FROM ident")
def url_identity(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", url.normalize_url(F.col("url")).alias("page"), url.item_id(F.col("url")).alias("item"))


@query(f"""WITH {S.PARTS} SELECT row_no, CASE WHEN query = '' THEN u ELSE regexp_extract(u, '(?s)^([^?#]*)', 1)
  || (CASE WHEN kept <> '' THEN '?' || kept ELSE '' END) || (CASE WHEN frag <> '' THEN '#' || frag ELSE '' END) END AS shown FROM ident""")
def url_display(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", url.display_url(F.col("url")).alias("shown"))


@query("SELECT count(*) AS n, count(*) AS minimal FROM pool")
def url_changes_minimal(spark: SparkSession, d: str) -> DataFrame:
    """Every display address is its original without tracking parameters and nothing else."""
    ok = url.minimal_change(F.col("url"), url.display_url(F.col("url")))
    return table(spark, d, "pool").agg(F.count("*").alias("n"), F.count_if(ok).alias("minimal"))


@query(f"""WITH {S.PARTS} SELECT coalesce(CASE WHEN u = '' THEN 'empty' WHEN scheme NOT IN ('http', 'https') THEN 'scheme'
  WHEN host = '' THEN 'no_host' WHEN NOT contains(host, '.') THEN 'no_dot' END, 'safe') AS reason, count(*) AS n FROM ident GROUP BY 1""")
def url_safety(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").groupBy(F.coalesce(url.unsafe_reason(F.col("url")), F.lit("safe")).alias("reason")).agg(F.count("*").alias("n"))


DOMAIN = "CASE WHEN len(labels) > 2 THEN array_to_string(labels[-2:], '.') ELSE h END"


@query(f"""WITH {S.PARTS}, h AS (SELECT row_no, regexp_replace(auth, '^www\\.', '') AS h FROM ident),
l AS (SELECT h, list_filter(string_split(h, '.'), lambda x: x <> '') AS labels FROM h)
SELECT {DOMAIN} AS domain, count(*) AS n FROM l GROUP BY 1""")
def domain_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").groupBy(url.domain_of(F.col("url")).alias("domain")).agg(F.count("*").alias("n"))


@query(f"WITH {S.PARTS} SELECT page, min(row_no) AS first_row, count(*) AS copies FROM ident WHERE page <> '' GROUP BY 1")
def pages_distinct(spark: SparkSession, d: str) -> DataFrame:
    page = url.normalize_url(F.col("url"))
    return table(spark, d, "pool").select("row_no", page.alias("page")).where("page != ''").groupBy("page").agg(F.min("row_no").alias("first_row"), F.count("*").alias("copies"))


# ---- texts


@query(f"SELECT row_no, {S.cleaned('title')} AS title, {S.cleaned('summary')} AS summary FROM pool")
def text_cleaned(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", text.clean_text(F.col("title")).alias("title"), text.clean_text(F.col("summary")).alias("summary"))


@query(f"""WITH s AS (SELECT row_no, {S.sanitised('summary')} AS s FROM pool)
SELECT row_no, CASE WHEN trim({S.last_sentence('s')}) <> '' THEN trim({S.last_sentence('s')}) ELSE s END AS summary FROM s""")
def summary_sanitised(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", text.sanitise_summary(F.col("summary")).alias("summary"))


@query(rf"""WITH t AS (SELECT row_no, regexp_replace(regexp_replace(coalesce(summary, ''), '^{S.WHITE}', ''), '{S.WHITE}$', '') AS t FROM pool),
e AS (SELECT row_no, t, trim({S.last_sentence('substr(t, 1, 300)')}) AS ended, substr(t, 1, 299) AS head FROM t),
w AS (SELECT *, regexp_replace(CASE WHEN contains(head, ' ') THEN regexp_replace(head, '(?s) [^ ]*$', '') ELSE head END, '[,;:—\- ]+$', '') AS words FROM e)
SELECT row_no, CASE WHEN length(t) <= 300 THEN t WHEN length(ended) >= 60 THEN ended ELSE (CASE WHEN words <> '' THEN words ELSE head END) || '…' END AS quote FROM w""")
def quotes_trimmed(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", text.trim_quote(F.col("summary")).alias("quote"))


@query(f"WITH t AS (SELECT unnest({S.TOKENS.format(c='title')}) AS token FROM pool) SELECT token, count(*) AS titles FROM t GROUP BY 1")
def title_tokens(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select(F.explode(tokens.title_tokens(F.col("title"))).alias("token")).groupBy("token").agg(F.count("*").alias("titles"))


@query(rf"""SELECT doc_id, len({S.WORDS.format(c='text')}) AS words, len(list_distinct(list_transform(list_filter(list_transform(
  regexp_extract_all(coalesce(text, ''), '\d[\d,]*(?:\.\d+)?%?'), lambda t: replace(t, ',', '')), lambda t: NOT regexp_full_match(t, '(?:19|20)\d{{2}}')),
  lambda t: regexp_replace(t, '%+$', '')))) AS numbers FROM documents""")
def document_claims(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", F.size(tokens.words(F.col("text"))).alias("words"), F.size(tokens.numbers(F.col("text"))).alias("numbers"))


_RUNS = "CASE WHEN len({w}) >= 2 THEN list_distinct(list_transform(range(1, len({w})), lambda i: array_to_string({w}[i:i+1], ' '))) ELSE [] END"


@query(f"""WITH w AS (SELECT row_no, {S.WORDS.format(c='title')} AS a, {S.WORDS.format(c='summary')} AS b FROM pool),
r AS (SELECT row_no, {_RUNS.format(w='a')} AS x, {_RUNS.format(w='b')} AS y FROM w)
SELECT row_no, CASE WHEN len(x) > 0 THEN round(len(list_intersect(x, y)) / len(x), 9) ELSE 0.0 END AS overlap FROM r""")
def title_in_summary(spark: SparkSession, d: str) -> DataFrame:
    """The share of the title's two-word runs that the summary holds."""
    return table(spark, d, "pool").select("row_no", F.round(tokens.shingle_overlap(F.col("title"), F.col("summary"), 2), 9).alias("overlap"))


@query()
def longest_copied_run(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").select("row_no", tokens.longest_run(tokens.words(F.col("title")), tokens.words(F.col("summary"))).alias("run"))


@query(r"""WITH a AS (SELECT row_no, unnest(list_distinct(regexp_extract_all(lower(coalesce(title, '')), '[a-z0-9]+(?:\.[a-z0-9]+)+|[a-z0-9]+'))) AS w FROM pool),
b AS (SELECT DISTINCT row_no, unnest(regexp_extract_all(lower(coalesce(summary, '')), '[a-z0-9]+(?:\.[a-z0-9]+)+|[a-z0-9]+')) AS w FROM pool)
SELECT count(*) AS title_words, count(b.w) AS found FROM a LEFT JOIN b ON a.row_no = b.row_no AND a.w = b.w""")
def words_sourced(spark: SparkSession, d: str) -> DataFrame:
    own, src = F.array_distinct(tokens.words(F.col("title"))), tokens.words(F.col("summary"))
    return table(spark, d, "pool").select(F.size(own).alias("n"), F.size(F.array_intersect(own, src)).alias("f")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("title_words"), F.coalesce(F.sum("f"), F.lit(0)).alias("found")
    )


# ---- pool and ledger

_BODY = f"CASE WHEN trim({S.last_sentence('s')}) <> '' THEN length(trim({S.last_sentence('s')})) ELSE length(s) END"


@query(f"""WITH s AS (SELECT *, {S.sanitised('summary')} AS s, CASE WHEN coalesce(id, '') <> '' THEN id ELSE '#' || row_no END AS k FROM pool),
b AS (SELECT *, {_BODY} AS body FROM s)
SELECT min(row_no) AS row_no, arg_min(coalesce(id, '∅'), row_no) AS id, arg_min(coalesce(title, '∅'), row_no) AS title,
  coalesce(arg_max(coalesce(summary, '∅'), (body, -row_no)), '∅') AS summary, arg_min(entity, row_no) FILTER (coalesce(entity, '') <> '') AS entity, count(*) AS copies FROM b GROUP BY k""")
def batch_collapsed(spark: SparkSession, d: str) -> DataFrame:
    fill = lambda c: F.coalesce(c, F.lit("∅")).alias(c)
    return pool.collapse_batch(table(spark, d, "pool")).select("row_no", fill("id"), fill("title"), fill("summary"), "entity", "copies")


@query("""WITH f AS (SELECT id, min(row_no) AS r FROM pool WHERE coalesce(id, '') <> '' GROUP BY 1), l AS (SELECT DISTINCT id FROM ledger WHERE coalesce(id, '') <> '')
SELECT CASE WHEN coalesce(p.id, '') = '' THEN 'no_id' WHEN l.id IS NOT NULL THEN 'ledger' WHEN f.r < p.row_no THEN 'repeat' ELSE 'added' END AS outcome, count(*) AS n
FROM pool p LEFT JOIN f ON f.id = p.id LEFT JOIN l ON l.id = p.id GROUP BY 1""")
def ingest_outcomes(spark: SparkSession, d: str) -> DataFrame:
    return pool.outcomes(table(spark, d, "pool"), table(spark, d, "ledger")).groupBy("outcome").agg(F.count("*").alias("n"))


@query("SELECT lower(trim(entity)) AS entity, max(coalesce(nullif(trim(published), ''), date)) AS day FROM ledger WHERE trim(coalesce(entity, '')) <> '' GROUP BY 1")
def ledger_entities(spark: SparkSession, d: str) -> DataFrame:
    return pool.ledger_index(table(spark, d, "ledger"))


@query(f"""WITH i AS (SELECT lower(trim(entity)) AS entity, try_cast(max(coalesce(nullif(trim(published), ''), date)) AS DATE) AS last FROM ledger WHERE trim(coalesce(entity, '')) <> '' GROUP BY 1),
p AS (SELECT row_no, lower(trim(entity)) AS entity, {S.day('first_seen')} AS seen FROM pool WHERE trim(coalesce(entity, '')) <> '')
SELECT row_no, p.entity, date_diff('day', last, seen) AS days FROM p JOIN i ON p.entity = i.entity WHERE last IS NOT NULL AND seen IS NOT NULL""")
def entity_recency(spark: SparkSession, d: str) -> DataFrame:
    return pool.days_since_entity(table(spark, d, "pool"), table(spark, d, "ledger"))


@query(f"""WITH p AS (SELECT row_no, coalesce(id, '') AS id, coalesce(first_seen, '') AS raw, date_diff('day', coalesce(CASE WHEN regexp_full_match(first_seen, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN try_cast(first_seen AS DATE) END, DATE '{AS_OF}'), DATE '{AS_OF}') > 14 AS old FROM pool),
t AS (SELECT row_no FROM p WHERE NOT old ORDER BY raw DESC, id DESC, row_no LIMIT 600)
SELECT row_no, id, CASE WHEN old THEN 'expired' WHEN row_no IN (SELECT row_no FROM t) THEN 'kept' ELSE 'over_cap' END AS status FROM p""")
def pool_pruned(spark: SparkSession, d: str) -> DataFrame:
    return pool.prune(table(spark, d, "pool"), AS_OF)


_ARRIVALS = f"""r AS (SELECT row_no, {S.day('first_seen')} AS day, nullif(id, '') AS id, source FROM pool),
f AS (SELECT id, min(struct_pack(day := day, row_no := row_no)) AS f FROM r WHERE day IS NOT NULL AND id IS NOT NULL GROUP BY 1),
n AS (SELECT r.day, count(*) AS new, count(DISTINCT nullif(r.source, '')) AS sources FROM f JOIN r ON r.row_no = f.f.row_no GROUP BY 1),
a AS (SELECT e.day, fetched, coalesce(new, 0) AS new, coalesce(sources, 0) AS sources, e.day = min(e.day) OVER () AS cold_start
  FROM (SELECT day, count(*) AS fetched FROM r WHERE day IS NOT NULL GROUP BY 1) e LEFT JOIN n USING (day))"""


@query(f"WITH {_ARRIVALS} SELECT * FROM a")
def daily_arrivals(spark: SparkSession, d: str) -> DataFrame:
    return pool.arrivals(table(spark, d, "pool"))


@query(f"WITH {_ARRIVALS} SELECT count(*) AS days, round(avg(new), 2) AS mean, median(new) AS median, min(new) AS least, max(new) AS most FROM a WHERE NOT cold_start")
def supply(spark: SparkSession, d: str) -> DataFrame:
    return pool.supply(daily_arrivals(spark, d))


@query(f"""WITH n AS (SELECT {S.day('first_seen')} AS day, source, count(*) AS n FROM pool WHERE source IS NOT NULL GROUP BY 1, 2)
SELECT day, arg_min(source, (-n, source)) AS source, round(max(n) / sum(n), 3) AS share FROM n WHERE day IS NOT NULL GROUP BY 1""")
def top_sources(spark: SparkSession, d: str) -> DataFrame:
    return pool.top_sources(table(spark, d, "pool"))


@query("""SELECT id, min(struct_pack(d := coalesce(nullif(trim(published), ''), date, ''), u := coalesce(url, ''))).d AS day,
  min(struct_pack(d := coalesce(nullif(trim(published), ''), date, ''), u := coalesce(url, ''))).u AS url, count(*) AS rows FROM ledger WHERE coalesce(id, '') <> '' GROUP BY 1""")
def ledger_rebuilt(spark: SparkSession, d: str) -> DataFrame:
    return pool.rebuild_ledger(table(spark, d, "ledger"))


@query("SELECT coalesce(status, 'published') AS status, count(*) AS n, count(DISTINCT nullif(id, '')) AS ids, min(coalesce(nullif(trim(published), ''), date)) AS oldest FROM ledger GROUP BY 1")
def ledger_status(spark: SparkSession, d: str) -> DataFrame:
    when = F.coalesce(F.nullif(F.trim("published"), F.lit("")), F.col("date"))
    return table(spark, d, "ledger").groupBy(F.coalesce("status", F.lit("published")).alias("status")).agg(
        F.count("*").alias("n"), F.count_distinct(F.nullif("id", F.lit(""))).alias("ids"), F.min(when).alias("oldest")
    )


# ---- ranking and choosing

_ORD = "coalesce(CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') THEN date_diff('day', DATE '0001-01-01', try_cast({c} AS DATE)) + 1 END, 0)"
_RANKED = f"""{S.PARTS}, dm AS (SELECT row_no, CASE WHEN len(labels) > 2 THEN array_to_string(labels[-2:], '.') ELSE h END AS domain FROM (
  SELECT row_no, h, list_filter(string_split(h, '.'), lambda x: x <> '') AS labels FROM (SELECT row_no, regexp_replace(auth, '^www\\.', '') AS h FROM ident))),
r0 AS (SELECT p.row_no, {S.day('p.first_seen')} AS day, coalesce(s.tier, 9) AS tier, s.shortlist_per_source AS source_cap, coalesce(p.source, '') AS source, dm.domain,
  {_ORD.format(c='p.first_seen')} AS seen, {_ORD.format(c='p.date')} AS dated, coalesce(p.id, '') AS key FROM pool p LEFT JOIN source_dim s ON s.name = p.source JOIN dm USING (row_no)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY day ORDER BY tier, seen DESC, dated DESC, key, row_no) AS place FROM r0 WHERE day IS NOT NULL)"""


@query(f"WITH {_RANKED} SELECT row_no, day, tier, place FROM ranked")
def ranked_by_day(spark: SparkSession, d: str) -> DataFrame:
    return select.ranked(table(spark, d, "pool"), table(spark, d, "source_dim")).select("row_no", "day", "tier", "place")


@query(f"""WITH RECURSIVE {_RANKED}, walk AS (
  SELECT day, 0::BIGINT AS place, 0 AS picks, NULL::BIGINT AS taken, MAP {{}}::MAP(VARCHAR, INT) AS by_source, MAP {{}}::MAP(VARCHAR, INT) AS by_domain FROM (SELECT DISTINCT day FROM ranked)
  UNION ALL
  SELECT w.day, w.place + 1, CASE WHEN ok THEN picks + 1 ELSE picks END, CASE WHEN ok THEN row_no END,
    CASE WHEN ok THEN map_concat(by_source, MAP {{source: coalesce(by_source[source], 0) + 1}}) ELSE by_source END,
    CASE WHEN ok THEN map_concat(by_domain, MAP {{domain: coalesce(by_domain[domain], 0) + 1}}) ELSE by_domain END
  FROM (SELECT w.*, r.row_no, r.source, r.domain, coalesce(w.by_source[r.source], 0) < coalesce(r.source_cap, 2) AND coalesce(w.by_domain[r.domain], 0) < 3 AS ok
    FROM walk w JOIN ranked r ON r.day = w.day AND r.place = w.place + 1 WHERE w.picks < 20) w)
SELECT day, taken AS row_no, picks AS pick FROM walk WHERE taken IS NOT NULL""")
def diverse_shortlist(spark: SparkSession, d: str) -> DataFrame:
    return select.diversify(select.orderable(table(spark, d, "pool"), table(spark, d, "source_dim")))


_NEAR = f"""t AS (SELECT row_no, {S.day('first_seen')} AS day, list_sort({S.TOKENS.format(c='title')}) AS tokens FROM pool),
s AS (SELECT day, tokens, min(row_no) AS row_no FROM t WHERE day IS NOT NULL AND len(tokens) > 0 GROUP BY 1, 2),
x AS (SELECT day, row_no, len(tokens) AS n, unnest(tokens) AS token FROM s),
c AS (SELECT a.row_no AS a, b.row_no AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c FROM x a JOIN x b ON a.day = b.day AND a.token = b.token AND a.row_no < b.row_no GROUP BY 1, 2),
near AS (SELECT a, b, round(c / (na + nb - c), 6) AS similarity FROM c WHERE c / (na + nb - c) >= 0.6)"""


@query(f"WITH {_NEAR} SELECT * FROM near")
def near_titles(spark: SparkSession, d: str) -> DataFrame:
    return select.near_titles(table(spark, d, "pool"))


@query(f"""WITH RECURSIVE {_NEAR}, e AS (SELECT a, b FROM near UNION SELECT b, a FROM near),
reach AS (SELECT a AS row_no, a AS other FROM e UNION SELECT r.row_no, e.b FROM reach r JOIN e ON e.a = r.other)
SELECT row_no, min(other) AS cluster FROM reach GROUP BY 1""")
def title_clusters(spark: SparkSession, d: str) -> DataFrame:
    return select.clusters(near_titles(spark, d))


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_totalprice DESC, o_orderkey) AS place FROM orders")
def global_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    return select.global_rank(rows, [F.desc("o_totalprice"), F.asc("o_orderkey")]).select("o_orderkey", "place")


_LEFT = f"SELECT DISTINCT s.theme, {S.day('first_seen')} AS day FROM pool, (SELECT DISTINCT theme FROM digest) s"


@query(f"""WITH l AS ({_LEFT}), g AS (SELECT DISTINCT theme, date AS day FROM digest)
SELECT l.theme, l.day, max(g.day) FILTER (g.day < l.day) AS earlier, min(g.day) FILTER (g.day > l.day) AS later FROM l JOIN g USING (theme) WHERE l.day IS NOT NULL GROUP BY 1, 2""")
def nearest_digests(spark: SparkSession, d: str) -> DataFrame:
    """For every theme and day of the pool the digests nearest before and after."""
    held = table(spark, d, "digest").select("theme", F.col("date").alias("day")).distinct()
    days = table(spark, d, "pool").select(day_of(F.col("first_seen")).alias("day")).where("day is not null").distinct()
    left = held.select("theme").distinct().join(days, F.lit(True))  # themes times days of the calendar
    return select.nearest_days(left, held)


# ---- digests and links

_ACTIONS = """a AS (
  SELECT theme, slug, 'try' AS type, i - 1 AS idx, actions."try"[i] AS text FROM digest, range(1, 1000) r(i) WHERE i <= len(actions."try")
  UNION ALL SELECT theme, slug, 'share', i - 1, actions.share[i].what || ' → ' || actions.share[i].who FROM digest, range(1, 1000) r(i) WHERE i <= len(actions.share)
  UNION ALL SELECT theme, slug, 'read', i - 1, actions.readDeeper[i] FROM digest, range(1, 1000) r(i) WHERE i <= len(actions.readDeeper)
  UNION ALL SELECT theme, slug, 'skip', i - 1, actions.skip[i] FROM digest, range(1, 1000) r(i) WHERE i <= len(actions.skip))"""


@query(f"WITH {_ACTIONS} SELECT * FROM a")
def digest_actions(spark: SparkSession, d: str) -> DataFrame:
    return digests.actions(table(spark, d, "digest"))


@query(f"WITH {_ACTIONS} SELECT theme, type, count(*) AS n FROM a GROUP BY 1, 2")
def theme_actions(spark: SparkSession, d: str) -> DataFrame:
    return digest_actions(spark, d).groupBy("theme", "type").agg(F.count("*").alias("n"))


@query("""SELECT theme, slug, coalesce(len(actions."try"), 0) + coalesce(len(actions.share), 0) AS pending, coalesce(len(sources), 0) AS n_sources, itemCount AS stated FROM digest""")
def digest_pending(spark: SparkSession, d: str) -> DataFrame:
    return digests.pending(table(spark, d, "digest"))


@query("""WITH r AS (SELECT theme, slug, row_number() OVER (PARTITION BY theme ORDER BY date DESC, slug) AS r FROM digest),
o AS (SELECT a.theme, a.slug, b.slug AS other, row_number() OVER (PARTITION BY a.theme, a.slug ORDER BY b.r) AS place FROM r a JOIN r b ON a.theme = b.theme AND a.slug <> b.slug WHERE b.r <= 5)
SELECT theme, slug, place, other FROM o WHERE place <= 4""")
def related_digests(spark: SparkSession, d: str) -> DataFrame:
    return digests.related(table(spark, d, "digest"))


@query("""SELECT theme, slug, date, round(coalesce(CASE theme WHEN 'ai' THEN 1.0 WHEN 'tech' THEN 0.8 WHEN 'leadership' THEN 0.6 WHEN 'local-llm' THEN 0.9 WHEN 'harbour-events' THEN 0.4 END, 0.0)::DOUBLE
  * pow(0.5, date_diff('day', date, (SELECT max(date) FROM digest)) / 14.0) * (1 + CASE WHEN starred THEN 0.5 ELSE 0.0 END), 9) AS score FROM digest""")
def decayed_scores(spark: SparkSession, d: str) -> DataFrame:
    return digests.decayed(table(spark, d, "digest"))


_COVER = """c AS (SELECT t.theme, d.day::DATE AS day FROM (SELECT DISTINCT theme FROM digest) t, (SELECT unnest(generate_series(min(date), max(date), INTERVAL 1 DAY)) AS day FROM digest) d),
v AS (SELECT c.theme, c.day, count(g.slug) AS digests, isodow(c.day) <= 6 AS due FROM c LEFT JOIN digest g ON g.theme = c.theme AND g.date = c.day GROUP BY 1, 2)"""


@query(f"WITH {_COVER} SELECT * FROM v")
def coverage_calendar(spark: SparkSession, d: str) -> DataFrame:
    return digests.coverage(table(spark, d, "digest"))


@query(f"""WITH {_COVER} SELECT theme, count(*) FILTER (due) AS due, count(*) FILTER (due AND digests > 0) AS covered, count(*) FILTER (due AND digests = 0) AS missed,
  coalesce(array_to_string(list_transform(list_sort(list(day) FILTER (due AND digests = 0))[1:3], lambda x: x::VARCHAR), ','), '') AS first_missed FROM v GROUP BY 1""")
def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    return digests.gaps(coverage_calendar(spark, d))


@query("""WITH d AS (SELECT unnest(generate_series(max(date) - 20, max(date), INTERVAL 1 DAY))::DATE AS day FROM digest)
SELECT d.day, count(g.slug) AS digests, count(DISTINCT g.theme) AS themes FROM d LEFT JOIN digest g ON g.date = d.day GROUP BY 1""")
def cadence(spark: SparkSession, d: str) -> DataFrame:
    return digests.cadence(table(spark, d, "digest"))


@query("""SELECT isoyear(date) || '-W' || lpad(week(date)::VARCHAR, 2, '0') AS week, count(*) AS digests, sum(coalesce(itemCount, 0))::BIGINT AS items, count(*) FILTER (starred) AS starred FROM digest GROUP BY 1""")
def iso_weeks(spark: SparkSession, d: str) -> DataFrame:
    return digests.weeks(table(spark, d, "digest"))


_VERDICT = """v AS (SELECT url, CASE WHEN coalesce(bool_or(status BETWEEN 200 AND 399), false) THEN 'alive' WHEN coalesce(bool_or(status IN (404, 410)), false) THEN 'dead' ELSE 'unknown' END AS verdict,
  count(*) AS checks, max(redirects) AS redirects FROM link_status GROUP BY 1)"""


@query(f"WITH {_VERDICT} SELECT * FROM v")
def link_verdicts(spark: SparkSession, d: str) -> DataFrame:
    return digests.verdicts(table(spark, d, "link_status"))


@query(f"""WITH {_VERDICT}, tv AS (SELECT trim(url) AS url, min(verdict) AS verdict FROM v GROUP BY 1),
m AS (SELECT row_no, coalesce(source, '') AS source, coalesce(verdict = 'dead', false) AS dead FROM pool p LEFT JOIN tv ON tv.url = trim(p.url)),
s AS (SELECT *, bool_and(dead) OVER (PARTITION BY source) AS all_dead FROM m) SELECT row_no, source, dead FROM s WHERE NOT dead OR all_dead""")
def live_links(spark: SparkSession, d: str) -> DataFrame:
    return digests.without_dead(table(spark, d, "pool"), link_verdicts(spark, d))


_CITED = f"""{S.PARTS}, s AS (SELECT theme, slug, unnest(sources).url AS url FROM digest),
su AS (SELECT theme, slug, url, regexp_extract(trim(coalesce(url, '')), '(?s)^(?:([A-Za-z][A-Za-z0-9+.\\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\\?([^#]*))?(?:#(.*))?$', ['scheme', 'auth', 'path', 'query', 'frag']) AS x FROM s),
sp AS (SELECT theme, slug, url, lower(x.auth) AS auth, (CASE WHEN x.scheme <> '' THEN lower(x.scheme) || ':' ELSE '' END) || (CASE WHEN x.auth <> '' THEN '//' || lower(x.auth) ELSE '' END) || regexp_replace(x.path, '/+$', '')
  || (CASE WHEN list_filter(string_split(x.query, '&'), lambda q: q <> '' AND NOT starts_with(lower(q), 'utm_')) <> [] THEN '?' || array_to_string(list_filter(string_split(x.query, '&'), lambda q: q <> '' AND NOT starts_with(lower(q), 'utm_')), '&') ELSE '' END) AS page FROM su)"""


@query(f"WITH {_CITED} SELECT theme, slug, url FROM sp WHERE page NOT IN (SELECT i.page FROM ident i JOIN pool USING (row_no) WHERE pool.url IS NOT NULL)")
def dangling_citations(spark: SparkSession, d: str) -> DataFrame:
    return digests.dangling(table(spark, d, "digest"), table(spark, d, "pool"))


@query(f"""WITH {_CITED}, h AS (SELECT theme, slug, regexp_replace(auth, '^www\\.', '') AS h FROM sp), l AS (SELECT *, list_filter(string_split(h, '.'), lambda x: x <> '') AS labels FROM h)
SELECT {DOMAIN} AS domain, count(*) AS citations, count(DISTINCT (theme, slug)) AS digests FROM l GROUP BY 1""")
def cited_domains(spark: SparkSession, d: str) -> DataFrame:
    return digests.cited_domains(table(spark, d, "digest"))


@query("""WITH r AS (SELECT lower(full_name) AS entity, max(struct_pack(p := coalesce(pushed_at, TIMESTAMP '1970-01-01'), s := coalesce(stargazers_count, -1))) AS m, count(*) AS asked FROM repo_api WHERE full_name IS NOT NULL GROUP BY 1)
SELECT p.row_no, r.entity, m.s AS stars, asked FROM pool p JOIN r ON r.entity = regexp_replace(lower(trim(p.entity)), '^[a-z]+:', '')""")
def repositories_enriched(spark: SparkSession, d: str) -> DataFrame:
    """Pool rows of known repositories with the stars of the newest answer; rows without an answer are dropped."""
    repo = table(spark, d, "repo_api").where("full_name is not null").groupBy(F.lower("full_name").alias("entity")).agg(
        F.max(F.struct(F.coalesce("pushed_at", F.lit("1970-01-01").cast("timestamp")).alias("p"), F.coalesce("stargazers_count", F.lit(-1)).alias("s"))).alias("m"), F.count("*").alias("asked")
    )
    rows = table(spark, d, "pool").select("row_no", F.regexp_replace(F.lower(F.trim("entity")), "^[a-z]+:", "").alias("entity"))
    return rows.join(repo, "entity").select("row_no", "entity", F.col("m.s").alias("stars"), "asked")


_HALF = "TIMESTAMP '2024-01-16'"


@query(f"""WITH e AS (SELECT user_id, event_type, max(struct_pack(ts := ts, value := value)) AS r, ts >= {_HALF} AS late FROM events GROUP BY user_id, event_type, ts >= {_HALF}),
h AS (SELECT * FROM e WHERE NOT late), n AS (SELECT * FROM e WHERE late)
SELECT coalesce(h.user_id, n.user_id) AS user_id, coalesce(h.event_type, n.event_type) AS event_type,
  CASE WHEN n.r IS NULL OR (h.r IS NOT NULL AND h.r.ts >= n.r.ts) THEN h.r.value ELSE n.r.value END AS value,
  CASE WHEN h.r IS NULL THEN 'new' WHEN n.r IS NULL OR h.r.ts >= n.r.ts THEN 'retained' ELSE 'updated' END AS outcome
FROM h FULL JOIN n ON h.user_id = n.user_id AND h.event_type = n.event_type""")
def signals_merged(spark: SparkSession, d: str) -> DataFrame:
    """The events of the second half merged into those of the first, by user and type, last writer wins."""
    e = table(spark, d, "events")
    at = F.lit("2024-01-16").cast("timestamp_ntz")
    held, new = (digests.latest(e.where(c), ["user_id", "event_type"], "ts", ["value"]) for c in (F.col("ts") < at, F.col("ts") >= at))
    return digests.upsert(held, new, ["user_id", "event_type"], "ts", ["value"]).select("user_id", "event_type", "value", "outcome")


@query("""SELECT coalesce(kind, '∅') AS kind, count(*) FILTER (lang = 'en') AS en, count(*) FILTER (lang = 'fr') AS fr, count(*) FILTER (lang = 'de') AS de, count(*) FILTER (lang = 'es') AS es, count(*) AS total FROM documents GROUP BY 1""")
def kind_by_language(spark: SparkSession, d: str) -> DataFrame:
    return digests.crosstab(table(spark, d, "documents").withColumn("kind", F.coalesce("kind", F.lit("∅"))), "kind", "lang", ["en", "fr", "de", "es"])


_DIM = "SELECT '{c}' AS dim, count({c}) AS n, min({c})::DOUBLE AS least, max({c})::DOUBLE AS most, (max({c}) - min({c}))::DOUBLE AS spread, round(avg({c}::DOUBLE), 4) AS mean, count(DISTINCT {c}) AS \"values\" FROM lineitem"


@query(" UNION ALL ".join(_DIM.format(c=c) for c in ("l_quantity", "l_discount", "l_tax")))
def dimension_spread(spark: SparkSession, d: str) -> DataFrame:
    return digests.dimensions(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"])


# ---- filters by parameters, quality of tables


@query(f"""WITH p AS (SELECT p.row_no, {S.day('p.first_seen')} AS day, s.name, s.filter_cap FROM pool p JOIN source_dim s ON s.name = p.source
  WHERE s.filter_regex IS NULL OR regexp_matches(coalesce(p.title, '') || ' ' || coalesce(p.summary, ''), '(?i)' || s.filter_regex)),
r AS (SELECT *, row_number() OVER (PARTITION BY day, name ORDER BY row_no) AS place FROM p WHERE day IS NOT NULL)
SELECT row_no, name FROM r WHERE filter_cap IS NULL OR place <= filter_cap""")
def source_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Rows that pass their source's pattern, and of those the first filter_cap of a day."""
    return pool.source_filtered(table(spark, d, "pool"), table(spark, d, "source_dim"))


BLOCKED = ["supplier portal", "Lorem Ipsum", "half-finished"]


@query("""WITH t AS (SELECT row_no, lower(concat_ws(' ', title, summary, url, source)) AS h FROM pool)
SELECT row_no FROM t WHERE contains(h, 'supplier portal') OR contains(h, 'lorem ipsum') OR contains(h, 'half-finished')
  OR contains(replace(h, ' ', ''), 'supplierportal') OR contains(replace(h, ' ', ''), 'loremipsum') OR contains(replace(h, ' ', ''), 'half-finished')""")
def blocked_terms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pool").where(pool.holds_term(["title", "summary", "url", "source"], BLOCKED)).select("row_no")


@query("""WITH t AS (SELECT doc_id, lower(coalesce(text, '')) AS h FROM documents) SELECT doc_id FROM t WHERE contains(h, 'supplier portal') OR contains(h, 'lorem ipsum') OR contains(h, 'half-finished')
  OR contains(replace(h, ' ', ''), 'supplierportal') OR contains(replace(h, ' ', ''), 'loremipsum') OR contains(replace(h, ' ', ''), 'half-finished')""")
def blocked_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where(pool.holds_term(["text"], BLOCKED)).select("doc_id")


@query(f"""WITH {S.PARTS}, a AS (SELECT unnest(list_filter(string_split(query, '&'), lambda q: q <> '')) AS p FROM ident),
b AS (SELECT unnest(list_filter(string_split(query, '&'), lambda q: q <> '' AND NOT starts_with(lower(q), 'utm_'))) AS p FROM ident)
SELECT split_part(p, '=', 1) AS name, count(*) AS removed FROM (SELECT p FROM a EXCEPT ALL SELECT p FROM b) GROUP BY 1""")
def params_removed(spark: SparkSession, d: str) -> DataFrame:
    """Parameters that the display addresses lost, counted as a difference of multisets."""
    rows = table(spark, d, "pool")
    params = lambda u: rows.select(F.explode(F.filter(F.split(url.part(u, 4), "&"), lambda q: q != "")).alias("p"))
    lost = params(url.trimmed(F.col("url"))).exceptAll(params(url.display_url(F.col("url"))))
    return lost.groupBy(F.get(F.split("p", "=", 2), F.lit(0)).alias("name")).agg(F.count("*").alias("removed"))


@query(f"""WITH p AS (SELECT row_no, {S.day('first_seen')} AS day FROM pool), l AS (SELECT DISTINCT day FROM p WHERE day IS NOT NULL ORDER BY day DESC LIMIT 5)
SELECT row_no, day FROM p WHERE day IN (SELECT day FROM l)""")
def latest_batches(spark: SparkSession, d: str) -> DataFrame:
    """The rows of the last five batches that exist."""
    rows = table(spark, d, "pool").select("row_no", day_of(F.col("first_seen")).alias("day"))
    last = rows.where("day is not null").select("day").distinct().orderBy(F.desc("day")).limit(5)
    return rows.join(last, "day", "left_semi").select("row_no", "day")


@query("""WITH b AS (SELECT min(date) AS a, max(date) AS b FROM digest), m AS (SELECT unnest(generate_series(date_trunc('month', a), date_trunc('month', b), INTERVAL 1 MONTH)) AS m FROM b)
SELECT strftime(m, '%Y-%m') AS month, count(g.slug) AS digests FROM m LEFT JOIN digest g ON date_trunc('month', g.date) = m GROUP BY 1""")
def months(spark: SparkSession, d: str) -> DataFrame:
    return digests.by_month(table(spark, d, "digest"))


@query("""SELECT theme, slug, rule FROM (
  SELECT theme, slug, 'count' AS rule FROM digest WHERE itemCount IS DISTINCT FROM len(sources)
  UNION ALL SELECT theme, slug, 'format' FROM digest WHERE format IS NULL OR format NOT IN ('daily', 'weekly')
  UNION ALL SELECT theme, slug, 'tldr' FROM digest WHERE trim(coalesce(tldr, '')) = ''
  UNION ALL SELECT theme, slug, 'title' FROM digest WHERE trim(coalesce(title, '')) = ''
  UNION ALL SELECT theme, slug, 'source_url' FROM digest WHERE len(list_filter(sources, lambda s: NOT regexp_matches(coalesce(s.url, ''), '^https?://'))) > 0)""")
def digest_violations(spark: SparkSession, d: str) -> DataFrame:
    """One row for each rule a digest breaks."""
    return digests.violations(table(spark, d, "digest"))


@query("""SELECT theme, count(*) FILTER (len(actions."try") > 0) AS with_try, count(*) FILTER (len(actions.share) > 0) AS with_share, count(*) FILTER (format = 'weekly') AS weekly,
  count(*) FILTER (date_diff('day', date, m) <= 7) AS week, count(*) FILTER (date_diff('day', date, m) <= 30) AS month FROM digest, (SELECT max(date) AS m FROM digest) GROUP BY 1""")
def digest_listing(spark: SparkSession, d: str) -> DataFrame:
    return digests.listing(table(spark, d, "digest"))


@query("""WITH a AS (SELECT *, 'wl:' || theme || ':' || slug || ':' || type || ':' || idx AS key FROM (
  SELECT theme, slug, 'try' AS type, i - 1 AS idx, actions."try"[i] AS text FROM digest, range(1, 1000) r(i) WHERE i <= len(actions."try")
  UNION ALL SELECT theme, slug, 'share', i - 1, actions.share[i].what || ' → ' || actions.share[i].who FROM digest, range(1, 1000) r(i) WHERE i <= len(actions.share)
  UNION ALL SELECT theme, slug, 'read', i - 1, actions.readDeeper[i] FROM digest, range(1, 1000) r(i) WHERE i <= len(actions.readDeeper)))
SELECT key, theme, slug, type, idx::INT AS idx, text FROM a""")
def signal_keys(spark: SparkSession, d: str) -> DataFrame:
    """Keys of actions written, parsed again and joined back to their texts; skips have no key."""
    acts = digests.actions(table(spark, d, "digest")).where("type != 'skip'")
    keys = acts.select(digests.signal_key("theme", "slug", "type", "idx").alias("key"))
    return digests.signal_texts(digests.parse_keys(keys), acts)


@query()
def names_sourced(spark: SparkSession, d: str) -> DataFrame:
    """Names in titles, and how many of them the summary holds."""
    found = table(spark, d, "pool").select(F.coalesce("summary", F.lit("")).alias("s"), F.explode(tokens.names(F.col("title"), ["the", "why", "how", "can", "from", "and"])).alias("name"))
    return found.agg(F.count("*").alias("names"), F.count_if(F.contains(F.lower("s"), F.lower("name"))).alias("sourced"))


# ---- sources over tables


@query()
def document_frontmatter(spark: SparkSession, d: str) -> DataFrame:
    """The fields of every document's frontmatter; documents without any have null."""
    got = files.frontmatter(table(spark, d, "documents").select("doc_id", "text"), "doc_id")
    return got.select("doc_id", F.array_join(F.array_sort(F.map_keys("fields")), ",").alias("keys"), F.col("fields")["theme"].alias("theme"), "problem")


@query("""SELECT row_no, '**' || coalesce(title, '') || '**' || chr(10) || 'URL: ' || coalesce(url, '')
  || CASE WHEN coalesce(date, '') = '' OR date = 'recent' THEN '' WHEN date = 'UNKNOWN' OR regexp_full_match(date, '\\d{4}-\\d{2}-\\d{2}') THEN chr(10) || 'DATE: ' || date ELSE chr(10) || 'Date: ' || date END
  || CASE WHEN coalesce(summary, '') <> '' THEN chr(10) || 'Summary: ' || summary ELSE '' END AS block FROM pool""")
def prompt_blocks(spark: SparkSession, d: str) -> DataFrame:
    return files.bundles(table(spark, d, "pool").select("row_no", "title", "url", "date", "summary")).select("row_no", "block")


@query("""SELECT event_type, date_trunc('day', ts)::DATE AS day, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2""")
def events_per_day(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("SELECT event_type, user_id, min(ts) AS ts FROM events GROUP BY 1, 2")
def events_first_seen(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("event_type", "user_id").agg(F.min("ts").alias("ts"))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The diverse shortlist of every day."""
    return diverse_shortlist(spark, sf_dir)
