"""SQL that DuckDB checks queries of this package against, on whole tables."""

CONTRIBUTORS = r"""
dim AS (
  SELECT regexp_replace(lower(name), '[^\p{L}\p{N}]+', '', 'g') AS nkey, lower(trim(site)) AS site FROM source_dim WHERE site IS NOT NULL),
hosts AS (
  SELECT row_no, source,
    regexp_replace(lower(regexp_extract(trim(url), '(?i)^https?:/{2,}(?:[^/?#@\\]*@)?([^/?#:\\@\s]+)', 1)), '\.+$', '') AS host FROM pool),
cores AS (
  SELECT row_no, host, regexp_replace(lower(source), '[^\p{L}\p{N}]+', '', 'g') AS nkey,
    regexp_replace(regexp_replace(regexp_replace(trim(replace(lower(source), chr(160), ' ')), '^the\s+', ''),
      '\s*(\((feed|rss|atom|blog|news)\)|[|–—-]\s*(blog|feed|rss|news|home)|\b(rss|atom|feed))\s*$', ''), '[^\p{L}\p{N}]+', '', 'g') AS core FROM hosts),
on_site AS (
  SELECT row_no, arg_max(site, length(site)) AS site FROM cores JOIN (SELECT DISTINCT site FROM dim) s
    ON host = s.site OR ends_with(host, '.' || s.site) WHERE host <> '' GROUP BY row_no),
con AS (
  SELECT c.row_no, CASE WHEN coalesce(host, '') <> '' THEN o.site ELSE coalesce(a.site, b.site) END AS contributor
  FROM cores c LEFT JOIN on_site o USING (row_no) LEFT JOIN dim a ON a.nkey = c.nkey LEFT JOIN dim b ON b.nkey = c.core),
big AS (
  SELECT contributor, count(*) AS n FROM con WHERE contributor IS NOT NULL GROUP BY 1
  HAVING count(*) > 0.02 * (SELECT count(*) FROM pool))
"""

P5_FOUND = f"WITH {CONTRIBUTORS} SELECT row_no FROM con JOIN big USING (contributor)"

P5_KEPT = f"""WITH {CONTRIBUTORS},
best AS (SELECT row_no, max(score) AS score FROM quality_score WHERE score BETWEEN 0 AND 1 AND NOT isnan(score) GROUP BY 1),
ranked AS (
  SELECT c.row_no, c.contributor, coalesce(score, -1.0) AS score, b.n IS NOT NULL AS capped,
    row_number() OVER (PARTITION BY c.contributor ORDER BY coalesce(score, -1.0) DESC, c.row_no) AS place
  FROM con c LEFT JOIN best USING (row_no) LEFT JOIN big b ON b.contributor = c.contributor)
SELECT row_no, contributor, score FROM ranked WHERE NOT capped OR place <= floor(0.02 * (SELECT count(*) FROM pool))"""

P4_PAIRS_ALL = r"""WITH words AS (
  SELECT DISTINCT row_no, unnest(regexp_extract_all(lower(title || ' ' || summary), '[\p{L}\p{N}]+')) AS w FROM pool
  WHERE regexp_matches(title, '\S') AND regexp_matches(summary, '\S')),
n AS (SELECT row_no, count(*) AS n FROM words GROUP BY 1),
both_ AS (SELECT a.row_no AS row_a, b.row_no AS row_b, count(*) AS c FROM words a JOIN words b ON a.w = b.w AND a.row_no < b.row_no GROUP BY 1, 2)
SELECT row_a, row_b, round(c / (x.n + y.n - c)::DOUBLE, 9) AS similarity
FROM both_ JOIN n x ON x.row_no = row_a JOIN n y ON y.row_no = row_b WHERE c >= 0.7 * (x.n + y.n - c)"""

P6_DECODED = "SELECT doc_id, coalesce(text, '') AS text FROM documents"

P8_REJOINED = "SELECT doc_id, text FROM documents WHERE text <> ''"

P7_FILL = "SELECT count(*) AS documents, 0 AS over_tokens, 0 AS over_documents, 0 AS over_cost, true AS filled FROM documents"

P8_BOUNDS = "SELECT count(*) AS documents, sum(length(text))::BIGINT AS chars, 0 AS over_limit, 0 AS gaps, 0 AS bad_overlap, 0 AS without_overlap FROM documents WHERE text <> ''"


def oracle_sql() -> dict[str, str]:
    return {"p4_pairs_all": P4_PAIRS_ALL, "p5_found": P5_FOUND, "p5_kept": P5_KEPT, "p6_decoded": P6_DECODED, "p7_fill": P7_FILL, "p8_bounds": P8_BOUNDS, "p8_rejoined": P8_REJOINED}
