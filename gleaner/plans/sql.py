"""SQL fragments that the checks of gleaner.plans.catalog share (DuckDB, RE2 patterns)."""

PARTS = r"""u AS (
  SELECT row_no, regexp_replace(coalesce(url, ''), '^[\s\x{85}\x{A0}]+|[\s\x{85}\x{A0}]+$', '', 'g') AS u FROM pool),
p AS (
  SELECT row_no, u, regexp_extract(u, '(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$',
    ['scheme', 'auth', 'path', 'query', 'frag']) AS x FROM u),
k AS (
  SELECT row_no, u, lower(x.scheme) AS scheme, lower(x.auth) AS auth, x.path AS path, x.query AS query, x.frag AS frag,
    array_to_string(list_filter(string_split(x.query, '&'), lambda q: q <> '' AND NOT starts_with(lower(q), 'utm_')), '&') AS kept FROM p),
ident AS (
  SELECT *, (CASE WHEN scheme <> '' THEN scheme || ':' ELSE '' END) || (CASE WHEN auth <> '' THEN '//' || auth ELSE '' END)
    || regexp_replace(path, '/+$', '') || (CASE WHEN kept <> '' THEN '?' || kept ELSE '' END) AS page,
    regexp_replace(regexp_replace(auth, '^.*@', ''), ':\d*$', '') AS host FROM k)"""

DAY = r"""coalesce(
  CASE WHEN regexp_matches({c}, '^\s*\d{{4}}-\d{{2}}-\d{{2}}([T ]\d{{1,2}}:\d{{2}}.*)?\s*$') THEN try_cast(substr(trim({c}), 1, 10) AS DATE) END,
  CASE WHEN regexp_matches({c}, '(?i)^\s*[a-z]{{3}}[a-z]*\.? +\d{{1,2}},? +\d{{4}}') THEN
    try_strptime(upper(substr(trim({c}), 1, 1)) || lower(substr(trim({c}), 2, 2)) || ' ' ||
      regexp_replace(regexp_extract(trim({c}), '(\d{{1,2}},? +\d{{4}})', 1), ',? +', ' '), '%b %d %Y')::DATE END)"""


def day(column: str) -> str:
    return DAY.format(c=column)


UNESCAPED = r"""replace(replace(replace(replace(replace(replace(coalesce({c}, ''), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#x27;', ''''), '&#39;', ''''), '&amp;', '&')"""
WHITE = r"[\s\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}\x{0B}\x{1C}-\x{1F}]+"


def cleaned(column: str) -> str:
    tags = f"regexp_replace({UNESCAPED.format(c=column)}, '<[a-zA-Z/!][^>]*>', ' ', 'g')"
    return f"regexp_replace(regexp_replace({tags}, '{WHITE}', ' ', 'g'), '^ | $', '', 'g')"


def last_sentence(expr: str) -> str:
    return rf"""regexp_extract({expr}, '(?s)^((?:.*[^.])?[.!?]["'')\]]?)(?:\s|$)', 1)"""


def sanitised(column: str) -> str:
    s = cleaned(column)
    for pattern, to in (
        (r"(?i)^\s*comments\s*$", ""), (r"(?is)\s*\bthe post\b.*?\bappeared first on\b.*$", ""),
        (r"(?is)\s*\b(?:read more|continue reading|read the full (?:story|article|post)|sign up for|subscribe to|the post appeared first)\b.*$", ""),
        (r"\s*https?://\S+", " "), (r"(?i)(?:article url|comments url|points|#\s*comments|comments)\s*:\s*\d*", " "), (r"\s*\[(?:…|\.\.\.)\]\s*", " "),
    ):
        s = f"regexp_replace({s}, '{pattern}', '{to}', 'g')"
    s = f"regexp_replace(regexp_replace({s}, '{WHITE}', ' ', 'g'), '^ | $', '', 'g')"
    s = rf"trim(regexp_replace({s}, '\s*(?:…|\.\.\.)\s*$', ''))"
    return rf"regexp_replace({s}, '^[\s\-–—:;,.]+', '')"


STOP = "'a an the and or but of for to in on at by with from as is are was were be been being it its this that these those how why what when who new now more most can could will would should may might must into over under about after before'"
TOKENS = f"list_filter(list_distinct(regexp_extract_all(lower(coalesce({{c}}, '')), '[a-z0-9]+')), lambda t: length(t) > 2 AND NOT list_contains(string_split({STOP}, ' '), t))"
WORDS = r"regexp_extract_all(lower(coalesce({c}, '')), '[a-z0-9]+(?:\.[a-z0-9]+)+|[a-z0-9]+')"
