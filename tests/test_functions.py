import hashlib
import html
import random
import re
from urllib.parse import urlsplit, urlunsplit

from pyspark.sql import functions as F

from gleaner.functions import dates, names, text, tokens, url

URLS = [
    None, "", "  ", "https://A.Example/Path/?utm_source=x&b=2&&a=1#frag", "HTTP://a.example", "https://a.example/", "https://a.example/a//", "//host.example/x", "javascript:alert(1)",
    "mailto:x@y.example", "http://localhost/x", "https://user:pw@h.example:8080/p?q", "https://a.example/?UTM_Medium=1", "relative/path?x=1", "https:///nohost", "https://a.example/x?a=1&a=1&utm_x",
    "ftp://a.example/y", "https://a.example?q=1", "data:text/html,x", "https://a.example/p#",
]


def normalized(u):
    u = (u or "").strip()
    if not u:
        return ""
    s = urlsplit(u)
    q = "&".join(p for p in s.query.split("&") if p and not p.lower().startswith("utm_"))
    return urlunsplit((s.scheme.lower(), s.netloc.lower(), s.path.rstrip("/"), q, ""))


def run(spark, values, column):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", column(F.col("v")).alias("r")).orderBy("i").collect()]


def test_normalize_agrees_with_urlsplit(spark):
    plain = [u for u in URLS if u != "https:///nohost"]
    assert run(spark, plain, url.normalize_url) == [normalized(u) for u in plain]


def test_normalize_is_idempotent(spark):
    once = run(spark, URLS, url.normalize_url)
    assert run(spark, once, url.normalize_url) == once


def test_item_id(spark):
    want = [hashlib.sha256(normalized(u).encode()).hexdigest()[:12] if normalized(u) else "" for u in URLS[:6]]
    assert run(spark, URLS[:6], url.item_id) == want


def test_display_changes_tracking_only(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    assert df.where(~url.minimal_change(F.col("u"), url.display_url(F.col("u")))).count() == 0
    changed = df.where("u like '%frag'").select(url.minimal_change(F.col("u"), F.regexp_replace("u", "b=2", "b=3")).alias("ok"))
    assert not changed.head().ok


def test_unsafe_reasons(spark):
    got = dict(zip(URLS, run(spark, URLS, url.unsafe_reason)))
    assert got[None] == got[""] == "empty" and got["javascript:alert(1)"] == got["//host.example/x"] == "scheme"
    assert got["https:///nohost"] == "no_host" and got["http://localhost/x"] == "no_dot" and got["https://a.example/"] is None


def test_domain(spark):
    assert run(spark, ["https://www.a.b.example/x", "https://example", "https://x.example:80/", None], url.domain_of) == ["b.example", "example", "x.example:80", ""]


def test_clean_text_decodes_before_stripping(spark):
    values = ["a &lt;b&gt;c&lt;/b&gt; &amp;lt;i&amp;gt; 5 < 6", None, "x <br/>\n\n y ", "&nbsp;z&nbsp;"]
    want = [re.sub(r"\s+", " ", re.sub(r"<[a-zA-Z/!][^>]*>", " ", html.unescape(v or ""))).strip() for v in values]
    assert run(spark, values, text.clean_text) == want


def test_sanitise_is_idempotent_and_ordered(spark):
    values = ["Comments", "One. Two is cut off here and", "Good text. The post X appeared first on Y.", "Lead. Read more at the site", "See https://a.example/x now. Done", "a […] b.", 'He said "it works."', "Wait... what happened. Then",
              "Article URL: https://x.example Comments URL: https://y.example Points: 3 # Comments: 0", "", None, "— dash start. ok."]
    once = run(spark, values, text.sanitise_summary)
    assert once[:5] == ["", "One.", "Good text.", "Lead.", "See now."] and once[6] == 'He said "it works."' and once[8] == ""
    assert run(spark, once, text.sanitise_summary) == once


def test_trim_quote_boundaries(spark):
    long = "word " * 80
    values = ["x" * 300, "x" * 301, "A" * 70 + ". " + "b" * 300, "Short. " + long, None]
    got = run(spark, values, text.trim_quote)
    assert got[0] == "x" * 300 and got[1] == "x" * 299 + "…" and got[2] == "A" * 70 + "." and got[3].endswith("word…") and len(got[3]) <= 300 and got[4] == ""


def test_tokens(spark):
    assert run(spark, ["The New AI model, the model of 2026!"], tokens.title_tokens) == [["model", "2026"]]
    assert run(spark, ["Agent 1.0.0 is out. The end"], tokens.words) == [["agent", "1.0.0", "is", "out", "the", "end"]]
    assert run(spark, ["In 2026 we saw 1,200 and 40% of 3.5"], tokens.numbers) == [["1200", "40", "3.5"]]
    assert run(spark, ["Vercel-initiated GPT-5 by The Corp"], lambda c: tokens.names(c, ["the"])) == [["Vercel-initiated", "GPT-5", "Corp"]]


def test_longest_run_against_brute_force(spark):
    rng = random.Random(3)
    rows = [([rng.choice("abc") for _ in range(rng.randint(0, 9))], [rng.choice("abc") for _ in range(rng.randint(0, 12))]) for _ in range(60)]

    def brute(x, y):
        return max((n for n in range(len(x) + 1) for i in range(len(x) - n + 1) if any(x[i : i + n] == y[j : j + n] for j in range(len(y) - n + 1))), default=0)

    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = [r.r for r in df.select("i", tokens.longest_run("a", "b").alias("r")).orderBy("i").collect()]
    assert got == [brute(*r) for r in rows]


def test_days(spark):
    values = ["2026-09-03", "2026-09-03T23:59:00Z", "2026-09-03 01:16", "Sep 3, 2026", "September 3, 2026", "2026-13-40", "Feb 30, 2026", "yesterday", "", None]
    got = [str(v) if v else None for v in run(spark, values, dates.day_of)]
    assert got == ["2026-09-03"] * 5 + [None] * 5
    assert run(spark, ["0001-01-02", "recent"], dates.ordinal) == [2, 0]


def test_names_and_hosts(spark):
    spelt = ["Foundry Lantern", "foundry  lantern", "The Foundry Lantern", "Foundry Lantern RSS", "FoundryLantern (feed)", "Foundry-Lantern | Blog", " Foundry Lantern "]
    assert set(run(spark, spelt, names.name_core)) == {"foundrylantern"}
    assert run(spark, [" ", None], names.name_core) == [None, None]
    got = run(spark, ["https://u@A.b.Example.:443/x", "ftp://a.example", None, "http:///x"], names.http_host)
    assert got[:3] == ["a.b.example", None, None]
