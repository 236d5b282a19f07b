import datetime as dt
import json

from pyspark.sql import functions as F

from gleaner.sources import files, pages
from gleaner.streaming import arrivals


def test_jsonl_is_tolerant(spark, tmp_path):
    p = tmp_path / "a.jsonl"
    p.write_text('{"id": "1", "title": "x"}\n\nbroken {\n[1, 2]\n"text"\n{"id": "2"}\n{"id": \n')
    assert sorted(r.id for r in files.read_jsonl(spark, str(p)).collect()) == ["1", "2"]
    assert files.read_jsonl(spark, str(tmp_path / "none")).count() == 0


def test_jsonl_leaves_absent_fields_out(spark, tmp_path):
    files.write_jsonl(spark.createDataFrame([("1", None)], "id string, entity string"), str(tmp_path / "o"))
    lines = [json.loads(x) for f in (tmp_path / "o").glob("part-*") for x in f.read_text().splitlines()]
    assert lines == [{"id": "1"}]


def test_snapshot_may_read_what_it_replaces(spark, tmp_path):
    s = files.Snapshots(spark, str(tmp_path / "t"))
    schema = spark.range(1).schema
    assert s.read(schema).count() == 0
    s.write(spark.range(3))
    s.write(s.read(schema).where("id > 0"))
    assert sorted(r.id for r in s.read(schema).collect()) == [1, 2]


def test_empty_days_stay_days(spark, tmp_path):
    (tmp_path / "feed-2026-09-01.jsonl").write_text('{"id": "1"}\n')
    (tmp_path / "feed-2026-09-02.jsonl").write_text("")
    rows, days = files.read_days(spark, str(tmp_path / "*.jsonl"))
    assert [(r.id, str(r.day)) for r in rows.collect()] == [("1", "2026-09-01")]
    assert sorted(str(r.day) for r in days.collect()) == ["2026-09-01", "2026-09-02"]


def test_rss(spark, tmp_path):
    (tmp_path / "f.xml").write_text(
        "<rss><channel><item><title>A &amp; B</title><link>https://a.example/1</link><pubDate>Tue, 1 Sep 2026 10:00:00 GMT</pubDate><description>text</description></item>"
        "<item><title>C</title><link>https://a.example/2</link></item></channel></rss>")
    got = {r.title: r for r in files.read_rss(spark, str(tmp_path / "f.xml")).collect()}
    assert got["A & B"].published == dt.datetime(2026, 9, 1, 10)
    assert got["C"].published is None and got["C"].summary == ""


def test_frontmatter_rows(spark):
    df = spark.createDataFrame([(1, '---\ntitle: "A: b"\ntags: [x, y]\nlist:\n  - p\n  - q\n---\nbody\n'), (2, "no block"), (3, "---\nopen: 1\n"), (4, None), (5, "---\r\na: 'it''s'\r\n---\r\n")], "k int, text string")
    got = {r.k: r for r in files.frontmatter(df, "k").collect()}
    assert got[1].fields == {"title": "A: b", "tags": "x|y", "list": "p|q"} and got[1].body == "body\n"
    assert got[2].fields is None and got[2].problem is None and got[3].problem == "unclosed" and got[4].fields is None and got[5].fields == {"a": "it's"}


def test_notes_number_entries_per_file(spark):
    text = "intro\n## 2026-09-01T10:00+02:00 #idea #x → ai/2026-09-01\nfirst\n\\## not a header\n## 2026-09-02T09:00Z\nsecond".split("\n")
    df = spark.createDataFrame([("f", i, v) for i, v in enumerate(text)], "file string, pos int, value string")
    got = sorted(files.notes(df).collect(), key=lambda r: r.n)
    assert [(r.n, r.stamp, r.tags, r.link, r.body) for r in got] == [(1, "2026-09-01T10:00+02:00", ["idea", "x"], "ai/2026-09-01", "first\n## not a header"), (2, "2026-09-02T09:00Z", [], None, "second")]


def test_between_markers(spark):
    df = spark.createDataFrame([("a<<b>>c",), ("none",)], "t string")
    assert [r[0] for r in df.select(files.between(F.col("t"), "<<", ">>")).collect()] == ["b", ""]


def test_bundle_dates(spark):
    df = spark.createDataFrame([("t", "u", d, s) for d, s in (("2026-09-01", "s"), ("UNKNOWN", ""), ("Sep 1", None), ("recent", "s"), (None, None))], "title string, url string, date string, summary string")
    got = [r.block for r in files.bundles(df).collect()]
    assert got == ["**t**\nURL: u\nDATE: 2026-09-01\nSummary: s", "**t**\nURL: u\nDATE: UNKNOWN", "**t**\nURL: u\nDate: Sep 1", "**t**\nURL: u\nSummary: s", "**t**\nURL: u"]


INDEX = """<html><body><nav><a href="/x">Navigation that is long enough to count</a></nav>
<article class="post"><h2><a href="/a/1">A headline of more than twenty letters</a></h2><p>short</p><p>This paragraph is longer than forty characters, as asked.</p></article>
<li class="news-item"><a href="https://o.example/2">Another headline, absolute this time</a></li><li class="card"><a href="/a/1">A headline of more than twenty letters</a></li>
<li class="card"><a href="#top">A headline with a fragment as its link</a></li></body></html>"""


def test_index_items(spark):
    df = spark.createDataFrame([("https://s.example/", INDEX), ("https://n.example/", None)], "url string, html string")
    got = [(r.title, r.url, r.summary) for r in pages.items(df).orderBy("pos").collect()]
    assert got == [("A headline of more than twenty letters", "https://s.example/a/1", "This paragraph is longer than forty characters, as asked."), ("Another headline, absolute this time", "https://o.example/2", "")]


def test_release_and_trending_items():
    got = pages.release_items('<div class="release"><h2 class="text-h2">1.2</h2><div class="prose"><p>Notes</p></div></div>', "https://r.example/u")
    assert got == [("1.2", "https://r.example/u#1.2", "Notes")]
    got = pages.trending_items('<article><h2><a href="/o/n">o /\n n</a></h2><p>Does things</p><a href="/o/n/stargazers">1,234</a></article>', "https://g.example")
    assert got == [("o / n", "https://g.example/o/n", "Does things ★ 1,234")]


def test_prose_kinds(spark):
    long = "".join(f"<p>{'word ' * 20}</p>" for _ in range(20))
    df = spark.createDataFrame([("a", f"<main>{long}</main><footer><p>{'foot ' * 20}</p></footer>"), ("b", "<p>x</p><iframe src=y></iframe>"), ("c", "<p>x</p>"), ("d", None)], "url string, html string")
    assert {r.url: r.kind for r in pages.prose(df).collect()} == {"a": "article", "b": "media", "c": "thin", "d": "thin"}


def test_stream_matches_batch(spark, data, tmp_path):
    src = tmp_path / "in"
    table = spark.read.parquet(f"{data}/events.parquet")
    table.repartition(3).write.parquet(str(src))
    arrivals.drain(arrivals.per_day(arrivals.events(spark, str(src), 100), "40 days"), str(tmp_path / "out"), str(tmp_path / "cp"), "append")
    # days stay open until the watermark passes; a second stream in complete mode would keep all: count first arrivals instead
    arrivals.drain(arrivals.first_seen(arrivals.events(spark, str(src), 100), ["user_id", "event_type"], "60 days"), str(tmp_path / "first"), str(tmp_path / "cp2"))
    assert spark.read.parquet(str(tmp_path / "first")).count() == table.select("user_id", "event_type").distinct().count()
