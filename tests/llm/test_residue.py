import pytest
from pyspark.sql import functions as F

from gleaner.llm import residue as R

CASES = [
    "{{ title }} and the sampler", "${post.description} <TOPIC>", "By %AUTHOR_NAME% on today", "<!-- summary goes here -->", "Dear @@FIRST_NAME@@, here it is", "«headline» | Site", "[insert date here]", "__PRODUCT_NAME__", "&lt;byline&gt; | Review",
    "undefined", "null: null (null)", "[object Object]", "NaN", "xxxx xxx xxxxxx", "test test test 1d41", "Lorem ipsum dolor sit amet, consectetur elit", "TODO: title", "Placeholder text to be replaced before launch",
    "You need to enable JavaScript in your browser to view this page.", "Bitte aktivieren Sie JavaScript, um diese Seite anzuzeigen.", "Pour lire cette page, activez JavaScript dans votre navigateur.", "Para ver esta página active JavaScript en su navegador.",
    "Access denied", "Page not found | Some Journal", "503 Service Unavailable", "La page demandée est introuvable ou a été déplacée. Code 404.", '{"error":{"code":500,"message":"x"}}', "Traceback (most recent call last): File x", "We'll be right back", "<noscript>Scripts are blocked here.</noscript>",
]
STORIES = [
    "Access denied: what 79 mentor audits say about Jasr", "JavaScript is required reading for monorepo teams at Urdph", "Undefined is not a bug: lazy fabric lessons from Oshforge", "Error 503 under load: how Orvnest traced a gradient", "A short history of lorem ipsum in escalation tools",
    "Zordex Labs tested the {{ name }} syntax in its engine, without the old ${VAR} escapes.", "The proposal adds a <T> parameter and an {index} field and keeps $HOME/.feed working.", "Page not found tells nobody what to do next, so Pexmor Works rewrote 94 messages in its forecast.",
    "Of 84 outages, three showed visitors a service unavailable notice; dispatchers evaluated the router.", "<p>A plain <a href='x'>story</a> about «deck chairs» and 40% of users.</p>", "Why Tivn redesigns its 404 page around the wearable animation", None, "", "   ", "5 < 6 and a & b",
]
POOL = "row_no bigint, title string, summary string, url string, host string, mask string, own int"


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert R.judge(text, None) and R.judge("A fine headline about gardens", text)


@pytest.mark.parametrize("text", STORIES)
def test_stories_are_none(text):
    assert R.judge(text, text) is None


def test_long_text_and_sentence_within():
    assert R.judge("t", "A story of many words. " * 5000) is None
    assert R.judge("t", "A story of many words. " * 50 + "You need to enable JavaScript in your browser to view this page. " + "More words follow. " * 50)


def test_table_with_clashing_columns_nulls_repeats_and_hot_text(spark):
    rows = [(1, "Access denied", None, None, "h", "m", 1), (1, "Access denied", None, None, "h", "m", 1), (2, None, None, None, None, None, None), (3, "A fine headline", "undefined", "https://a.example/p/x", "h", "m", 2)]
    rows += [(10 + i, "A fine headline", "Access denied", f"https://a{i}.example/x", "", "", 0) for i in range(200)]
    df = spark.createDataFrame(rows, POOL)
    assert sorted(r.row_no for r in R.residue(df).collect()) == [1, 3] + list(range(10, 210))
    assert R.residue(df.limit(0)).count() == 0


SLUGS = ["why-gardens-bloom-late", "river-boats-under-sail", "old-mills-find-work"]
#: Responses none of whose words are in the closed vocabulary.
HELD_OUT = ["Sivua pystytty löytämään", "Strona chwilowo niedostępna", "Ups! Zelle kaputt", "Geen toegang tot deze bladzijde " * 40]


@pytest.mark.parametrize("text", HELD_OUT)
def test_responses_are_known_by_the_corpus(spark, text):
    assert R.judge(text, None) is None and R.LEX.isdisjoint(R.WORD.findall(text.lower()))
    for place in ("title", "summary"):
        rows = [(i, text if place == "title" else s.replace("-", " "), text if place == "summary" else None, f"https://h{i}.example/{s}") for i, s in enumerate(SLUGS)]
        rows.append((9, text if place == "title" else "Some Story", text if place == "summary" else None, "https://h.example/p/x7"))
        many = spark.createDataFrame(rows, "row_no bigint, title string, summary string, url string")
        assert {(r.row_no, r.by) for r in R.residue(many).collect()} == {(i, "corpus") for i in (0, 1, 2, 9)}
        assert R.residue(many.withColumn("url", F.lit("https://h.example/why-gardens-bloom-late"))).count() == 0


def test_numbers_and_hosts_are_masked(spark):
    rows = [(i, f"Tunnus {i}x{i} vanhentui: h{i}.example", None, f"https://h{i}.example/{s}") for i, s in enumerate(SLUGS)]
    assert R.residue(spark.createDataFrame(rows, "row_no bigint, title string, summary string, url string")).count() == 3


def test_copies_of_stories_are_none(spark):
    title = "Why gardens bloom late this year"
    copies = [(i, title, "Rain fell often.", f"https://h{i}.example/why-gardens-bloom-late-{w}") for i, w in enumerate(["again", "indeed", "today", "here"])]
    # a story under slugs of its own words, whatever its summary says, and one under addresses without words
    copies += [(10 + i, title, "Rain fell often.", f"https://h{i}.example/p/{i}") for i in range(4)]
    assert R.residue(spark.createDataFrame(copies, "row_no bigint, title string, summary string, url string")).count() == 0
