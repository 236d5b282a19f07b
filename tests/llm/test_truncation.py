import random

import pytest

from gleaner.llm import truncation as T

POOL = "row_no bigint, source string, summary string, ending string, chars int, stop int"


@pytest.mark.parametrize("text,want", [
    ("A whole sentence.", "whole"), ("Is it?", "whole"), ('He said "it works."', "whole"), ("Done. ★ 1,234", "whole"), ("Fertig ist es. (red.)", "whole"), ("<p>Whole.</p>", "whole"), ("One. Two. Read more", "whole"), ("   ", "whole"),
    ("One sentence. Then it brea", "open"), ("One sentence. Then it,", "open"), ("One. Two is cut…", "mark"), ("One. Two is cut...", "mark"), ("One. Two is […]", "mark"), ("One. Two is (more…)", "mark"), ("One. Two… Read more", "mark"), ("One. Two is ... Continue reading →", "mark"),
    ("One. Two <a hre", "broken"), ('One. <a href="x">he', "broken"), ("One l&#x2", "broken"), ("One l&am", "broken"), ("Letters fr�", "broken"), ("Field notes on boats", "headline"), ("Rules apply from release 7.", "number"), ("AT&T and R&D", "headline"),
])
def test_endings(text, want):
    assert T.ending(text) == want


def test_limits_are_found_and_used(spark):
    rng = random.Random(1)
    story = lambda: " ".join("word" * 1 + str(rng.randint(1, 9)) + "." if rng.random() < 0.15 else "word" for _ in range(90))
    rows = []
    for i in range(1500):
        s = story()
        text = s[: s.rindex(".") + 1] if "." in s else s + "."
        if i % 3 == 0:
            text = (text * 3)[:200]
        elif rng.random() < 0.5:
            text = text[: rng.randint(60, 300)].rsplit(".", 1)[0] + "."
        rows.append((i, "Cutter" if i % 3 == 0 else "Fair", text, "x", 1, 2))
    rows += [(2000 + i, "Fair", "A headline of no punctuation " + "x" * (i % 40), "x", 1, 2) for i in range(100)] + [(3000, None, None, None, None, None), (3001, "Fair", "", None, None, None), (3000, None, None, None, None, None)]
    df = spark.createDataFrame(rows, POOL)
    ended = T.endings(df).cache()
    found = {(r.source, r.measure, r.length) for r in T.limits(ended).collect()}
    assert ("cutter", "chars", 200) in found and ("*", "chars", 200) in found
    assert not [x for x in found if x[0] == "fair"]
    got = {r.row_no: r for r in T.cuts(ended, T.limits(ended)).collect()}
    assert not any(got[2000 + i].cut for i in range(100)) and 3000 not in got and 3001 not in got
    for r in got.values():
        if r.row_no < 1500:
            assert r.cut == (not rows[r.row_no][2].rstrip().endswith("."))
    shares = {r.source: r for r in T.source_shares(T.cuts(ended, T.limits(ended))).collect()}
    assert shares["fair"].cut == 0 and shares["cutter"].cut == shares["cutter"].at_limit > 100


def test_a_headline_is_cut_at_a_limit_only(spark):
    rows = [(i, "s", "Words " + "x" * 54 if i < 300 else "Words " + "x" * (i % 50) + ".", None, None, None) for i in range(900)]
    got = {r.row_no: r.cut for r in T.truncated(spark.createDataFrame(rows, POOL)).collect()}
    assert all(got[i] == (i < 300) for i in range(900))


def test_lengths_of_headlines_cluster_without_being_limits(spark):
    rng = random.Random(11)
    rows = [(i, f"s{i % 7}", "Words " + "x" * int(rng.gauss(60, 4)), None, None, None) for i in range(6000)]
    rows += [(10_000 + i, f"s{i % 7}", "A whole text. " + "x" * rng.randint(20, 300) + ".", None, None, None) for i in range(3000)]
    rows += [(20_000 + i, "s1", "Field notes on one and the same subject", None, None, None) for i in range(30)]
    assert T.truncated(spark.createDataFrame(rows, POOL)).where("cut").count() == 0


def test_a_limit_that_few_headlines_reach(spark):
    """Headlines of all lengths, those above 60 bytes cut there: less than half of them, and of unlike numbers of characters."""
    rng = random.Random(12)
    rows = []
    for i in range(900):
        n = rng.randint(20, 56) if i % 3 else 60
        text = "Words " + "x" * (n - 6)
        if n == 60:
            text = "Words " + "ü" * (i % 6) + "x" * (54 - 2 * (i % 6))
        rows.append((i, "s", text, None, None, None))
    got = {r.row_no: r.cut for r in T.truncated(spark.createDataFrame(rows, POOL)).collect()}
    assert all(got[i] == (i % 3 == 0) for i in range(900))


def test_a_phrase_longer_than_headlines_is_a_broken_transfer(spark):
    rng = random.Random(13)
    rows = [(i, "s", "Words " + "x" * int(rng.gauss(60, 6)), None, None, None) for i in range(2000)] + [(5000, "s", "Words " + "x" * 150, None, None, None)]
    rows += [(6000, "s", "One ends. The next does n", None, None, None)]
    got = {r.row_no: r.evidence for r in T.truncated(spark.createDataFrame(rows, POOL)).where("cut").collect()}
    assert got == {5000: "long", 6000: "transfer"}


def test_evidence_of_limits_decides(spark):
    """Without the limits the same texts are no cuts."""
    rows = [(i, "s", "Words " + "x" * 54 if i < 300 else "Words " + "x" * (i % 50) + ".", None, None, None) for i in range(900)]
    ended = T.endings(spark.createDataFrame(rows, POOL)).cache()
    at = T.limits(ended)
    assert T.cuts(ended, at).where("cut").count() == 300 and T.cuts(ended, at.where("false")).where("cut").count() == 0


def test_marks_and_tags_of_any_length():
    assert T.unmarked("It goes" + " …" * 500) == "It goes" and T.unmarked("…" * 300) == "" and T.unmarked("plain") == "plain"
    assert T.ending("One. Two <a title='" + "x" * 9000) == "broken"


def test_empty(spark):
    assert T.truncated(spark.createDataFrame([], POOL)).count() == 0
