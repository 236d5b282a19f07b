import random

import pytest

from gleaner.llm import dominance as D

POOL = "row_no bigint, source string, url string, site string, contributor string, score double, n int"
DIM = "name string, site string, tier int"


def test_contributors(spark, monkeypatch):
    dim = spark.createDataFrame([("Big News", "big.example", 1), ("Big Labs", "labs.big.example", 1), ("Other Paper", "other.example", None), ("Big News Jobs", "jobs.example", 2)], DIM)
    rows = [
        (1, None, "https://www.big.example/x", "big.example"), (2, None, "http://u@labs.BIG.example.:80/x", "labs.big.example"), (3, "Big News", "https://notbig.example/x", None), (4, "big-news RSS", None, "big.example"),
        (5, "The Other  Paper (feed)", "/rel", "other.example"), (6, None, None, None), (7, " ", "mailto:x@big.example", None), (8, "Big News Jobs", "", "jobs.example"), (9, "Unknown", None, None), (10, "Other Paper", "https://big.example.evil.example/", None),
    ]
    pool = spark.createDataFrame([(n, s, u, "z", "z", 0.0, 1) for n, s, u, _ in rows], POOL)
    want = {n: c for n, _, _, c in rows}
    assert {r.row_no: r.contributor for r in D.contributors(pool, dim).collect()} == want
    monkeypatch.setattr(D, "MAP_ROWS", 2)  # the other way, for large dimensions
    assert {r.row_no: r.contributor for r in D.contributors(pool, dim).collect()} == want
    assert D.contributors(pool, dim.limit(0)).where("contributor is not null").count() == 0


def test_a_name_of_several_sites_means_the_least(spark, monkeypatch):
    dim = [("Twin Paper", "b.example", 1), ("twin-paper", "a.example", 1), ("Twin Paper RSS", "c.example", 1)]
    pool = spark.createDataFrame([(1, "TWIN paper", None, None, None, 0.0, 1), (2, "The Twin Paper (feed)", None, None, None, 0.0, 1)], POOL)
    for order in (dim, dim[::-1], dim[1:] + dim[:1]):
        for rows in (5_000, 1):
            monkeypatch.setattr(D, "MAP_ROWS", rows)
            assert {r.contributor for r in D.contributors(pool, spark.createDataFrame(order, DIM)).collect()} == {"a.example"}


def brute(rows, limit):
    by, kept = {}, set()
    for n, c, s in rows:
        by.setdefault(c, []).append((-s, n))
    for c, v in by.items():
        kept |= {n for _, n in (sorted(v) if c is None or len(v) <= limit else sorted(v)[:limit])}
    return kept


@pytest.mark.parametrize("most", [0, 1, 7, 50, 10_000])
def test_cap_against_sorting(spark, most):
    rng = random.Random(most)
    rows = [(i, rng.choice(["a", "a", "b", "c", None]), rng.choice([-1.0, 0.5, 0.5, 1.0, rng.random()])) for i in range(900)]
    got = D.cap(spark.createDataFrame(rows, "row_no bigint, contributor string, score double").repartition(4), most=most).collect()
    assert {r.row_no for r in got if r.keep} == brute(rows, most) and len(got) == 900
    assert {r.contributor for r in got if r.dominant} == {c for c in ("a", "b", "c") if sum(r[1] == c for r in rows) > most}


def test_scores_out_of_range_null_and_repeated(spark):
    pool = spark.createDataFrame([(i, "P", None, None, None, None, None) for i in range(1, 7)], POOL)
    dim = spark.createDataFrame([("P", "p.example", 1)], DIM)
    scores = spark.createDataFrame([(1, None), (2, 1.5), (3, -0.2), (4, float("nan")), (5, 0.2), (5, 0.7), (6, 0.7)], "row_no bigint, score double")
    rows = D.scored(pool, dim, scores)
    assert {r.row_no: r.score for r in rows.collect()} == {1: -1.0, 2: -1.0, 3: -1.0, 4: -1.0, 5: 0.7, 6: 0.7}
    assert sorted(r.row_no for r in D.cap(rows, most=3).where("keep").collect()) == [1, 5, 6]


def test_empty(spark):
    assert D.cap(spark.createDataFrame([], "row_no bigint, contributor string, score double"), share=0.02).count() == 0
