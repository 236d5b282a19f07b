import datetime as dt
import random

from pyspark.sql import functions as F

from gleaner.operators import digests, pool, select

POOL = "row_no bigint, id string, source string, title string, url string, date string, summary string, entity string, substance string, pos int, first_seen string"


def rows(spark, values):
    base = {"row_no": None, "id": None, "source": None, "title": None, "url": None, "date": None, "summary": None, "entity": None, "substance": None, "pos": None, "first_seen": None}
    return spark.createDataFrame([tuple((base | v).values()) for v in values], POOL)


def test_collapse_keeps_first_fields_and_longest_body(spark):
    df = rows(spark, [
        {"row_no": 1, "id": "a", "title": "t1", "summary": "Short one."}, {"row_no": 2, "id": "a", "title": "t2", "summary": "A longer body here.", "entity": "e"},
        {"row_no": 3, "id": "a", "title": "t3", "summary": "B longer body here.", "entity": "f"}, {"row_no": 4, "id": None, "title": "n1"}, {"row_no": 5, "id": "", "title": "n2"},
    ])
    got = {r.row_no: r for r in pool.collapse_batch(df).collect()}
    assert set(got) == {1, 4, 5}
    assert (got[1].title, got[1].summary, got[1].entity, got[1].copies) == ("t1", "A longer body here.", "e", 3)


def test_outcomes_in_order(spark):
    df = rows(spark, [{"row_no": 1, "id": "a"}, {"row_no": 2, "id": "a"}, {"row_no": 3, "id": "l"}, {"row_no": 4}])
    ledger = spark.createDataFrame([("l", None, None, None, None, None)], "id string, url string, status string, published string, date string, entity string")
    assert {r.row_no: r.outcome for r in pool.outcomes(df, ledger).collect()} == {1: "added", 2: "repeat", 3: "ledger", 4: "no_id"}


def test_prune_boundaries(spark):
    df = rows(spark, [{"row_no": 1, "id": "a", "first_seen": "2026-09-06"}, {"row_no": 2, "id": "b", "first_seen": "2026-09-05"}, {"row_no": 3, "id": "c", "first_seen": "odd"}, {"row_no": 4, "id": "d", "first_seen": "2026-09-20"}])
    got = {r.row_no: r.status for r in pool.prune(df, "2026-09-20", cap=2).collect()}
    assert got == {1: "over_cap", 2: "expired", 3: "kept", 4: "kept"}


def test_arrivals_count_first_occurrences(spark):
    df = rows(spark, [{"row_no": i, "id": x, "source": s, "first_seen": d} for i, (x, s, d) in enumerate(
        [("a", "s", "2026-09-01"), ("a", "s", "2026-09-01"), ("b", "t", "2026-09-02"), ("a", "s", "2026-09-02"), (None, "s", "2026-09-02"), ("c", "", "Sep 2, 2026"), ("d", "s", "never")])])
    got = {str(r.day): (r.fetched, r.new, r.sources, r.cold_start) for r in pool.arrivals(df).collect()}
    assert got == {"2026-09-01": (2, 1, 1, True), "2026-09-02": (4, 2, 1, False)}


def test_diversify_is_the_fold(spark):
    rng = random.Random(5)
    data = [(i, dt.date(2026, 9, 1 + i % 3), rng.choice("pqrstu"), rng.choice("xyz"), rng.choice([None, None, 1, 3])) for i in range(240)]
    cap_of = {}
    data = [(i, d, s, m, cap_of.setdefault(s, c)) for i, d, s, m, c in data]
    order = list(range(len(data)))
    rng.shuffle(order)
    place = {i: p + 1 for p, i in enumerate(order)}
    df = spark.createDataFrame([(i, d, place[i], s, m, c) for i, d, s, m, c in data], "row_no bigint, day date, place int, source string, domain string, source_cap int").repartition(5)
    got = sorted((str(r.day), r.pick, r.row_no) for r in select.diversify(df, limit=7).collect())
    want = []
    for day in sorted({d for _, d, *_ in data}):
        by_s, by_d, n = {}, {}, 0
        for i, d, s, m, c in sorted((x for x in data if x[1] == day), key=lambda x: place[x[0]]):
            if n >= 7:
                break
            if by_s.get(s, 0) >= (c or 2) or by_d.get(m, 0) >= 3:
                continue
            by_s[s], by_d[m], n = by_s.get(s, 0) + 1, by_d.get(m, 0) + 1, n + 1
            want.append((str(day), n, i))
    assert got == sorted(want)


def test_near_titles_and_clusters_against_brute_force(spark):
    rng = random.Random(9)
    vocabulary = [f"word{i}" for i in range(12)]
    data = [{"row_no": i, "title": " ".join(rng.sample(vocabulary, rng.randint(1, 6))), "first_seen": "2026-09-01"} for i in range(60)] + [{"row_no": 90, "title": None, "first_seen": "2026-09-01"}]
    pairs = select.near_titles(rows(spark, data))
    got = {(r.a, r.b) for r in pairs.collect()}
    first = {}
    for d in data[:-1]:
        first.setdefault(frozenset(d["title"].split()), d["row_no"])
    sets = sorted((n, s) for s, n in first.items())
    want = {(a, b) for a, x in sets for b, y in sets if a < b and len(x & y) / len(x | y) >= 0.6}
    assert got == want
    label = {r.row_no: r.cluster for r in select.clusters(pairs).collect()}
    parent = {n: n for p in want for n in p}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in sorted(want):
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert label == {n: find(n) for n in parent}


def test_global_rank(spark):
    df = spark.range(0, 500, 1, 7).withColumn("v", F.pmod(F.xxhash64("id"), F.lit(40)))
    got = [r.id for r in select.global_rank(df, [F.asc("v"), F.desc("id")]).orderBy("place").collect()]
    assert got == [r.id for r in df.orderBy("v", F.desc("id")).collect()]


def test_upsert_keeps_the_later(spark):
    cols = "k string, at int, v string"
    held = spark.createDataFrame([("a", 5, "h"), ("b", 1, "h"), ("c", 3, "h")], cols)
    new = spark.createDataFrame([("a", 5, "n"), ("b", 2, "n"), ("d", 1, "n")], cols)
    got = {r.k: (r.v, r.outcome) for r in digests.upsert(held, new, ["k"], "at", ["v"]).collect()}
    assert got == {"a": ("h", "retained"), "b": ("n", "updated"), "c": ("h", "retained"), "d": ("n", "new")}


def test_dead_sources_are_doubted(spark):
    df = rows(spark, [{"row_no": 1, "source": "s", "url": "u1"}, {"row_no": 2, "source": "s", "url": "u2"}, {"row_no": 3, "source": "t", "url": "u1"}])
    status = spark.createDataFrame([("u1", 404, 0), ("u1", None, 0), ("u2", 200, 1), ("u2", 404, 0)], "url string, status int, redirects int")
    assert {r.row_no for r in digests.without_dead(df, digests.verdicts(status)).collect()} == {2, 3}


def test_nearest_days(spark):
    day = lambda d: dt.date(2026, 9, d)
    left = spark.createDataFrame([("x", day(5)), ("x", day(1)), ("y", day(9))], "theme string, day date")
    right = spark.createDataFrame([("x", day(3)), ("x", day(5)), ("x", day(8))], "theme string, day date")
    got = {(r.theme, r.day.day): (r.earlier and r.earlier.day, r.later and r.later.day) for r in select.nearest_days(left, right).collect()}
    assert got == {("x", 5): (3, 8), ("x", 1): (None, 3), ("y", 9): (None, None)}


def test_blocked_terms_fail_closed(spark):
    import pytest

    df = rows(spark, [{"row_no": 1, "title": "An ExampleCorp story"}, {"row_no": 2, "title": "other", "summary": None}])
    assert [r.row_no for r in df.where(pool.holds_term(["title", "summary"], ["Example Corp"])).collect()] == [1]
    with pytest.raises(ValueError):
        pool.holds_term(["title"], [" "])


def test_instants(spark):
    df = spark.createDataFrame([("2026-09-01T10:00+0200",), ("2026-09-01T08:00:00Z",), ("2026-09-01T10:00:00",), ("odd",), (None,)], "s string")
    a, b, *rest = [r[0] for r in df.select(digests.instant(F.col("s"))).collect()]
    assert a == b is not None and rest == [None, None, None]


def test_reply_ids(spark):
    from gleaner.functions.replies import reply_ids

    one = "0123456789ab"
    replies = [f'```json\n["{one}", "x"]\n```', f'Sure: [{{"id": "{one}", "why": "a ] in text"}}] done', "none", "[]", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(replies)], "i int, r string")
    assert [r[1] for r in df.select("i", reply_ids("r")).orderBy("i").collect()] == [[one], [one], None, [], None]
