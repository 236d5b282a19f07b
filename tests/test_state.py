import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gleaner.functions import dates
from gleaner.operators import state

POOL = "row_no bigint, id string, url string, first_seen string, entity string, n int"
LEDGER = "id string, url string, status string, published string, date string, entity string"


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_ingest_and_its_replay(spark):
    pool = spark.createDataFrame([(1, "a", "https://a.example/1", "2026-09-01", None, 1), (2, "a", "https://a.example/2", "2026-09-02", None, 1), (3, None, "u", "d", None, 1), (4, "b", "https://a.example/3", "x", None, 1)], POOL)
    ledger = spark.createDataFrame([("l", None, "published", None, None, None), (None, None, None, None, None, None)], LEDGER)
    batch = spark.createDataFrame([
        (10, "", "https://a.example/4", None, None, 1), (11, "l", "https://a.example/4", None, None, 1), (12, "b", "https://a.example/4", None, None, 1), (13, "c", "https://a.example/4", None, None, 1),
        (14, "c", "https://a.example/4", None, None, 1), (15, "bad", "javascript:x", None, None, 1), (16, "word", "https://a.example/5", "2026-09-03", "block me", 1), (17, None, None, None, None, None),
    ], POOL)
    blocked = F.contains(F.col("entity"), F.lit("block"))
    got = state.admitted(batch, state.current(pool), ledger, blocked)
    assert rows(got, "row_no", "outcome") == [(10, "no_id"), (11, "ledger"), (12, "pool"), (13, "added"), (14, "repeat"), (15, "unsafe"), (16, "blocked"), (17, "no_id")]
    assert rows(state.counted(got, "outcome", state.OUTCOMES), "at", "n") == [(0, 2), (1, 1), (2, 1), (3, 1), (4, 1), (5, 1), (6, 1)]
    assert {r.n for r in state.counted(got.limit(0), "outcome", state.OUTCOMES).collect()} == {0}
    new = state.ingest(pool, batch, ledger, F.lit("2026-09-09"), blocked)
    assert rows(new, "row_no", "first_seen") == [(2, "2026-09-02"), (4, "x"), (13, "2026-09-09")]
    assert rows(state.ingest(new, batch, ledger, F.lit("2026-10-01"), blocked), "row_no", "first_seen") == rows(new, "row_no", "first_seen")


def test_retire_and_publish_change_nothing_the_second_time(spark):
    pool = spark.createDataFrame([(i, f"i{i % 8}", f"u{i}", "2026-09-01" if i < 4 else "2026-09-20", " E " if i == 5 else None, 1) for i in range(10)] + [(20, None, "u", "2026-08-01", None, 1)], POOL)
    ledger = spark.createDataFrame([("i0", None, "expired", None, "2026-09-01", None), ("i6", "u", "published", "2026-09-01", None, None), ("i7", "u", "published", "2026-01-01", None, None)], LEDGER)
    kept, after = state.retire(pool, ledger, "2026-09-20")
    assert kept.count() == 6 and rows(after.where("date = '2026-09-20'"), "id", "status") == [("i1", "expired"), ("i2", "expired"), ("i3", "expired")]
    again, same = state.retire(kept, after, "2026-09-20")
    assert rows(again, "row_no") == rows(kept, "row_no") and same.count() == after.count()
    edition = spark.createDataFrame([("i5", "u5"), ("i6", "u6"), ("i7", "u7"), ("i7", "u7")], "id string, url string")
    left, out = state.publish(edition, kept, after, "2026-09-20")
    assert rows(left, "row_no") == [(4,), (8,), (9,)] and {(r.id, r.entity) for r in out.where("published = '2026-09-20'").collect()} == {("i5", "e"), ("i7", None)}
    assert state.publish(edition, left, out, "2026-09-20")[1].count() == out.count()


def test_editions_that_are_refused(spark):
    good = spark.createDataFrame([("a", "u")], "id string, url string")
    state.check_edition(good, "2026-09-20", "2026-09-20")
    for bad, day in ((good, "2026-09-19"), (good.limit(0), "2026-09-20"), (good.unionByName(spark.createDataFrame([("", "u")], good.schema)), "2026-09-20")):
        with pytest.raises(ValueError):
            state.check_edition(bad, day, "2026-09-20")


def test_veto_is_the_fold(spark):
    rng = random.Random(3)
    day = dt.date(2026, 9, 1)
    offered = [(day, i, f"s{rng.randint(1, 9)}", f"d{rng.randint(1, 6)}") for i in range(30)]
    order = [(day, p, rng.randint(-3, 29)) for p in range(60)]
    got = state.veto(spark.createDataFrame(offered, "day date, row_no bigint, source string, domain string"), spark.createDataFrame(order, "day date, pos bigint, row_no bigint"), cap=5)
    held, seen, s, d, n, want = {r[1]: r for r in offered}, set(), {}, {}, 0, []
    for _, pos, i in order:
        if i not in held:
            what = "not_offered"
        elif i in seen:
            what = "duplicate"
        elif n >= 5:
            what = "over_cap"
        elif s.get(held[i][2], 0) >= 1:
            what = "source_capped"
        elif d.get(held[i][3], 0) >= 2:
            what = "domain_capped"
        else:
            what, n = "taken", n + 1
            s[held[i][2]] = 1
            d[held[i][3]] = d.get(held[i][3], 0) + 1
        seen.add(i)
        want.append((pos, what))
    assert rows(got, "pos", "outcome") == want and n > 2


def test_signals_all_or_nothing(spark):
    df = lambda *r: spark.createDataFrame(r, "key string, seen_at string")
    now = "2026-09-20 00:00:00"
    ok = ("wl:ai:2026-09-01:try:0", "2026-09-20T20:00:00+02:00")
    assert state.signals_valid(df(ok), now, 2).count() == 1
    for bad in (df(ok).limit(0), df(ok, ("wl:ai:try:0", ok[1])), df(ok, (ok[0], "2026-09-20T20:00:00")), df(ok, (ok[0], "2026-09-23T00:00:00Z")), df((None, ok[1]))):
        with pytest.raises(ValueError):
            state.signals_valid(bad, now, 2)
    with pytest.raises(ValueError):
        state.signals_valid(df(ok), now, 1)


def test_empty_values_delete(spark):
    held = spark.createDataFrame([("a", "done", 1), ("b", "open", 1), ("c", "open", 1)], "k string, v string, t int")
    new = spark.createDataFrame([("a", "", 5), ("b", "x", 3), ("b", "done", 4), ("d", None, 2), ("e", "new", 2)], "k string, v string, t int")
    assert rows(state.updated(held, new, ["k"], "v", "t"), "k", "v") == [("b", "done"), ("c", "open"), ("e", "new")]


def test_matched_and_samples(spark):
    a, b = spark.createDataFrame([(1,), (1,), (2,)], "k int"), spark.createDataFrame([(2,), (3,)], "k int")
    assert rows(state.matched(a, b, "k"), "k", "outcome") == [(1, "omitted"), (2, "matched"), (3, "unknown")]
    got = state.samples(spark.createDataFrame([("x", i) for i in (5, 1, 3, 9)] + [("y", 2)], "r string, k int"), "r", "k")
    assert rows(got, "r", "n", "samples") == [("x", 4, [1, 3, 5]), ("y", 1, [2])]


def test_dates(spark):
    texts = {"on 2026-09-03 at": (2026, 9, 3), "Sept 3–5, 2026": (2026, 9, 3), "Thu, 3 Sep 2026 10:00": (2026, 9, 3), "9/3/2026": (2026, 9, 3), "2026-02-31 or 3/4/2026": (2026, 3, 4), "1999-01-01": None, "Feb 31, 2026": None, "": None, None: None}
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", dates.date_text(F.col("t")).alias("d"))
    assert [r.d for r in df.orderBy("i").collect()] == [dt.date(*v) if v else None for v in texts.values()]
    got = spark.createDataFrame([("2026-09-01T10:00:00Z",), ("2026-09-01T10:00:00",), ("2026-09-01T12:00:00+02:00",), ("odd",), (None,)], "t string").select(dates.api_time(F.col("t")).alias("t")).collect()
    assert [r.t for r in got] == [dt.datetime(2026, 9, 1, 10)] * 3 + [None, None]
    day = spark.createDataFrame([(dt.date(2026, 9, d),) for d in (1, 14, 22)] + [(None,)], "d date")
    assert [tuple(r) for r in day.select(dates.recent(F.col("d"), "2026-09-20", 7), dates.event_window(F.col("d"), "2026-09-20")).collect()] == [(False, "out"), (True, "out"), (True, "soon"), (True, "UNKNOWN")]
    stamp = spark.createDataFrame([(None, 0), (None, 1), ("2026-09-19", 1), ("2026-09-13", 0), ("2026-09-21", 0)], "s string, n int")
    assert [r[0] for r in stamp.select(dates.staleness(F.col("s").cast("timestamp"), F.col("n"), F.lit("2026-09-20").cast("timestamp"))).collect()] == [False, True, False, True, True]
