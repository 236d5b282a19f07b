import random
import re

import numpy as np
import pytest

from gleaner.llm import similar as S

POOL = "row_no bigint, title string, summary string, sid string, words string, a int, b int"


def brute(rows, t):
    sets = {r[0]: frozenset(re.findall(r"[^\W_]+", f"{r[1]} {r[2]}".lower())) for r in rows if r[1] and r[2] and r[1].strip() and r[2].strip()}
    ids = sorted(sets)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if sets[a] and len(sets[a] & sets[b]) >= t * len(sets[a] | sets[b]) - 1e-9}


def corpus(seed, n, words=400, least=2, most=40):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(words)]
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.5:
            base = rng.choice(rows)
            w = base[2].split()
            for _ in range(rng.randint(0, max(1, len(w) // 5))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rng.shuffle(w)
            rows.append((i, base[1], " ".join(w), "s", "w", 1, 2))
        else:
            rows.append((i, "title", " ".join(rng.choice(vocabulary) for _ in range(rng.randint(least, most))), "s", "w", 1, 2))
    return rows


@pytest.mark.parametrize("seed,t,keys", [(1, 0.7, 32), (2, 0.5, 250), (3, 0.8, 32)])
def test_all_pairs_of_short_texts(spark, seed, t, keys):
    rows = corpus(seed, 250, most=11)
    got = S.similar_rows(spark.createDataFrame(rows, POOL).repartition(5), t, keys=keys)
    assert {(r.row_a, r.row_b) for r in got.collect()} == brute(rows, t)


def test_recall_of_long_texts(spark):
    rows = corpus(7, 500, words=3000, least=30, most=70)
    want = brute(rows, 0.7)
    got = {(r.row_a, r.row_b) for r in S.similar_rows(spark.createDataFrame(rows, POOL), 0.7).collect()}
    assert got <= want and len(got) >= 0.995 * len(want) > 100


def test_nulls_copies_scripts_and_a_hot_group(spark):
    rows = [(1, None, "x", *[None] * 4), (2, "t", " ", *[None] * 4), (3, "Über", "Été 東京 ok", *[None] * 4), (4, "über", "été 東京 OK!", *[None] * 4), (4, "über", "été 東京 OK!", *[None] * 4), (5, "!!", "??", *[None] * 4)]
    rows += [(100 + i, "the same", f"hot text of all with one word x{i // 2}", *[None] * 4) for i in range(60)]
    got = {(r.row_a, r.row_b) for r in S.similar_rows(spark.createDataFrame(rows, POOL), 0.7).collect()}
    assert got == brute(rows, 0.7) and (3, 4) in got and len(got) == 1 + 60 * 59 // 2
    groups = {r.row_no: r for r in S.groups(spark.createDataFrame(rows, POOL), 0.7).collect()}
    assert {groups[100 + i].group_no for i in range(60)} == {100} and groups[100].links == 29 and groups[3].links == 0 and groups[4].group_no == 3


def test_very_long_texts_and_empty_table(spark):
    rng = random.Random(8)
    long = [f"v{rng.randint(0, 10**6)}" for _ in range(3000)]
    rows = [(1, "t", " ".join(long), *[None] * 4), (2, "t", " ".join(long[:2800]), *[None] * 4), (3, "t", " ".join(long[:1500]), *[None] * 4)]
    got = S.similar_rows(spark.createDataFrame(rows, POOL), 0.7).collect()
    assert [(r.row_a, r.row_b) for r in got] == [(1, 2)]
    assert S.similar_rows(spark.createDataFrame([], POOL), 0.7).count() == 0
    assert S.groups(spark.createDataFrame([], POOL), 0.7).count() == 0


def test_gray_rank_is_the_inverse_of_the_gray_code():
    n = np.arange(2000, dtype=np.uint64)
    assert (S.gray_rank(n ^ (n >> np.uint64(1))) == n).all()


@pytest.mark.parametrize("n,keys", [(0, 1), (1, 1), (7, 2), (40, 5), (700, 1), (700, 3)])
def test_index_finds_every_pair_within_the_bound(n, keys):
    rng = np.random.default_rng(n)
    base = rng.integers(0, 2**63, size=(n, 2), dtype=np.uint64) & np.uint64(0xFFFFFFFF)
    base[n // 2 :] = base[: n - n // 2] ^ (np.uint64(1) << rng.integers(0, 32, size=(n - n // 2, 2), dtype=np.uint64))
    size, key = rng.integers(20, 40, size=n), rng.integers(0, keys, size=n)
    found = [tuple(sorted(p)) for i, j in S.GrayIndex(key, base, size, 0.7).pairs(at_once=7) for p in zip(i.tolist(), j.tolist())]
    near, want = set(), set()
    for a in range(n):
        for b in range(a + 1, n):
            d = int(np.bitwise_count(base[a] ^ base[b]).sum())
            if key[a] == key[b] and d <= int(0.3 / 1.7 * (size[a] + size[b]) + 1e-6):
                near.add((a, b))
                if min(size[a], size[b]) >= 0.7 * max(size[a], size[b]):
                    want.add((a, b))
    assert len(set(found)) == len(found) and want <= set(found) <= near


def test_skipped_words_count_as_differences():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**62, size=(200, 2), dtype=np.uint64) & np.uint64(0xFF)
    size, skip, key = np.full(200, 30), rng.integers(0, 9, size=200), np.zeros(200, np.int64)
    found = {tuple(sorted(p)) for i, j in S.GrayIndex(key, base, size, 0.7, skip).pairs() for p in zip(i.tolist(), j.tolist())}
    want = {(a, b) for a in range(200) for b in range(a + 1, 200) if int(np.bitwise_count(base[a] ^ base[b]).sum()) + skip[a] + skip[b] <= 10}
    assert found == want and len(want) > 50


@pytest.mark.parametrize("words", [20, 48, 100, 190, 260, 1000, 3000])
def test_recall_at_the_threshold_by_size(words):
    """Pairs just at 0.7 whose differing words are the rarest: every pair has a common key and is within the bound."""
    rng = np.random.default_rng(words)
    held = np.sort(rng.integers(-(2**62), 2**62, size=4000))
    counts = rng.integers(60, 20_000, size=4000)
    small = int(np.ceil(0.7 * words))
    for trial in range(60):
        shared = rng.choice(held, size=min(small, 3500), replace=False)
        extra = rng.integers(2**62, 2**63 - 1, size=words - small)
        sets = [shared, np.concatenate([shared, extra])]
        found = []
        for s in sets:
            with np.errstate(over="ignore"):
                found.append(set(S.all_keys(s.view(np.uint64), S.frequencies(s, held, counts), np.array([0]), np.array([len(s)]), 0.7, 2000.0, 4e7)[1].tolist()))
        assert found[0] & found[1]


def test_one_sided_insertions_of_the_rarest_words(spark):
    """All words of a text and further ones that only the longer text has: the rarest of its words tell nothing."""
    rng = random.Random(11)
    rows = []
    for g in range(40):
        shared = rng.sample([f"c{i}" for i in range(90)], 34)
        rows.append((2 * g, "t", " ".join(shared), *[None] * 4))
        rows.append((2 * g + 1, "t", " ".join(shared + [f"only{g}x{i}" for i in range(14)]), *[None] * 4))
    long = [f"v{i % 1500}" for i in range(1500)]
    rows += [(1000, "t", " ".join(long), *[None] * 4), (1001, "t", " ".join(long + [f"new{i}" for i in range(600)]), *[None] * 4)]
    rows += [(1100, "t", " ".join(long[:100]), *[None] * 4), (1101, "t", " ".join(long[:100] + [f"edge{i}" for i in range(40)]), *[None] * 4)]
    got = {(r.row_a, r.row_b) for r in S.similar_rows(spark.createDataFrame(rows, POOL), 0.7).collect()}
    want = brute(rows, 0.7)
    assert got == want and {(1000, 1001), (1100, 1101)} <= want and len(want) >= 42
