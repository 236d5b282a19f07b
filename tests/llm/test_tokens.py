import os
import random

import pytest
from pyspark.sql import functions as F

from gleaner.llm import encode as E
from gleaner.llm import packing as P
from gleaner.llm import splitting as S

pytestmark = pytest.mark.skipif(not os.path.exists(E.VOCABULARY), reason="no vocabulary files")
DOCS = "doc_id bigint, text string, block int, ids string, word string, tokens string"
TEXTS = [None, "", " ", "\n\n \t", "Hello world's 123 things", "a\r\nb\n\n\nc   d ", "naïve 東京 🙂🙂 é ‍ x", "<|endoftext|> is text", "x" * 5000, " " * 300 + "end", "don't  'll 've", "ﬁ ² Ⅷ ١٢٣", "same", "same"]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, 1, "i", "w", "t") for i, t in enumerate(texts)], DOCS)


def test_ids_equal_the_tokenizer_and_round_trip(spark):
    direct = E.encoder(E.VOCABULARY)
    encoded = E.encode(docs(spark, TEXTS).repartition(3), block_chars=2000).cache()
    got = {r.doc_id: r.ids for r in encoded.collect()}
    assert got == {i: direct(t) if t else [] for i, t in enumerate(TEXTS)}
    assert {r.doc_id: r.text for r in E.decode(encoded).collect()} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert E.encode(docs(spark, [])).count() == 0


def test_each_distinct_word_is_encoded_once(spark):
    texts, blocks = E.blocked(docs(spark, ["same words here", "same words there"] * 50))
    table = E.word_table(texts, blocks).cache()
    assert texts.rdd.getNumPartitions() == blocks
    assert table.select("word").distinct().count() == 4 and table.count() == table.distinct().count() <= 4 * blocks
    # a word's rows lie in one partition
    assert table.select("word", F.spark_partition_id().alias("p")).distinct().count() == 4


def test_sizes(spark):
    direct = E.encoder(E.VOCABULARY)
    assert {r.doc_id: r.tokens for r in P.sizes(docs(spark, TEXTS)).collect()} == {i: len(direct(t)) if t else 0 for i, t in enumerate(TEXTS)}


@pytest.mark.parametrize("rule", ["dot", "norm"])
def test_packing_keeps_every_bound(spark, rule):
    rng = random.Random(3)
    items = [(i, rng.choice([0, 5, rng.randint(1, 90), rng.randint(1, 90), rng.randint(1, 30), 100, 101, 250])) for i in range(700)] + [(3, 7), (3, 7)]
    packed = P.pack(spark.createDataFrame(items, "doc_id bigint, tokens bigint"), capacity=100, documents=6, rule=rule, shard_items=150).cache()
    by = {}
    for r in packed.collect():
        by.setdefault(r.container, []).append(r)
    assert all(sum(x.tokens for x in v) <= 100 and len(v) <= 6 and (sum(x.tokens**2 for x in v) <= 7_500 or sum(x.tokens > 0 for x in v) == 1) for v in by.values())
    back = {}
    for v in by.values():
        for x in v:
            back.setdefault((x.doc_id, x.copy if x.doc_id == 3 else 1), []).append((x.part, x.tokens))
    assert sum(t for v in back.values() for _, t in v) == sum(t for _, t in items)
    for i, t in items[:700]:
        parts = sorted(p for k, v in back.items() if k[0] == i for p in v) if i != 3 else None
        assert parts is None or (len(parts) == max(1, -(-t // 100)) and sum(x for _, x in parts) == t)
    lower = max(-(-sum(t for _, t in items) // 100), -(-len(items) // 6))
    assert len(by) <= 1.12 * lower


def test_attention_cost_binds(spark):
    items = spark.createDataFrame([(i, 50) for i in range(40)] + [(99, 95)], "doc_id bigint, tokens bigint")
    loose = P.containers(P.pack(items, capacity=100, cost=10_000)).count()
    tight = P.containers(P.pack(items, capacity=100, cost=4_000)).collect()
    assert loose == 21 and len(tight) == 41 and max(r.with_tokens for r in tight) == 1


def test_many_copies_of_one_id(spark):
    items = spark.range(10_000).selectExpr("cast(null as bigint) as doc_id", "cast(3 as bigint) as tokens")
    packed = P.pack(items, capacity=100, shard_items=1500)
    assert packed.count() == packed.distinct().count() == 10_000
    assert P.containers(packed, 100).agg({"tokens": "max"}).head()[0] <= 100


def test_repeated_ids_decode_to_a_row_each(spark):
    df = spark.createDataFrame([(1, "hello world"), (1, "other text"), (1, "other text"), (2, ""), (2, None)], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in E.decode(E.encode(df)).collect()) == [(1, "hello world"), (1, "other text"), (1, "other text"), (2, ""), (2, "")]


def test_pieces_of_a_run_overlap_inside_it(spark):
    rng = random.Random(9)
    run = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(4000))
    v = sorted(S.split(docs(spark, [run]), limit=60, overlap=8).collect(), key=lambda r: r.piece)
    assert len(v) > 10 and all(r.begin < r.start for r in v[1:]) and "".join(r.text[r.start - r.begin :] for r in v) == run


def test_packing_of_nothing(spark):
    assert P.pack(spark.createDataFrame([], "doc_id bigint, tokens bigint")).count() == 0
    assert P.pack(spark.createDataFrame([(1, None)], "doc_id bigint, tokens bigint")).count() == 1


def long_text(rng):
    parts = []
    for _ in range(rng.randint(1, 30)):
        parts.append(rng.choice(["# Heading\n", "\n\n", "```\ncode = 1\n```\n", "- item one\n", "A sentence ends here. ", "clauses, follow; each ", "x" * rng.randint(1, 400), "東京は晴れ。", "🙂" * 9, "\r\n", " "]))
    return "".join(parts)


def test_pieces_rejoin_under_the_limit_with_overlap(spark):
    rng = random.Random(6)
    texts = TEXTS + [long_text(rng) * 6 for _ in range(40)] + ["word " * 3000]
    direct = E.encoder(E.VOCABULARY)
    by = {}
    for r in S.split(docs(spark, texts).repartition(4), limit=60, overlap=8).collect():
        by.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        t = t or ""
        v = sorted(by.get(i, []), key=lambda r: r.piece)
        assert "".join(r.text[r.start - r.begin :] for r in v) == t
        assert [r.start for r in v[1:]] == [r.end for r in v[:-1]] and all(r.text == t[r.begin : r.end] for r in v)
        for a, r in zip([None, *v], v):
            assert r.tokens == len(direct(r.text)) <= 60
            assert r.begin >= (a.start if a else 0) and len(direct(t[r.begin : r.start])) <= 8
        if len(direct(t)) <= 60:
            assert len(v) == (1 if t else 0)
    last = sorted(by[len(texts) - 1], key=lambda r: r.piece)
    assert all(r.begin < r.start for r in last[1:])


def test_cuts_at_the_strongest_boundary(spark):
    text = "One sentence is here. " * 20 + "\n\n# Heading\n" + "Another sentence is here. " * 20
    v = S.split(docs(spark, [text]), limit=140, overlap=0).collect()
    assert len(v) == 2 and v[1].text.startswith("# Heading")


def test_overlap_must_be_below_the_limit(spark):
    with pytest.raises(ValueError):
        S.split(docs(spark, ["x"]), limit=10, overlap=10)
    assert S.split(docs(spark, [])).count() == 0


def test_a_far_white_space_comes_before_the_inside_of_a_run():
    left, right = "ab12" * 60, " " + "cd34" * 100
    spans = S.cut_spans(left + right, 250, 0, E.splitter(), S.Counts(lambda w: [0]))
    assert [x[:2] for x in spans] == [(0, len(left)), (len(left), len(left + right))]
