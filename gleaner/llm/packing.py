"""Filling fixed-capacity containers with items.

Items are document texts measured in tokens. A container has a vector of capacities: tokens, documents and attention cost
(the sum of squared tokens). Items go, largest first, into the open container that has room in every dimension and the
best weighted dot product of the item with the residual, over the residual's norm and less the norm of what would be left
(`rule='dot'`), or the least norm of what would be left
(`rule='norm'`); if none has room, a new one is opened. An item above the token capacity, and only such an item, is split
into full containers and a rest that is packed like any other. An item whose own cost is above the cost capacity shares its
container with items without tokens only.

Spread over the cluster: items are dealt to shards by hash, each packed alone; containers filled below `settle` are opened
again and their items packed anew with those of other shards, until one shard holds the open rest. Where a round leaves more
than 0.7 of its items open, the next asks for 0.03 less. Shards hold about `shard_items` items in every round, so no task grows
with the input.

Defined results: a null or empty text has no tokens and takes a place in the document count only; repeated doc_ids are
items of their own (numbered); an empty table gives no containers."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import encode as E
from gleaner.session import written

CAPACITY = 4096
DOCUMENTS = 64
#: Attention cost of a container, as a share of what one full text costs.
COST = 0.75
SHARD_ITEMS = 4_000


def sizes(documents: DataFrame, vocabulary: str = E.VOCABULARY) -> DataFrame:
    """(doc_id, tokens) of documents (doc_id, text) by the distinct-word table."""
    texts, blocks = E.blocked(documents)
    table = E.word_table(texts, blocks, vocabulary).select("block", "word", F.size("ids").alias("n")).repartition(blocks, "block")
    return texts.groupBy("block").cogroup(table.groupBy("block")).applyInPandas(_counted, "doc_id bigint, tokens bigint")


def _counted(key: tuple, texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    split, n = E.splitter(), dict(zip(table["word"], table["n"]))
    tokens = [sum(map(n.__getitem__, split(E.whole(t)))) if isinstance(t, str) and t else 0 for t in texts["text"]]
    return pd.DataFrame({"doc_id": texts["doc_id"], "tokens": tokens})


def best_fit(items: np.ndarray, limits: np.ndarray, weights: np.ndarray, rule: str = "dot") -> np.ndarray:
    """The container of each item: items (n x dims) and limits (dims), in any unit; first come is not first served but the
    largest in its largest dimension. An item above a limit counts as one that fills it."""
    n, dims = items.shape
    part = np.minimum(items / limits, 1.0)
    order = np.lexsort((np.arange(n), *(-part[:, d] for d in range(dims)), -part.max(1)))
    room = np.empty((max(16, n // 4 + 1), dims))
    box = np.full(n, -1, np.int64)
    count = 0
    # containers that nothing can enter any more are taken out of the search
    live = np.zeros(0, np.int64)
    least = part.min(0) if n else np.zeros(dims)
    for i in order:
        x = part[i]
        r = room[live]
        fits = (r >= x - 1e-12).all(1)
        if fits.any():
            at = np.flatnonzero(fits)
            left = r[at] - x
            if rule == "dot":
                # alike in shape and tightly filled: the dot product with the residual over the residual's norm
                norm = np.sqrt((r[at] * r[at] * weights).sum(1)) + 1e-12
                score = (r[at] * x * weights).sum(1) / norm - (left * left * weights).sum(1)
                pick = at[int(score.argmax())]
            else:
                pick = at[int((left * left * weights).sum(1).argmin())]
            b = live[pick]
        else:
            if count == len(room):
                room = np.concatenate([room, np.empty_like(room)])
            b, room[count] = count, 1.0
            live = np.append(live, count)
            count += 1
        room[b] -= x
        box[i] = b
        if (room[b] < least - 1e-12).any():
            live = live[live != b]
    return box


def _packed(limits: np.ndarray, weights: np.ndarray, rule: str, settle: float, again: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        have = list(batches)
        if not have:
            return
        b = pd.concat(have, ignore_index=True)
        for shard, g in b.groupby("shard", sort=True):
            g = g.sort_values(["tokens", "doc_id", "part", "copy"], ascending=[False, True, True, True], kind="stable").reset_index(drop=True)
            tokens = g["tokens"].to_numpy(np.float64)
            box = best_fit(np.stack([tokens, np.ones(len(g)), tokens * tokens], 1), limits, weights, rule)
            filled = np.bincount(box, weights=tokens, minlength=box.max() + 1) / limits[0]
            full = np.bincount(box, minlength=box.max() + 1) >= limits[1]
            # the container's name is its first item's, which no other container has
            first = g.groupby(box, sort=True)[["doc_id", "part", "copy"]].first()
            name = [f"{d}-{p}-{c}" for d, p, c in first.itertuples(index=False)]
            g["container"] = np.array(name, object)[box]
            g["settled"] = (filled >= settle)[box] | full[box]
            mix = [int.from_bytes(hashlib.blake2b(f"{again} {n}".encode(), digest_size=6).digest(), "big") for n in name]
            g["deal"] = np.array(mix, np.int64)[box]
            yield g[["doc_id", "part", "copy", "tokens", "container", "settled", "deal"]]

    return run


ITEM = "doc_id bigint, part int, copy bigint, tokens bigint, container string, settled boolean, deal bigint"


def pack(items: DataFrame, capacity: int = CAPACITY, documents: int = DOCUMENTS, cost: float | None = None, weights: tuple[float, float, float] = (1.0, 0.1, 0.2),
         rule: str = "dot", settle: float = 0.97, shard_items: int = SHARD_ITEMS) -> DataFrame:
    """(doc_id, part, copy, tokens, container) of items (doc_id, tokens): no container exceeds any capacity.

    cost is the attention capacity, COST * capacity ** 2 unless given."""
    cost = COST * float(capacity) ** 2 if cost is None else float(cost)
    limits, w = np.array([capacity, documents, cost], np.float64), np.array(weights)
    numbered = items.select("doc_id", F.coalesce("tokens", F.lit(0)).cast("bigint").alias("tokens")).groupBy("doc_id", "tokens").agg(F.count("*").alias("copies"))
    # in two steps, so that no row holds an array of all copies
    many = numbered.select("doc_id", "tokens", "copies", F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("copies") - 1) / 4096))).alias("thousands"))
    in_step = F.sequence(F.lit(1).cast("bigint"), F.least(F.lit(4096), F.col("copies") - F.col("thousands") * 4096))
    each = many.select("doc_id", "tokens", "thousands", F.explode(in_step).alias("place")).select("doc_id", "tokens", (F.col("thousands") * 4096 + F.col("place")).alias("copy"))
    # parts of texts above the capacity: full ones, and the rest
    n_parts = F.greatest(F.ceil(F.col("tokens") / capacity), F.lit(1))
    parts = each.select("doc_id", "copy", "tokens", F.explode(F.sequence(F.lit(0), (n_parts - 1).cast("int"))).alias("part"), n_parts.alias("n_parts"))
    sized = written(parts.select("doc_id", "part", "copy", F.when(F.col("part") < F.col("n_parts") - 1, F.lit(capacity)).otherwise(F.col("tokens") - (F.col("n_parts") - 1) * capacity).cast("bigint").alias("tokens")))
    left = sized.count()
    shards = max(1, -(-left // shard_items))
    todo = sized.withColumn("shard", F.pmod(F.xxhash64("doc_id", "part", "copy"), F.lit(shards)).cast("int"))
    done, again = [], 0
    while True:
        again += 1
        out = written(todo.repartitionById(shards, F.col("shard")).mapInPandas(_packed(limits, w, rule, settle if shards > 1 else -1.0, again), ITEM))
        done.append(out.where("settled").drop("settled", "deal"))
        rest = out.where("not settled")
        before, left = left, rest.count() if shards > 1 else 0
        if not left:
            break
        if left > 0.7 * before:
            settle -= 0.03
        # whole containers move together, so their items meet those of other shards
        shards = -(-left // shard_items)
        todo = rest.withColumn("shard", F.pmod("deal", F.lit(shards)).cast("int")).select("doc_id", "part", "copy", "tokens", "shard")
    table = done[0]
    for d in done[1:]:
        table = table.unionByName(d)
    return table


def containers(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """container, tokens, items, cost, with_tokens, documents (that begin in it), share of the capacity used."""
    return packed.groupBy("container").agg(
        F.sum("tokens").alias("tokens"), F.count("*").alias("items"), F.sum(F.col("tokens") * F.col("tokens")).alias("cost"),
        F.count(F.when(F.col("tokens") > 0, 1)).alias("with_tokens"), F.count(F.when(F.col("part") == 0, 1)).alias("documents"),
    ).withColumn("used", F.round(F.col("tokens") / capacity, 6))
