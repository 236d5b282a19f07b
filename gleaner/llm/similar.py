"""Near-duplicate records with small edits.

Texts are sets of words. Two sets with Jaccard similarity t or more differ in at most
d = (1 - t) / (1 + t) * (|A| + |B|) words, and a fingerprint in which every word flips one of `bits` bits (the parity of
its words) then differs in at most d bits: the Hamming bound loses no pair. Fingerprints are kept in a hierarchical index
whose upper nodes hold masked bit patterns that their groups share, in Gray order below; searching accumulates the
differences in the newly fixed bits of each level and prunes whole groups beyond the bound.

The index is spread over the cluster by its topmost patterns, keys of one, two or three words, which lose no pair either.
Words have one order, by frequency and hash. A set of n words shares at least t * n with every similar one, so of the
words two sets share the first, second and third are among the first n - t * n + 1, + 2 and + 3 of either (prefixes). The
first alone is the key if at most `alone` of the records have it; else the first two, or all three where the first two are
so frequent that by chance more than `hot` of the records had both. Which of these holds depends on the words only,
so both sets have the key of the words they share first, wherever their differences lie. With such a key the words before its
last that are not in it are differences already: an entry counts them and its fingerprint leaves them out. Sets of more than LONG words,
and those they may be similar to, are keyed by every word of the prefix alone, which bounds the keys of a record.
The index is built and searched in rounds of about `keys` keys a record, by the first word, and each round's shuffle is
dropped before the next. Word frequencies are counted over all records; only words in more than `common` of the records
are held as a table (at most mean words / common entries, however many records there are), the others rank as rarest.

Copies (equal sets) are one entry of the index; equal texts inside one batch are joined before anything is shuffled.

Defined results: records with a null or blank title or summary are left out; a set of at most 2 / t words is also keyed by its
words; very long texts are taken whole; an empty table gives no pairs; repeated row numbers count once."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleaner.session import free_shuffles, spread, written

#: Sizes from here on are stored as this and count as unlimited.
FULL = 0xFFFF


WORD = r"[\p{L}\p{N}]+"


def words(text: Column) -> Column:
    """Hashes of the distinct maximal runs of letters and digits of the lower-cased text."""
    return F.array_distinct(F.transform(F.regexp_extract_all(F.lower(text), F.lit(WORD), 0), lambda w: F.xxhash64(w)))


def word_sets(pool: DataFrame) -> DataFrame:
    """(row_no, words) of the records with a title and a summary."""
    full = pool.where("trim(title) != '' and trim(summary) != ''").where(F.regexp_like("title", F.lit(r"(?U)\S")) & F.regexp_like("summary", F.lit(r"(?U)\S")))
    # a test of the words themselves would split every text twice
    some = F.regexp_like("title", F.lit(WORD)) | F.regexp_like("summary", F.lit(WORD))
    return full.where(some).select("row_no", words(F.concat_ws(" ", "title", "summary")).alias("words"))


def common_words(sets: DataFrame, common: float) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes and counts of the words in more than `common` of the records, sorted by hash, and the number of records."""
    n = sets.count()
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    by = sets.select(F.explode("words").alias("w")).groupBy("w").agg(F.count("*").alias("n")).where(F.col("n") > common * n)
    held = by.toPandas()  # at most (mean words a record) / common rows
    order = np.argsort(held["w"].to_numpy(np.int64))
    return held["w"].to_numpy(np.int64)[order], held["n"].to_numpy(np.int64)[order], n


@lru_cache(maxsize=256)
def places(p: int, n: int) -> tuple[np.ndarray, ...]:
    """The places (a, b) of pairs and (x, y, z) of triples of words in order, the first of them among the first p, the next
    among the first p + 1 and p + 2 of n."""
    i, j = np.meshgrid(np.arange(p), np.arange(min(p + 1, n)), indexing="ij")
    a, b = i[i < j], j[i < j]
    k = np.arange(min(p + 2, n))
    more = b[:, None] < k[None, :]
    pair, z = np.nonzero(more)
    return a, b, pair, a[pair], b[pair], z


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: Odd multipliers that tell a word's place in a triple.
PLACES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


#: Sets of more words are keyed by single words.
LONG = 128


def keyed(h: np.ndarray, df: np.ndarray, t: float, alone: float, hot: float, turn: int = 0, turns: int = 1) -> tuple[np.ndarray, ...]:
    """(row, key, skip, high, low) of the topmost patterns of sets of equal size: h their word hashes, a row each, df their
    frequencies (0 for words outside the table). alone and hot: greatest frequency of a first word, and greatest product of the first
    two's. Only keys whose first word belongs to this turn.

    Where a key holds the words that two sets share first, the words before the last of them that are not in the key are in one
    set only: skip counts them, and the fingerprint (high, low) is that of the other words."""
    m, n = h.shape
    p = n - max(1, int(np.ceil(t * n - 1e-6))) + 1
    mine = lambda w: (mix(w) >> np.uint64(20)) % np.uint64(turns) == np.uint64(turn)
    high, low = bits(h)
    whole = [np.bitwise_xor.reduce(x, axis=1) for x in (high, low)]
    out: list[tuple[np.ndarray, ...]] = []

    def add(row: np.ndarray, keys: np.ndarray, last: np.ndarray | int, others: tuple[np.ndarray, ...] = ()) -> None:
        rest = [x[row] for x in whole]
        if not isinstance(last, int):
            for i, (before, word) in enumerate(zip(upto, each)):
                rest[i] = rest[i] ^ before[row, last]
                for at in others:
                    rest[i] = rest[i] ^ word[row, at]
        out.append((row, keys, np.broadcast_to(last, row.shape) - len(others), *rest))

    # two sets of at most 2 / t words may share fewer than three: they meet by single words
    if n <= 2 / t + 1e-9:
        row, at = np.nonzero(mine(h))
        add(row, mix(h[row, at]), 0)
    order = np.lexsort((h, df))[:, : p + 2]
    g, f = np.take_along_axis(h, order, 1), np.take_along_axis(df, order, 1).astype(np.float64)
    each = [np.take_along_axis(x, order, 1) for x in (high, low)]
    upto = [np.bitwise_xor.accumulate(x, axis=1) ^ x for x in each]  # of the words before
    own = mine(g[:, :p])
    one, two, three = (g * x for x in PLACES)
    if n >= t * LONG - 1e-6:
        row, at = np.nonzero(own)
        add(row, mix(one[row, at] ^ two[row, at]), at)  # a pattern of the long ones alone
    if n <= LONG:
        single = f[:, :p] <= alone
        row, at = np.nonzero(own & single)
        add(row, one[row, at], at)
        a, b, pair, x, y, z = places(p, n)
        both = (own & ~single)[:, a]
        often = f[:, a] * f[:, b] > hot
        row, at = np.nonzero(both & ~often)
        add(row, one[row, a[at]] ^ two[row, b[at]], b[at], (a[at],))
        row, at = np.nonzero((both & often)[:, pair])
        add(row, one[row, x[at]] ^ two[row, y[at]] ^ three[row, z[at]], z[at], (x[at], y[at]))
    return tuple(np.concatenate([o[i] for o in out]) for i in range(5))


def bits(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bit of 96 that each word flips, as two codes: a word flips one bit in all."""
    bit = mix(h) % np.uint64(96)
    one = np.uint64(1) << (bit & np.uint64(63))
    return np.where(bit < 64, one, np.uint64(0)), np.where(bit < 64, np.uint64(0), one)


def all_keys(h: np.ndarray, df: np.ndarray, start: np.ndarray, size: np.ndarray, *how: float) -> tuple[np.ndarray, ...]:
    """(place, key, skip, high, low) of the sets that lie one after the other in h."""
    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    for n in np.unique(size):
        same = np.flatnonzero(size == n)
        for part in np.array_split(same, len(same) // 200 + 1):
            at = start[part][:, None] + np.arange(n)
            r, *rest = keyed(h[at], df[at], *how)
            found.append((part[r], *rest))
    return tuple(np.concatenate([x[i] for x in found]) for i in range(5))


def frequencies(flat: np.ndarray, held: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(held):
        return np.zeros(len(flat), np.int64)
    at = np.minimum(np.searchsorted(held, flat), len(held) - 1)
    return np.where(held[at] == flat, counts[at], 0)


#: One entry of the index as it is shuffled: key, set, fingerprint, size and skipped words without the padding of a row.
ENTRY = np.dtype([("k", "<u4"), ("k2", "u1"), ("sid", "<i8"), ("high", "<u8"), ("low", "<u4"), ("size", "<u2"), ("skip", "u1")])


def _entries(held: np.ndarray, counts: np.ndarray, parts: int, *how: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        np.seterr(over="ignore")
        # small batches give small blobs, which a heap of small regions takes
        for b in (x[i : i + 2_000] for x in batches for i in range(0, len(x), 2_000)):
            b = b.drop_duplicates("sid")  # copies within the batch
            flat = np.concatenate([np.asarray(w, np.int64) for w in b["words"]])
            size = b["words"].map(len).to_numpy()
            df = frequencies(flat, held, counts)
            h = flat.view(np.uint64)
            end = np.cumsum(size)
            start = end - size
            row, k, skip, high, low = all_keys(h, df, start, size, *how)
            if not len(k):
                continue
            k = mix(k)
            out = np.empty(len(k), ENTRY)
            out["k"], out["k2"] = k & np.uint64(0xFFFFFFFF), (k >> np.uint64(32)) & np.uint64(0xFF)
            out["high"], out["low"], out["skip"] = high, low.astype(np.uint32), np.minimum(skip, 255)
            out["sid"], out["size"] = b["sid"].to_numpy(np.int64)[row], np.minimum(size, FULL)[row]
            part = ((k >> np.uint64(40)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            out, part = out[order], part[order]
            cut = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
            ends = np.append(cut[1:], len(part))
            yield pd.DataFrame({"part": part[cut], "entries": [out[i:j].tobytes() for i, j in zip(cut, ends)]})

    return run


def gray_rank(codes: np.ndarray) -> np.ndarray:
    """The position of each 64-bit code in the reflected Gray sequence."""
    r = codes.astype(np.uint64)
    for s in (1, 2, 4, 8, 16, 32):
        r = r ^ (r >> np.uint64(s))
    return r


#: Entries of a leaf node.
FAN = 16


class GrayIndex:
    """A hierarchical index over fingerprints (columns of 64-bit codes) with sizes, within topmost patterns (keys).

    Within a key entries lie by skipped words, size band and Gray rank. A node holds FAN neighbours of one key: the bits on which
    all of them agree (mask), their values (pattern), the range of sizes and the least of skipped words; nodes above hold FAN nodes.
    The search goes down with pairs of nodes of one key: the words both skip and the differences in the bits that both fix
    add up to a lower bound for all pairs below, and a pair of groups beyond the bound is dropped whole. Pairs of leaf nodes that are
    left are compared entry by entry."""

    def __init__(self, keys: np.ndarray, codes: np.ndarray, size: np.ndarray, t: float, skip: np.ndarray | None = None) -> None:
        self.t = t
        skip = np.zeros(len(keys), np.int64) if skip is None else skip.astype(np.int64)
        band = (np.log(np.maximum(size, 1)) * (8 / np.log(2))).astype(np.int64)
        self.order = np.lexsort((gray_rank(codes[:, 0]), band, skip // 2, keys))
        keys = keys[self.order]
        self.codes, self.size, self.skip = codes[self.order], size[self.order].astype(np.int64), skip[self.order]
        n = len(keys)
        # the most differing bits by the sum of the sizes
        total = np.arange(2 * (FULL + 1))
        self.bound = np.where(total >= FULL, 1 << 20, ((1 - t) / (1 + t) * total + 1e-6)).astype(np.int32)
        group = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if n else np.zeros(0, np.int64)
        self.levels: list[tuple[np.ndarray, ...]] = []
        first, last, ones, zeros, small, big, skipped = group, np.append(group[1:], n), self.codes, ~self.codes, self.size, self.size, self.skip
        while n:
            # nodes of FAN neighbours, a group's first with its first entry
            count = -(-(last - first) // FAN)
            node = np.repeat(first, count) + FAN * (np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count))
            end = np.minimum(node + FAN, np.repeat(last, count))
            cut = lambda op, x: op.reduceat(x, node, axis=0)
            ones, zeros, small, big, skipped = cut(np.bitwise_and, ones), cut(np.bitwise_and, zeros), cut(np.minimum, small), cut(np.maximum, big), cut(np.minimum, skipped)
            last = np.cumsum(count)
            first = last - count
            self.levels.append((node, end, ones, ones | zeros, small, big, skipped))
            if (count == 1).all():
                break
        self.tops = len(first)

    def _apart(self, level: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs of nodes hold no pair within the bound."""
        _, _, pattern, mask, small, big, skipped = self.levels[level]
        least = skipped[i] + skipped[j]
        for c in range(pattern.shape[1]):
            least += np.bitwise_count((pattern[i, c] ^ pattern[j, c]) & mask[i, c] & mask[j, c])
        far = least > self.bound[np.minimum(big[i] + big[j], len(self.bound) - 1)]
        # sizes stored as FULL count as unlimited
        return far | (self.t * small[i] > big[j] + 1e-6) & (small[i] < FULL) & (big[j] < FULL) | (self.t * small[j] > big[i] + 1e-6) & (small[j] < FULL) & (big[i] < FULL)

    def _below(self, level: int, i: np.ndarray, j: np.ndarray, at_once: int = 400_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The pairs of leaf nodes below pairs of nodes, i <= j."""
        keep = ~self._apart(level, i, j)
        i, j = i[keep], j[keep]
        if level == 0:
            yield i, j
            return
        start, end = self.levels[level][:2]
        step = max(1, at_once // FAN**2)
        for k in range(0, len(i), step):
            p, q = i[k : k + step], j[k : k + step]
            x, y = start[p][:, None] + np.arange(FAN), start[q][:, None] + np.arange(FAN)
            ok = (x < end[p][:, None])[:, :, None] & (y < end[q][:, None])[:, None, :]
            x, y = np.broadcast_to(x[:, :, None], ok.shape), np.broadcast_to(y[:, None, :], ok.shape)
            ok &= x <= y
            yield from self._below(level - 1, x[ok], y[ok], at_once)

    def pairs(self, at_once: int = 1_000) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places (in the given order, each pair once) of one key whose codes differ within the bound."""
        if not self.levels:
            return
        top = np.arange(self.tops)
        start, end, big, skipped = (self.levels[0][i] for i in (0, 1, 5, 6))
        high, low, size = self.codes[:, 0], self.codes[:, 1].astype(np.uint32), self.size.astype(np.int32)
        leaf = np.arange(FAN)
        for nodes_i, nodes_j in self._below(len(self.levels) - 1, top, top):
            # a node of one entry has no pair in itself
            some = (nodes_i != nodes_j) | (end[nodes_i] - start[nodes_i] > 1)
            nodes_i, nodes_j = nodes_i[some], nodes_j[some]
            for k in range(0, len(nodes_i), at_once):
                p, q = nodes_i[k : k + at_once], nodes_j[k : k + at_once]
                wide = int(max((end[p] - start[p]).max(), (end[q] - start[q]).max()))
                x, y = start[p][:, None] + leaf[:wide], start[q][:, None] + leaf[:wide]
                in_x, in_y = x < end[p][:, None], y < end[q][:, None]
                x, y = np.minimum(x, len(size) - 1), np.minimum(y, len(size) - 1)
                off = np.bitwise_count(high[x][:, :, None] ^ high[y][:, None, :])
                off += np.bitwise_count(low[x][:, :, None] ^ low[y][:, None, :])
                # the nodes' own bound first, that of the pair for what is left
                most = np.clip(self.bound[np.minimum(big[p] + big[q], len(self.bound) - 1)] - skipped[p] - skipped[q], 0, 255).astype(np.uint8)
                at = np.flatnonzero(off <= most[:, None, None])
                r, c = np.divmod(at, wide * wide)
                u, v = np.divmod(c, wide)
                ok = in_x[r, u] & in_y[r, v]
                r, u, v = r[ok], u[ok], v[ok]
                a, b = x[r, u], y[r, v]
                once = (a < b) & (off[r, u, v] + self.skip[a] + self.skip[b] <= self.bound[size[a] + size[b]])
                yield self.order[a[once]], self.order[b[once]]


def search(entries: np.ndarray, t: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Candidate pairs of sids among the entries of one partition; the key is the topmost pattern and must agree."""
    k = entries["k"].astype(np.uint64) | entries["k2"].astype(np.uint64) << np.uint64(32)
    # keys of one entry have nothing to find
    order = np.argsort(k)
    k = k[order]
    same = k[1:] == k[:-1]
    more = np.zeros(len(k), bool)
    more[1:] |= same
    more[:-1] |= same
    order, k = order[more], k[more]
    entries = entries[order]
    sid, size = entries["sid"].astype(np.int64), entries["size"].astype(np.int64)
    codes = np.stack([entries["high"], entries["low"].astype(np.uint64)], 1)
    for i, j in GrayIndex(k, codes, size, t, entries["skip"]).pairs():
        # copies out of other batches
        other = sid[i] != sid[j]
        yield sid[i][other], sid[j][other]


def _once(found: list[np.ndarray]) -> pd.DataFrame:
    pairs = np.unique(np.concatenate(found), axis=0)
    return pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


def _candidates(t: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blobs: dict[int, list[bytes]] = {}
        for b in batches:
            for part, e in zip(b["part"], b["entries"]):
                blobs.setdefault(int(part), []).append(e)
        for part in sorted(blobs):
            found, held = [], 0
            for x, y in search(np.frombuffer(b"".join(blobs.pop(part)), ENTRY), t):
                if len(x):
                    found.append(np.stack([np.minimum(x, y), np.maximum(x, y)], 1))
                    held += len(x)
                    if held > 1_000_000:
                        yield _once(found)
                        found, held = [], 0
            if found:
                yield _once(found)

    return run


def _mean_keys(sets: DataFrame, n: int, held: np.ndarray, counts: np.ndarray, *how: float, sample: int = 2_000) -> float:
    """Keys of a record, by a sample; only the sizes of rounds and partitions depend on it."""
    some = [np.asarray(r[0], np.int64) for r in sets.sample(min(1.0, sample / max(n, 1)), 7).select("words").limit(2 * sample).collect()]
    if not some:
        return 1.0
    flat, size = np.concatenate(some), np.array(list(map(len, some)))
    with np.errstate(over="ignore"):
        found = all_keys(flat.view(np.uint64), frequencies(flat, held, counts), np.cumsum(size) - size, size, *how)[1]
    return max(1.0, len(found) / len(some))


def _candidate_pairs(sets: DataFrame, t: float, keys: int, alone: float, hot: float, common: float) -> tuple[np.ndarray, DataFrame]:
    """The table of common words and the candidate pairs, as a table; nothing else of the index outlives the call."""
    held, counts, n = common_words(sets, common)
    how = (t, alone * n, hot * n * n)
    mean = _mean_keys(sets, n, held, counts, *how)
    turns = int(np.ceil(mean / keys))
    # partitions of the index by size: about 400,000 entries each, however many records there are
    parts = max(int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(n * mean / turns) // 400_000 + 1)
    found = []
    for turn in range(turns):
        entries = sets.select("sid", "words").mapInPandas(_entries(held, counts, parts, *how, turn, turns), "part bigint, entries binary")
        found.append(written(entries.repartitionById(parts, F.col("part").cast("int")).mapInPandas(_candidates(t), "a bigint, b bigint")))
        del entries
        free_shuffles(sets.sparkSession)
    return held, written(reduce(DataFrame.unionByName, found).distinct())


def similar_sets(sets: DataFrame, t: float = 0.7, keys: int = 24, alone: float = 0.04, hot: float = 0.004, common: float = 0.0005) -> DataFrame:
    """(a, b, similarity) of the pairs of different sets, by set hash; sets holds row_no, sid and words."""
    held, pairs = _candidate_pairs(sets, t, keys, alone, hot, common)
    free_shuffles(sets.sparkSession)
    ids = pairs.select(F.explode(F.array("a", "b")).alias("sid")).distinct()
    # one row for each set that is in a candidate pair, its words as places in the table of common words or as hashes
    short = sets.select("sid", "words").mapInPandas(_shortened(held), "sid bigint, common binary, others binary")
    texts = written(short.join(ids, "sid", "left_semi").groupBy("sid").agg(F.first("common").alias("common"), F.first("others").alias("others")))
    side = lambda c: texts.select(F.col("sid").alias(c), F.struct("common", "others").alias(f"w{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.mapInPandas(_verified(t), "a bigint, b bigint, similarity double")


def _shortened(held: np.ndarray):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            flat = np.concatenate([np.asarray(w, np.int64) for w in b["words"]])
            end = np.cumsum(b["words"].map(len).to_numpy())
            at = np.minimum(np.searchsorted(held, flat), max(len(held) - 1, 0)) if len(held) else np.zeros(len(flat), np.int64)
            known = held[at] == flat if len(held) else np.zeros(len(flat), bool)
            place, rest, upto = at[known].astype(np.int32), flat[~known], np.concatenate([[0], np.cumsum(known)])
            common, others, start = [], [], 0
            for e in end:
                i, j = upto[start], upto[e]
                common.append(place[i:j].tobytes())
                others.append(rest[start - i : e - j].tobytes())
                start = e
            yield pd.DataFrame({"sid": b["sid"], "common": common, "others": others})

    return run


def _verified(t: float):
    """The exact similarity of candidate pairs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for x, y, p, q in zip(b["a"], b["b"], b["wa"], b["wb"]):
                n = both = 0
                for part, kind in (("common", np.int32), ("others", np.int64)):
                    u, v = np.frombuffer(p[part], kind), np.frombuffer(q[part], kind)
                    n += len(u) + len(v)
                    both += len(np.intersect1d(u, v, assume_unique=True))
                # in whole numbers where the ratio is at the threshold
                if n - both and both >= t * (n - both) - 1e-9:
                    out.append((x, y, both / (n - both)))
            yield pd.DataFrame(out, columns=["a", "b", "similarity"])

    return run


def with_ids(pool: DataFrame) -> DataFrame:
    """Word sets with sid, the hash of the sorted set: copies have one sid."""
    sets = word_sets(pool)
    return sets.withColumn("sid", F.xxhash64(F.sort_array("words")))


def stored(pool: DataFrame, leave_out: DataFrame | None = None) -> DataFrame:
    """The word sets as a table: words repeat, so that its dictionary takes two bytes a word; rows of leave_out are left out."""
    sets = with_ids(spread(pool))
    return written(sets if leave_out is None else sets.join(leave_out.select("row_no"), "row_no", "left_anti"))


def similar_rows(pool: DataFrame, t: float = 0.7, leave_out: DataFrame | None = None, **how: float) -> DataFrame:
    """All pairs (row_a, row_b, similarity), row_a < row_b, of rows whose similarity is t or more, copies included."""
    sets = stored(pool, leave_out)
    linked = written(similar_sets(sets, t, **how))
    member = sets.select("sid", "row_no").distinct()
    in_pairs = linked.join(member.select(F.col("sid").alias("a"), F.col("row_no").alias("ra")), "a").join(member.select(F.col("sid").alias("b"), F.col("row_no").alias("rb")), "b")
    different = in_pairs.select(F.least("ra", "rb").alias("row_a"), F.greatest("ra", "rb").alias("row_b"), "similarity")
    many = member.groupBy("sid").agg(F.count("*").alias("n")).where("n > 1").select("sid")
    copies = member.join(many, "sid", "left_semi")
    x, y = copies.select("sid", F.col("row_no").alias("row_a")), copies.select("sid", F.col("row_no").alias("row_b"))
    equal = x.join(y, "sid").where("row_a < row_b").select("row_a", "row_b", F.lit(1.0).alias("similarity"))
    return different.where("row_a < row_b").unionByName(equal)


def groups(pool: DataFrame, t: float = 0.7, leave_out: DataFrame | None = None, **how: float) -> DataFrame:
    """One row per record with its group and its number of links to different texts: row_no, group_no, links.

    The group is the least row_no reachable through pairs; copies share a group."""
    from gleaner.llm.seen import components

    sets = stored(pool, leave_out)
    linked = written(similar_sets(sets, t, **how).select("a", "b"))
    both = linked.unionByName(linked.select(F.col("b").alias("a"), F.col("a").alias("b")))
    links = both.groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "sid")
    # every pair is a node of one side, its two sets nodes of the other
    edge = linked.select(F.concat_ws(" ", "a", "b").alias("pair"), "a", "b")
    labels = components(edge.select(F.col("pair").alias("a"), F.col("a").alias("b")).unionByName(edge.select(F.col("pair").alias("a"), "b")))
    named = sets.select("row_no", "sid").distinct().join(labels.withColumnRenamed("b", "sid"), "sid", "left").withColumn("class", F.coalesce("label", "sid"))
    least = named.groupBy("class").agg(F.min("row_no").alias("group_no"))
    return named.join(least, "class").join(links, "sid", "left").select("row_no", "group_no", F.coalesce("links", F.lit(0)).alias("links"))
