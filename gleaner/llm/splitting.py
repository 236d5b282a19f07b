"""Splitting oversized items at natural boundaries.

A text above the limit is cut by recursive bisection: at the strongest boundary near the midpoint of its tokens, the halves
again while they exceed the limit minus the overlap; then every piece but the first is given the last tokens of its
predecessor, as many as the overlap allows. Boundaries are, from the strongest: a heading, a blank line (or the end of a
code block), a line's end, a sentence's end, a clause's end, a word's end before white space, and any word's end where there is
nothing else; a single word above the limit is cut between its tokens' characters. Pieces in order, without their overlaps,
give the text back exactly.

The overlap begins at a word's start; inside the word before the cut where that alone has more tokens than the overlap
allows. A piece has none only where not even a character more fits into the limit.

Sizes are tokens of the public tokenizer; a worker encodes every distinct word once and adds up the words of a part.

Defined results: a text within the limit is one piece without overlap; null and empty texts have none; mixed line ends
stay; repeated doc_ids are split alike, each."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gleaner.llm import encode as E
from gleaner.session import spread

LIMIT = 512
OVERLAP = 32
#: How far from the midpoint a stronger boundary may draw the cut, as shares of the text.
REACH = (0.45, 0.40, 0.35, 0.30, 0.20)

HEADING = re.compile(r"(?m)(?<=[\r\n])(?=(?:#{1,6} |={3,}|-{3,}|\*{3,}))")
BLANK = re.compile(r"(?:\r\n|\r|\n)[ \t]*(?:\r\n|\r|\n)+|(?m:^```[^\r\n]*(?:\r\n|\r|\n))")
LINE = re.compile(r"\r\n|\r|\n")
SENTENCE = re.compile(r"[.!?…。！？؟।][\"'”’»)\]]*(?:\s+|(?<=[。！？]))")
CLAUSE = re.compile(r"[,;:、，；]\s*|\s[–—-]\s")


def boundaries(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Positions at which a piece may begin, sorted, and their strengths (4 heading ... 0 a clause's end)."""
    best: dict[int, int] = {}
    for strength, pattern in enumerate((CLAUSE, SENTENCE, LINE, BLANK, HEADING)):
        for m in pattern.finditer(text):
            best[m.end()] = strength
    best.pop(0, None)
    best.pop(len(text), None)
    at = np.array(sorted(best), np.int64)
    return at, np.array([best[int(x)] for x in at], np.int64)


class Counts(dict):
    """Tokens of a word, encoded when first asked for."""

    def __init__(self, encode) -> None:
        self.encode = encode

    def __missing__(self, word: str) -> int:
        n = len(self.encode(word))
        if len(self) < 500_000:  # bounds a worker's memory
            self[word] = n
        return n


class Measure:
    """Token counts of parts of one text by its words: a prefix sum over the words' ends."""

    def __init__(self, text: str, split, counts: Counts) -> None:
        self.text, self.split, self.count = text, split, counts.__getitem__
        self.words = split(text)
        n = list(map(self.count, self.words))
        self.total = sum(n)
        self.n = n

    def prepare(self) -> None:
        self.ends = np.cumsum(np.fromiter(map(len, self.words), np.int64, len(self.words)))
        self.tokens = np.cumsum(np.array(self.n, np.int64))
        #: Whether white space follows the word.
        self.spaced = np.array([w[:1].isspace() for w in self.words[1:]] + [False], bool)

    def whole_at(self, pos: int) -> bool:
        """Whether pos lies between words, or in one of at most 24 characters: a cut there changes the count by little."""
        i = int(np.searchsorted(self.ends, pos))
        return i >= len(self.ends) or self.ends[i] == pos or len(self.words[i]) <= 24

    def fits(self, start: int, end: int, room: int) -> bool:
        """Whether the part has at most `room` tokens; counted as a text of its own where the prefix sums come near."""
        near, slack = int(self.upto(end)) - int(self.upto(start)), room // 5 + 16
        if (near + slack <= room or near > room + slack) and self.whole_at(start) and self.whole_at(end):
            return near < room
        return self.exact(start, end) <= room

    def upto(self, at: np.ndarray | int):
        """Tokens of the words that end at or before the position."""
        i = np.searchsorted(self.ends, at, side="right")
        return np.where(i > 0, self.tokens[np.maximum(i - 1, 0)], 0) if len(self.tokens) else np.zeros_like(i)

    def exact(self, start: int, end: int) -> int:
        """Tokens of the part as a text of its own."""
        return sum(map(self.count, self.split(self.text[start:end])))


def cut_spans(text: str, limit: int, overlap: int, split, counts: Counts) -> list[tuple[int, int, int, int]]:
    """(start, end, begin, tokens) of the pieces: text[start:end] partition the text, text[begin:start] is the overlap."""
    if not text:
        return []
    m = Measure(text, split, counts)
    if m.total <= limit:
        return [(0, len(text), 0, m.total)]
    m.prepare()
    room = limit - overlap
    at, strength = boundaries(text)
    spans: list[tuple[int, int]] = []
    todo = [(0, len(text))]
    while todo:
        start, end = todo.pop()
        if end - start <= 1 or m.fits(start, end, room):
            spans.append((start, end))
            continue
        cut = _cut(m, at, strength, start, end)
        todo.append((cut, end))
        todo.append((start, cut))
    spans = _merged(spans, m, room)
    out = [(*spans[0], spans[0][0], m.exact(*spans[0]))]
    for start, end in spans[1:]:
        out.append((start, end, *_overlap(m, start, end, limit, overlap, out[-1][0])))
    return out


def _cut(m: Measure, at: np.ndarray, strength: np.ndarray, start: int, end: int) -> int:
    i, j = np.searchsorted(at, start, "right"), np.searchsorted(at, end, "left")
    here, kind = at[i:j], strength[i:j]
    low, high = int(m.upto(start)), int(m.upto(end))
    if len(here):
        place = (m.upto(here) - low) / max(high - low, 1)
        off = np.abs(place - 0.5)
        for s in range(4, -1, -1):
            near = np.flatnonzero((kind == s) & (off <= REACH[4 - s]))
            if len(near):
                return int(here[near[int(off[near].argmin())]])
    # no boundary near: the nearest word's end before white space, then any word's end, then the middle of the one word
    w = np.searchsorted(m.ends, start, "right")
    v = np.searchsorted(m.ends, end, "left")
    ends = m.ends[w:v]
    if len(ends):
        order = np.argsort(np.abs(m.tokens[w:v] - (low + high) / 2), kind="stable")
        spaced = order[m.spaced[w:v][order]]
        return int(ends[spaced[0] if len(spaced) else order[0]])
    if len(here):
        return int(here[len(here) // 2])
    middle = (start + end) // 2
    # not between a base character and what combines with it
    while middle < end - 1 and 0x300 <= ord(m.text[middle]) <= 0x36F:
        middle += 1
    return middle


def _merged(spans: list[tuple[int, int]], m: Measure, room: int) -> list[tuple[int, int]]:
    """Neighbours that fit together are one piece: bisection leaves pieces of half the room."""
    out = [spans[0]]
    for start, end in spans[1:]:
        if m.fits(out[-1][0], end, room):
            out[-1] = (out[-1][0], end)
        else:
            out.append((start, end))
    return out


def _overlap(m: Measure, start: int, end: int, limit: int, overlap: int, least: int) -> tuple[int, int]:
    """Where the overlap before start begins, the earliest word's start such that it holds at most `overlap` tokens, and
    the tokens of the piece with it."""
    if overlap <= 0:
        return start, m.exact(start, end)
    i = int(np.searchsorted(m.ends, start, "right"))
    ends, held = m.ends[:i], int(m.upto(start))
    # by the prefix sums first; only the choice is counted as a text of its own, and made later while it is too long
    first = int(np.searchsorted(m.tokens[:i], held - overlap, "left"))
    for e in ends[first:]:
        e = int(e)
        if e >= start:
            break
        if e >= least and m.fits(e, start, overlap) and (n := m.exact(e, end)) <= limit:
            return e, n
    # the word before start is too long as a whole: a part of it, the longest that fits
    for back in (128, 96, 64, 48, 32, 24, 16, 12, 8, 6, 4, 3, 2, 1):
        e = start - back
        while least < e < start and 0x300 <= ord(m.text[e]) <= 0x36F:
            e += 1
        if least <= e < start and m.exact(e, start) <= overlap and (n := m.exact(e, end)) <= limit:
            return e, n
    return start, m.exact(start, end)


def _pieces(limit: int, overlap: int, vocabulary: str):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split, counts = E.splitter(), Counts(E.encoder(vocabulary))
        for b in batches:
            rows = []
            for doc_id, text in zip(b["doc_id"], b["text"]):
                if not isinstance(text, str) or not text:
                    continue
                text = E.whole(text)
                for i, (start, end, begin, n) in enumerate(cut_spans(text, limit, overlap, split, counts)):
                    rows.append((doc_id, i, begin, start, end, n, text[begin:end]))
            yield pd.DataFrame(rows, columns=["doc_id", "piece", "begin", "start", "end", "tokens", "text"])

    return run


def split(documents: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, vocabulary: str = E.VOCABULARY) -> DataFrame:
    """(doc_id, piece, begin, start, end, tokens, text): text is the document's [begin, end), of which [begin, start) repeats
    the piece before; positions count code points. No piece has more than `limit` tokens unless one character has."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and below the limit")
    out = "doc_id bigint, piece int, begin int, start int, end int, tokens int, text string"
    return spread(documents.select("doc_id", "text")).mapInPandas(_pieces(limit, overlap, E.send(documents.sparkSession, vocabulary)), out)
