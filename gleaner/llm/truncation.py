"""Text cut off by field limits.

Every summary's ending is classed: whole, open (no end of a sentence, though the text has sentences that end), mark (an ellipsis
or a link to go on stands where the text breaks off), broken (inside a character, entity, tag or link), number (a full stop
that may be the middle of a version) or headline (one phrase without any punctuation, as publishers write them).

Field limits show as lengths at which far more texts stop than at the lengths around them: for each source and for all, in
characters, bytes and visible characters, the hazard of an unfinished stop at length L is tested against the hazard of the
neighbouring lengths, and the false discovery rate over all tests is held. An unfinished ending is a cut by evidence only:
'limit' (its length is significant), 'mark' or 'broken' (the cut shows), 'transfer' (a text that ends its other sentences does
not end its last one), or 'long' (a phrase without punctuation longer
than such phrases are: the tail of their lengths, under the same false-discovery control).

Null and blank summaries are no case and count for no share.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleaner.functions.names import name_core
from gleaner.llm.residue import clean
from gleaner.session import spread, written

#: What publishers put at a cut (fixed values).
MARK = re.compile(
    r"(?:\s*(?:\[\s*(?:…|\.\.\.)\s*\]|\(\s*(?:more|mehr|suite|más|weiter)\s*(?:…|\.\.\.)?\s*\)|…|\.{3,}|>>|»|→|›|"
    r"\b(?:read more|continue reading|keep reading|full story|view more|more|weiterlesen|mehr lesen|lire la suite|lire plus|leer más|seguir leyendo)\b))+[\s.:]*$",
    re.I,
)
END = re.compile(r"[.!?。！？؟।][\"'”’»›)\]]*$")
#: What may follow a complete text: a count of stars, a signature in brackets, a language mark.
TAIL = re.compile(r"([.!?…][\"'”’»)\]]*)\s*(?:★\s*[\d.,]+|\(\w{1,12}\.?\)|\[\w{2}\])\s*$")
OPEN_TAG = re.compile(r"<(?:[A-Za-z/!][^<>]*)?$")
OPEN_ENTITY = re.compile(r"&(?:#[xX]?[0-9a-fA-F]*|[a-z]{1,7})?$")
OPEN_VERSION = re.compile(r"\b(?:release|version|versión)\s+\d+\.$", re.I)
INNER = re.compile(r"[.!?…][\"'”’»)\]]*\s")


MEASURES = ("chars", "bytes", "shown")


def unmarked(text: str) -> str:
    """text without the marks at its end; the part that is searched grows while marks fill it."""
    size = 80
    while True:
        m = MARK.search(text[-size:])
        if not m:
            return text
        if m.start() > 0 or size >= len(text):
            return text[-size:][: m.start()] if size >= len(text) else text[:-size] + text[-size:][: m.start()]
        size *= 2


def ending(raw: str) -> str:
    """'whole', 'open', 'mark', 'broken', 'headline' or 'number'."""
    body = raw.rstrip()
    bare = unmarked(body)
    for s in (body, bare):
        if s.endswith("�") or s and 0xD800 <= ord(s[-1]) <= 0xDFFF or "<" in s and OPEN_TAG.match(s[s.rindex("<"):]) or OPEN_ENTITY.search(s[-12:]):
            return "broken"
    if "<" in body and len(re.findall(r"<a\s", body, re.I)) > len(re.findall(r"</a\s*>", body, re.I)):
        return "broken"
    text = clean(raw)
    if not text:
        return "whole"
    base = unmarked(text)
    if base != text and not (text.endswith("»") and text.count("«") >= text.count("»")):
        return "whole" if END.search(base[-12:]) or not base else "mark"
    if END.search(text[-12:]):
        return "number" if OPEN_VERSION.search(text[-30:]) else "whole"
    if TAIL.search(text[-40:]):
        return "whole"
    if text[-1].isalnum() and not INNER.search(text):
        return "headline"
    return "open"


def _lengths(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        out = []
        for row_no, source, s in zip(b["row_no"], b["source"], b["summary"]):
            if not isinstance(s, str) or not s.strip():
                continue
            shown = clean(s)
            out.append((row_no, source, ending(s), len(s), len(s.encode("utf-8", "replace")), len(shown)))
        yield pd.DataFrame(out, columns=["row_no", "source", "ending", "chars", "bytes", "shown"])


def endings(pool: DataFrame) -> DataFrame:
    """row_no, source (the name's core), ending and the three lengths of every row with a summary."""
    named = pool.select("row_no", F.coalesce(name_core(F.col("source")), F.lit("")).alias("source"), "summary")
    return spread(named).mapInPandas(_lengths, "row_no bigint, source string, ending string, chars int, bytes int, shown int")


def discovered(tests: DataFrame, alpha: float) -> DataFrame:
    """The tests (score: -log10 p, 300 at most) that Benjamini-Hochberg at alpha keeps, by counts of rounded scores."""
    grid = tests.groupBy(F.floor(F.col("score") * 10).alias("step")).agg(F.count("*").alias("n"))
    every = Window.orderBy(F.col("step").desc())  # at most 3001 steps
    ranked = grid.withColumn("rank", F.sum("n").over(every)).withColumn("m", F.sum("n").over(Window.partitionBy()))
    least_step = ranked.where(F.pow(F.lit(10.0), -F.col("step") / 10) * F.col("m") <= alpha * F.col("rank")).agg(F.min("step").alias("from"))
    # one row
    return tests.crossJoin(F.broadcast(least_step)).where(F.floor(F.col("score") * 10) >= F.col("from")).drop("from")


def overlong(ended: DataFrame, alpha: float = 0.01) -> DataFrame:
    """row_no of the headlines longer than headlines are: -log10 of the normal tail (Mills' bound) beyond their median length, in
    robust deviations, under the false-discovery control over all headlines."""
    heads = ended.where("ending = 'headline'").select("row_no", "shown")
    q = F.percentile_approx("shown", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10_000)
    fit = heads.agg(q.alias("q")).select(F.col("q")[1].alias("middle"), ((F.col("q")[2] - F.col("q")[0] + 1) / 1.349).alias("spread"))
    z = (F.col("shown") - F.col("middle")) / F.col("spread")
    # one row
    tests = heads.crossJoin(F.broadcast(fit)).select("row_no", F.when(z > 1, (z * z / 2 + F.log(z * 2.5066)) / F.log(F.lit(10.0))).otherwise(0.0).alias("score"))
    return discovered(tests.withColumn("score", F.least("score", F.lit(300.0))), alpha).where("score > 0").select("row_no")


def limits(ended: DataFrame, alpha: float = 0.01, around: int = 12, least: int = 5, ratio: float = 3.0, heads: int = 20) -> DataFrame:
    """Lengths at which a source (or '*', all sources) cuts: source, measure, length, stops, at_risk, hazard, p.

    hazard = unfinished stops at the length / texts at least as long. The hazard of the lengths at most `around` away is
    what chance gives; p is the Chernoff bound of the binomial tail; Benjamini-Hochberg over all tests by counts of
    rounded -log10 p, so that no single task ranks them. At least `least` stops are needed, and a hazard `ratio` times that of
    the neighbours: among many texts any unevenness of lengths is significant. Headlines are stops of a second kind in the same
    tests, per measure and against the same neighbours: their lengths cluster by themselves, so a length at which they stop
    must besides hold back half of the texts that reach it, and `heads` of them, as a field limit does."""
    unfinished = F.col("ending").isin("open", "mark", "broken", "number").cast("int")
    measured = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).alias("length")) for m in MEASURES])).alias("m")
    each = ended.select("source", unfinished.alias("text"), (F.col("ending") == "headline").cast("int").alias("head"), measured)
    own = each.groupBy("source", "m.measure", "m.length").agg(F.sum("text").alias("text"), F.sum("head").alias("head"), F.count("*").alias("n"))
    # all sources together, out of the counts of each
    both = own.select(F.explode(F.array("source", F.lit("*"))).alias("source"), "measure", "length", "text", "head", "n")
    summed = both.groupBy("source", "measure", "length").agg(F.sum("text").alias("text"), F.sum("head").alias("head"), F.sum("n").alias("n"))
    kinds = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("stops")) for k in ("text", "head")])).alias("k")
    by = summed.select("source", "measure", "length", "n", kinds).select("source", "k.kind", "measure", "length", "k.stops", "n")
    # one window holds the lengths of one source and measure: as many rows as there are lengths, not texts
    w = Window.partitionBy("source", "kind", "measure").orderBy(F.col("length").desc())
    near = Window.partitionBy("source", "kind", "measure").orderBy("length").rangeBetween(-around, around)
    hazards = by.withColumn("at_risk", F.sum("n").over(w)).withColumn("near_stops", F.sum("stops").over(near) - F.col("stops")).withColumn(
        "near_risk", F.sum("at_risk").over(near) - F.col("at_risk")
    )
    h, h0 = F.col("stops") / F.col("at_risk"), (F.col("near_stops") + 0.5) / (F.col("near_risk") + F.col("at_risk") + 1.0)
    rest = F.when(h < 1, (1 - h) * F.log((1 - h) / (1 - h0))).otherwise(0.0)
    bound = F.when(h > h0, F.col("at_risk") * (h * F.log(h / h0) + rest) / F.log(F.lit(10.0))).otherwise(0.0)
    tests = hazards.where(F.col("stops") > 0).select(
        "source", "kind", "measure", "length", "stops", "at_risk", h.alias("hazard"), F.least(bound, F.lit(300.0)).alias("score"), (h >= ratio * h0).alias("steep")
    )
    return (
        discovered(tests, alpha)
        .where((F.col("stops") >= least) & F.col("steep"))
        .where((F.col("kind") == "text") | (F.col("stops") >= heads) & (F.col("hazard") >= 0.5))
        .select("source", "measure", "length", "stops", "at_risk", "hazard", F.pow(F.lit(10.0), -F.col("score")).alias("p"))
    )


def cuts(ended: DataFrame, at: DataFrame, alpha: float = 0.01) -> DataFrame:
    """ended with at_limit (its length is one at which its source or all sources cut), evidence and cut."""
    # one row a source; the lengths of all sources are one row
    lengths = lambda m: F.collect_set(F.when(F.col("measure") == m, F.col("length"))).alias(f"at_{m}")
    marks = at.groupBy("source").agg(*map(lengths, MEASURES))
    everywhere = at.where("source = '*'").agg(*[x.alias(f"all_{m}") for m, x in zip(MEASURES, map(lengths, MEASURES))])
    far = overlong(ended, alpha).distinct().withColumn("far", F.lit(True))
    known = ended.crossJoin(F.broadcast(everywhere)).join(marks, "source", "left").join(far, "row_no", "left")
    inside = [F.array_contains(f"{w}_{m}", F.col(m)) for w in ("at", "all") for m in MEASURES]
    e = F.col("ending")
    limit = (e != "whole") & F.coalesce(F.greatest(*[F.coalesce(x, F.lit(False)) for x in inside]), F.lit(False))
    evidence = (
        F.when(e.isin("mark", "broken"), e).when(limit, "limit").when(e == "open", "transfer").when((e == "headline") & F.col("far"), "long")
    )
    return known.select("row_no", "source", "ending", "chars", limit.alias("at_limit"), evidence.alias("evidence"), evidence.isNotNull().alias("cut"))


def truncated(pool: DataFrame, alpha: float = 0.01) -> DataFrame:
    """row_no, source, ending, chars, at_limit, evidence, cut of every pool row with a summary."""
    ended = written(endings(pool))
    return cuts(ended, limits(ended, alpha), alpha)


def source_shares(found: DataFrame) -> DataFrame:
    """How often each source truncates: source, texts, cut, at_limit (cuts at its limits), share."""
    return found.groupBy("source").agg(
        F.count("*").alias("texts"), F.sum(F.col("cut").cast("int")).alias("cut"), F.sum((F.col("cut") & F.col("at_limit")).cast("int")).alias("at_limit")
    ).withColumn("share", F.round(F.col("cut") / F.col("texts"), 6))
