"""Encoding of the whole corpus with a public tokenizer.

Texts are split by the tokenizer's pattern; every distinct word of a block of documents is gathered once, the words of all
blocks are brought together by word, each is encoded once, and the ids go back to the blocks that hold the word, where
they are put in the places of the word in every text. Blocks are bounded in size, so is what a block needs of the table, and there are
as many partitions as blocks, so that more text gives more tasks and not larger ones. Decoding
explodes the ids, joins the table of pieces and joins the pieces in order.

Defined results: a null, empty or blank-less text: null and empty give an empty list, blanks their own ids; strings that look like
special tokens are ordinary text; very long texts are taken whole; repeated doc_ids give a row each."""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Where the vocabulary files are; a parameter everywhere.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The pattern that splits text before the merges (a fixed value of the vocabulary).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters of text in a block, about; the unit that meets its part of the word table in one task.
BLOCK_CHARS = 3_000_000


def splitter():
    import regex

    return regex.compile(PATTERN).findall


_SENT: set[tuple[str, str]] = set()


def send(spark: SparkSession, path: str) -> str:
    """Gives the vocabulary file to the executors, once a session; the name by which ranks finds it there."""
    sc = spark.sparkContext
    if (sc.applicationId, path) not in _SENT:
        sc.addFile(path)
        _SENT.add((sc.applicationId, path))
    return path


def ranks(path: str) -> dict[bytes, int]:
    from pyspark import SparkFiles

    sent = SparkFiles.get(os.path.basename(path)) if SparkFiles._root_directory or SparkFiles._is_running_on_worker else path
    with open(sent if os.path.exists(sent) else path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f) if a}


def encoder(path: str):
    """str -> list of ids for one word."""
    import tiktoken

    return tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks(path), special_tokens={}).encode_ordinary


def whole(text: str) -> str:
    """Text that UTF-8 can hold: lone surrogates become the replacement character."""
    return text.encode("utf-16", "surrogatepass").decode("utf-16", "replace") if not text.isascii() else text


def blocked(documents: DataFrame, block_chars: int = BLOCK_CHARS) -> tuple[DataFrame, int]:
    """(doc_id, text, block) with about block_chars characters a block, in as many partitions as blocks, and their number.

    Rows of one doc_id, null included, are dealt by their text too."""
    chars = documents.agg(F.sum(F.length("text"))).head()[0] or 0
    blocks = max(documents.sparkSession.sparkContext.defaultParallelism, int(chars // block_chars) + 1)
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int")
    return documents.select("doc_id", "text", block.alias("block")).repartition(blocks, "block"), blocks


def _block_words(key: tuple, texts: pd.DataFrame) -> pd.DataFrame:
    """The distinct words of a block."""
    split, seen = splitter(), set()
    for text in texts["text"]:
        if isinstance(text, str) and text:
            seen.update(split(whole(text)))
    return pd.DataFrame({"block": np.full(len(seen), key[0], np.int32), "word": pd.Series(list(seen), dtype=object)})


def _encoded(path: str):
    """Adds ids to (word, block) in the order of words: each word is encoded when it first comes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode, last, ids = encoder(path), None, None
        for b in batches:
            out = []
            for w in b["word"]:
                if w != last:
                    last, ids = w, np.array(encode(w), np.int32)
                out.append(ids)
            yield b.assign(ids=_column(out).set_axis(b.index))

    return run


def _joined(key: tuple, texts: Iterator[pd.DataFrame], table: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    split, ids = splitter(), {}
    for b in table:
        for w, x in zip(b["word"], b["ids"]):
            ids[w] = x
    for b in texts:
        out = []
        for text in b["text"]:
            words = split(whole(text)) if isinstance(text, str) and text else []
            out.append(np.concatenate([ids[w] for w in words]) if words else np.zeros(0, np.int32))
        yield pd.DataFrame({"doc_id": b["doc_id"].to_numpy(), "ids": _column(out)})


def word_table(texts: DataFrame, blocks: int, vocabulary: str = VOCABULARY) -> DataFrame:
    """(block, word, ids): the distinct words of every block. All rows of a word lie in one partition, one after the other, and
    the word is encoded once."""
    found = texts.groupBy("block").applyInPandas(_block_words, "block int, word string")
    path = send(texts.sparkSession, vocabulary)
    return found.repartition(blocks, "word").sortWithinPartitions("word").mapInPandas(_encoded(path), "block int, word string, ids array<int>")


def encode(documents: DataFrame, vocabulary: str = VOCABULARY, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """(doc_id, ids) of documents (doc_id, text). Texts are shuffled once, by block: the words and the ids use that exchange."""
    texts, blocks = blocked(documents, block_chars)
    table = word_table(texts, blocks, vocabulary).repartition(blocks, "block")
    return texts.groupBy("block").cogroup(table.groupBy("block")).applyInPandas(_gathered, "doc_id bigint, ids array<int>")


def _gathered(key: tuple, texts: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
    parts = list(_joined(key, iter([texts]), iter([table])))
    return pd.concat(parts)


def _column(values: list) -> pd.Series:
    """Arrays as a column, also where there are none or all are of one length."""
    out = pd.Series([None] * len(values), dtype=object)
    out[:] = values
    return out


def pieces(spark: SparkSession, vocabulary: str = VOCABULARY) -> DataFrame:
    """The id-to-piece table (id, piece as bytes); as long as the vocabulary."""
    return spark.createDataFrame([(i, bytearray(p)) for p, i in ranks(vocabulary).items()], "id int, piece binary")


def decode(encoded: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, text) of encoded (doc_id, ids): the round trip of encode but that null becomes empty. Repeated doc_ids give a row
    each."""
    spark = encoded.sparkSession
    table = F.broadcast(pieces(spark, vocabulary))  # the vocabulary, whatever the input
    rows = encoded.groupBy("doc_id", "ids").agg(F.count("*").alias("n")).withColumn("key", F.md5(F.array_join("ids", " ")))
    each = rows.select("doc_id", "key", "n", F.posexplode_outer("ids").alias("pos", "id"))
    joined = each.join(table, "id", "left")
    hexed = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), F.struct("pos", "piece")))), lambda x: F.hex(x["piece"])), "")
    texts = joined.groupBy("doc_id", "key", "n").agg(F.decode(F.unhex(hexed), "UTF-8").alias("text"))
    return texts.select("doc_id", F.explode(F.array_repeat("text", F.col("n").cast("int"))).alias("text"))
