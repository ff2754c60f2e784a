"""Character vocabularies: building, counting, checking, joining."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from corpusflow.functions.chars import MAX_CODE_POINTS, explode_chars
from corpusflow.ship import ship_package

# Texts whose characters are counted at once.
COUNT_ROWS = 256


def distinct_chars(df: DataFrame, text: str = "text") -> DataFrame:
    """The characters in use: every task counts code points and hands on one row per character."""
    return char_freq(df, text).select("ch")


def _one_each(vocab: DataFrame) -> DataFrame:
    """The rows of single characters, one for each: no more than there are code points, so fit for broadcast."""
    return vocab.where(F.length("ch") == 1).dropDuplicates(["ch"])


def build_vocab(df: DataFrame, text: str = "text") -> DataFrame:
    """``(id, ch)``: sorted distinct characters numbered from 0.

    The unpartitioned window holds the vocabulary only, at most one row per code point.
    """
    number = F.row_number().over(Window.orderBy("ch")) - 1
    return distinct_chars(df, text).select(number.alias("id"), "ch")


def vocab_size(df: DataFrame, text: str = "text") -> DataFrame:
    """Number of distinct characters."""
    return distinct_chars(df, text).agg(F.count("*").alias("vocab_size"))


def _counted_chars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each character of a task's texts, with its occurrences."""
    counts = np.zeros(MAX_CODE_POINTS, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, COUNT_ROWS):
            texts = pc.fill_null(batch.column(0).slice(at, COUNT_ROWS), "").to_pylist()
            found = np.bincount(np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32))
            counts[: len(found)] += found
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array([chr(p) for p in seen], pa.string()), pa.array(counts[seen], pa.int64())], ["ch", "cnt"])


def char_freq(df: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """Occurrences of each character.

    Without groups, every task counts code points and hands on one row per character.
    """
    if not by:
        ship_package(df.sparkSession)
        counted = df.select(text).mapInArrow(_counted_chars, "ch string, cnt long")
        return counted.groupBy("ch").agg(F.sum("cnt").alias("cnt"))
    rows = df.select(*by, F.explode(F.split(text, "")).alias("ch")).where(F.col("ch") != "")
    return rows.groupBy(*by, "ch").agg(F.count("*").alias("cnt"))


def corpus_stats(df: DataFrame, text: str = "text", by: tuple[str, ...] = ()) -> DataFrame:
    """``(by…, documents, chars, vocab_size)`` in one grouped aggregate.

    Every text becomes one row per distinct character; its first row carries the length.
    """
    rows = df.select(*by, F.length(text).alias("len"), F.posexplode(F.array_distinct(F.split(text, ""))).alias("pos", "ch"))
    once = F.col("pos") == 0
    return rows.groupBy(*by).agg(
        F.count(F.when(once, 1)).alias("documents"),
        F.coalesce(F.sum(F.when(once, F.col("len"))), F.lit(0)).alias("chars"),
        F.countDistinct(F.when(F.col("ch") != "", F.col("ch"))).alias("vocab_size"),
    )


def oov_chars(df: DataFrame, vocab: DataFrame, text: str = "text") -> DataFrame:
    """Characters of the corpus that the vocabulary lacks, with their counts."""
    return char_freq(df, text).join(F.broadcast(_one_each(vocab).select("ch")), "ch", "left_anti")


def oov_rows(df: DataFrame, vocab: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Rows with characters outside the vocabulary, and which ones.

    The vocabulary is bounded by Unicode, so it may be broadcast; a row is cut down to
    its distinct characters before it meets the vocabulary.
    """
    chars = df.select(key, F.explode(F.array_distinct(F.split(text, ""))).alias("ch")).where(F.col("ch") != "")
    missing = chars.join(F.broadcast(_one_each(vocab).select("ch")), "ch", "left_anti")
    return missing.groupBy(key).agg(F.array_sort(F.collect_list("ch")).alias("chars"))


def token_long(df: DataFrame, vocab: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per character with its id: ``keys…, pos, ch, id`` (broadcast hash join)."""
    return explode_chars(df, text, keys).join(F.broadcast(_one_each(vocab).select("ch", "id")), "ch")
