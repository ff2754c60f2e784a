"""Character corpus from documents: vocabulary, 90/10 cut, ids, pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.chars import collect_vocab, encode_column
from corpusflow.operators.encode import CharEncoder
from corpusflow.operators.ngram import count_ngrams
from corpusflow.operators.pages import cut_pages, in_order, token_offsets
from corpusflow.operators.splits import split_contiguous
from corpusflow.operators.vocab import build_vocab
from corpusflow.sources.tables import spread


def char_encoder(docs: DataFrame) -> CharEncoder:
    """The encoder of all characters in the texts."""
    return CharEncoder(collect_vocab(build_vocab(spread(docs, "doc_id"))))


def char_split(docs: DataFrame, fraction: float = 0.9) -> tuple[DataFrame, CharEncoder]:
    """Documents cut into train and val and encoded by character, with the encoder used."""
    encoder = char_encoder(docs)
    return encoder.encode(spread(split_contiguous(docs, fraction), "doc_id")), encoder


def char_totals(docs: DataFrame, fraction: float = 0.9) -> DataFrame:
    """``(split, documents, tokens)`` of the encoded corpus: the encoder runs on every text."""
    encoded, _ = char_split(docs, fraction)
    return encoded.groupBy("split").agg(
        F.count("*").alias("documents"), F.sum(F.size("ids")).cast("bigint").alias("tokens")
    )


def char_pages(docs: DataFrame, page_size: int = 1024, encoder: CharEncoder | None = None, split: str = "split") -> DataFrame:
    """Pages of the encoded texts of ``(split, doc_id, text)``.

    Offsets need lengths only, so the texts are encoded after they met their offsets:
    a character of text is a byte or two in a shuffle, an id four.  Texts are exchanged once.
    """
    encoder = encoder or char_encoder(docs)
    offsets = token_offsets(docs, length=F.length("text"), split=split)
    return cut_pages(encoder.encode(in_order(docs.select(split, "doc_id", "text"), offsets, split=split)), page_size, split)


def char_ngrams(docs: DataFrame, encoder: CharEncoder, n: int = 2, by: tuple[str, ...] = (), split: str = "split") -> DataFrame:
    """N-gram counts of ``(split, doc_id, text)`` in order, without pages.

    The summaries of the documents come from the ends of their texts.
    """
    ends = docs.where(F.length("text") > 0)
    coded = lambda cut: encode_column(cut, encoder.vocab, encoder.oov, encoder.unk)
    edges = ends.select(split, "doc_id", coded(F.expr(f"left(text, {n - 1})")).alias("head"), coded(F.expr(f"right(text, {n - 1})")).alias("tail"))
    rows = encoder.encode(spread(docs.select(split, "doc_id", "text"), "doc_id"))
    return count_ngrams(rows, n, by, split=split, edges=edges if n > 1 else None)
