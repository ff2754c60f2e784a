"""Encoders as pairs of DataFrame functions."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions import chars, subword


class Encoder(Protocol):
    """Text to ids and back, on DataFrames."""

    size: int

    def encode(self, df: DataFrame, text: str = "text") -> DataFrame: ...

    def decode(self, df: DataFrame, ids: str = "ids") -> DataFrame: ...


def encode_chars(df: DataFrame, vocab: DataFrame | dict[str, int], text: str = "text", oov: str = "error", unk: int | None = None) -> DataFrame:
    """Replace ``text`` by ``ids`` and ``len``; all other columns are kept."""
    return CharEncoder.of(vocab, oov, unk).encode(df, text)


def decode_ids(df: DataFrame, vocab: DataFrame | dict[str, int], ids: str = "ids", text: str = "text") -> DataFrame:
    """Replace ``ids`` by ``text``."""
    known = vocab if isinstance(vocab, dict) else chars.collect_vocab(vocab)
    return df.withColumn(text, chars.decode_column(ids, known)).drop(ids, "len")


@dataclass(frozen=True)
class CharEncoder:
    """One id per character of a vocabulary; no end-of-text id."""

    vocab: dict[str, int]
    oov: str = "error"
    unk: int | None = None

    @classmethod
    def of(cls, vocab: DataFrame | dict[str, int], oov: str = "error", unk: int | None = None) -> CharEncoder:
        return cls(vocab if isinstance(vocab, dict) else chars.collect_vocab(vocab), oov, unk)

    @property
    def size(self) -> int:
        return len(self.vocab)

    def encode(self, df: DataFrame, text: str = "text") -> DataFrame:
        coded = df.withColumn("ids", chars.encode_column(text, self.vocab, self.oov, self.unk))
        # known without encoding unless characters may be dropped
        length = F.size("ids") if self.oov == "drop" else F.length(text)
        return coded.withColumn("len", length).drop(text)

    def decode(self, df: DataFrame, ids: str = "ids") -> DataFrame:
        return decode_ids(df, self.vocab, ids)


@dataclass(frozen=True)
class SubwordEncoder:
    """Byte-pair ids, an end-of-text id after every document unless switched off."""

    ranks: subword.Ranks
    eot: bool = True

    @property
    def size(self) -> int:
        return self.ranks.size

    def encode(self, df: DataFrame, text: str = "text") -> DataFrame:
        return subword.encode_subword(df, self.ranks, text, self.eot)

    def decode(self, df: DataFrame, ids: str = "ids") -> DataFrame:
        return subword.decode_subword(df, self.ranks, ids)


def pick_encoder(vocab: DataFrame | None, ranks: subword.Ranks | None) -> Encoder:
    """The character encoder where a vocabulary exists, else the subword encoder."""
    if vocab is not None:
        return CharEncoder.of(vocab)
    if ranks is None:
        raise ValueError("no vocabulary found: pass the ranks of a subword encoding")
    return SubwordEncoder(ranks)
