"""Training and validation splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from corpusflow.functions.hashing import hash_uniform
from corpusflow.operators.scan import SCAN_BITS, find_position


def split_contiguous(
    df: DataFrame,
    fraction: float = 0.9,
    order: str = "doc_id",
    text: str = "text",
    names: tuple[str, str] = ("train", "val"),
    bits: int = SCAN_BITS,
) -> DataFrame:
    """First ``floor(n * fraction)`` characters of the ordered corpus, and the rest.

    The one document across the cut becomes two rows; an earlier ``split`` is replaced.  Only the place of the cut is
    looked up (sums of lengths, nothing else); the texts themselves are never moved.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must lie between 0 and 1")
    cut = find_position(df, F.length(text), order, fraction=fraction, bits=bits)
    first, second = (F.lit(n) for n in names)
    rest = [c for c in df.columns if c not in (text, "split")]
    whole = F.col(text)
    if cut is None:
        return df.select(first.alias("split"), *rest, text)
    key, offset = cut

    def part(name, value):
        return F.struct(name.alias("split"), value.alias(text))

    if offset == 0:
        side = F.when(F.col(order) < key, first).otherwise(second)
        return df.select(side.alias("split"), *rest, text)
    parts = (
        F.when(F.col(order) < key, F.array(part(first, whole)))
        .when(F.col(order) > key, F.array(part(second, whole)))
        .otherwise(
            F.array(
                part(first, F.substring(whole, 1, offset)),
                part(second, F.substring(whole, F.lit(offset + 1), F.length(whole))),
            )
        )
    )
    return df.select(*rest, F.inline(parts)).select("split", *rest, text)


def split_random(
    df: DataFrame,
    fraction: float = 0.1,
    seed: int = 2357,
    key: str = "doc_id",
    names: tuple[str, str] = ("train", "val"),
) -> DataFrame:
    """Each row to the second split with probability ``fraction``.

    Decided by a hash of key and seed: no shuffle, and the same rows under any
    partitioning.  The share is approximate.
    """
    drawn = hash_uniform(F.lit(seed), F.col(key)) < fraction
    rest = [c for c in df.columns if c != "split"]
    return df.select(F.when(drawn, F.lit(names[1])).otherwise(F.lit(names[0])).alias("split"), *rest)
