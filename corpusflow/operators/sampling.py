"""Repeatable training blocks: drawn from pages, from documents, or straight from token files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.hashing import hash60
from corpusflow.functions.lists import shift_pairs
from corpusflow.operators.pages import token_offsets
from corpusflow.operators.scan import SCAN_BITS
from corpusflow.scratch import stored

# Least tokens of a stretch in which draws and documents look for each other.
STRETCH = 4096


def size_table(df: DataFrame, length: Column | None = None, split: str = "split") -> DataFrame:
    """``(split, n)``: tokens per split of pages, or of rows with a ``length``."""
    size = F.size("ids") if length is None else length
    return df.groupBy(F.col(split).alias("split")).agg(F.sum(size).cast("bigint").alias("n"))


def split_sizes(df: DataFrame, length: Column | None = None, split: str = "split") -> dict[str, int]:
    """The same as a dictionary on the driver; splits are named by hand."""
    return {row["split"]: row["n"] for row in size_table(df, length, split).collect()}


def draw_starts(sizes: DataFrame, iters: int, batch: int, block: int, seed: int) -> DataFrame:
    """``(split, iter, row, start)``: uniform starts in ``[0, n - block)``, with replacement, for ``sizes(split, n)``."""
    if short := sizes.where(F.col("n") <= block).first():
        raise ValueError(f"split {short['split']!r} has {short['n']} tokens, not more than a block of {block}")
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    draws = sizes.select("split", "n", each(iters).alias("iter")).select("*", each(batch).alias("row"))
    start = hash60(F.lit(seed), F.col("split"), F.col("iter"), F.col("row")) % (F.col("n") - block)
    return draws.select("split", "iter", "row", start.alias("start"))


def _blocks(parts: DataFrame, block: int) -> DataFrame:
    """Blocks from ``(split, iter, row, start, piece(at, part))``."""
    pieces = F.array_sort(F.collect_list("piece")).alias("pieces")
    joined = parts.groupBy("split", "iter", "row", "start").agg(pieces).withColumn("ids", F.flatten(F.col("pieces.part")))
    return joined.select("split", "iter", "row", "start", *shift_pairs("ids", block))


def _slice(begin: Column, length: Column, block: int) -> Column:
    """The part of ``ids``, ``length`` tokens from place ``begin`` on, that a draw takes."""
    skip = F.greatest(F.col("start") - begin, F.lit(0))
    stop = F.least(F.col("start") + block + 1 - begin, length.cast("bigint"))
    return F.slice("ids", (skip + 1).cast("int"), (stop - skip).cast("int"))


def sample_blocks(
    pages: DataFrame,
    iters: int,
    batch: int,
    block: int,
    seed: int = 1337,
    page_size: int = 1024,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """``(split, iter, row, start, x, y)``: blocks of ``block`` ids and the same moved by one.

    A draw names the few pages it touches, and an equi-join fetches them; only the slices a draw
    needs are regrouped.  Where the pages are still to be made :func:`sample_documents`
    encodes less, and token files are read at the drawn places by
    :func:`corpusflow.sources.tokenfile.sample_token_files`.
    """
    draws = draw_starts(size_table(pages) if sizes is None else sizes, iters, batch, block, seed)
    touched = F.sequence(F.expr(f"start div {page_size}"), F.expr(f"(start + {block}) div {page_size}"))
    wanted = draws.withColumn("page", F.explode(touched))
    part = _slice(F.col("page") * page_size, F.lit(page_size), block)
    met = wanted.join(pages.select("split", "page", "ids"), ["split", "page"])
    return _blocks(met.select("split", "iter", "row", "start", F.struct(F.col("page").alias("at"), part.alias("part")).alias("piece")), block)


def drawn_documents(draws: DataFrame, offsets: DataFrame, block: int, order: str = "doc_id") -> DataFrame:
    """``(split, order, begin, len, iter, row, start)``: every document that a draw touches, with the draw.

    Both sides are intervals of places.  They meet in stretches of places that both touch,
    and count in the first one of these only.
    """
    width = max(STRETCH, block + 1)
    stretches = lambda first, last: F.sequence(F.expr(f"({first}) div {width}"), F.expr(f"({last}) div {width}"))
    spans = offsets.where("len > 0").select("split", order, F.col("start").alias("begin"), "len")
    spans = spans.select("*", F.explode(stretches("begin", "begin + len - 1")).alias("stretch"))
    asked = draws.select("*", F.explode(stretches("start", f"start + {block}")).alias("stretch"))
    overlap = (F.col("begin") <= F.col("start") + block) & (F.col("begin") + F.col("len") > F.col("start"))
    first = F.col("stretch") == F.expr(f"greatest(begin, start) div {width}")
    return asked.join(spans, ["split", "stretch"]).where(overlap & first).drop("stretch")


def sample_documents(
    docs: DataFrame,
    encode: Callable[[DataFrame], DataFrame],
    iters: int,
    batch: int,
    block: int,
    seed: int = 1337,
    order: str = "doc_id",
    split: str = "split",
    text: str = "text",
    length: str | Column | None = None,
    bits: int = SCAN_BITS,
) -> DataFrame:
    """The blocks of :func:`sample_blocks` without pages: only documents that a draw touches are encoded.

    ``length`` is the number of ids of a document as far as it is known without encoding;
    by default its characters.
    """
    known = F.length(text) if length is None else length
    offsets = stored(token_offsets(docs, order, known, split, bits).withColumnRenamed(split, "split"), "offsets")
    draws = draw_starts(size_table(offsets, F.col("len")), iters, batch, block, seed)
    hits = stored(drawn_documents(draws, offsets, block, order), "drawn")
    named = docs.select(F.col(split).alias("split"), order, text).join(hits.select("split", order).distinct(), ["split", order], "left_semi")
    met = hits.join(encode(named).select("split", order, "ids"), ["split", order])
    part = _slice(F.col("begin"), F.col("len"), block)
    return _blocks(met.select("split", "iter", "row", "start", F.struct(F.col("begin").alias("at"), part.alias("part")).alias("piece")), block)
