"""The ordered token stream of a split: offsets, shards, fixed-size pages."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.lists import list_array, list_parts
from corpusflow.operators.scan import SCAN_BITS, exclusive_scan
from corpusflow.scratch import stored
from corpusflow.ship import ship_package


def token_offsets(
    df: DataFrame,
    order: str = "doc_id",
    length: str | Column = "len",
    split: str = "split",
    bits: int = SCAN_BITS,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """``(split, order, len, start)``: where each document starts in its split."""
    narrow = df.select(split, order, (F.col(length) if isinstance(length, str) else length).cast("bigint").alias("len"))
    return exclusive_scan(narrow, "len", order, by=[split], out="start", bits=bits, bounds=bounds)


def token_totals(df: DataFrame, length: str | Column = "len", split: str = "split") -> DataFrame:
    """Tokens per split, 64 bit."""
    return df.groupBy(split).agg(F.sum(length).cast("bigint").alias("tokens"))


def contiguous_shards(
    df: DataFrame,
    shards: int = 1024,
    order: str = "doc_id",
    split: str = "split",
    bits: int = SCAN_BITS,
) -> DataFrame:
    """``(split, order, shard)``: runs of documents in order, of nearly equal number.

    The first ``rows % shards`` shards get one row more; with fewer rows than shards the
    last shards stay empty.
    """
    narrow = df.select(split, order)
    numbered = exclusive_scan(narrow, F.lit(1).cast("bigint"), order, by=[split], out="pos", bits=bits)
    totals = narrow.groupBy(split).agg(F.count("*").alias("n"))
    rows = numbered.join(totals, split)
    small, extra = F.expr(f"n div {shards}"), F.col("n") % shards
    wide = extra * (small + 1)
    shard = F.when(F.col("pos") < wide, F.floor(F.col("pos") / (small + 1))).otherwise(
        extra + F.floor((F.col("pos") - wide) / F.greatest(small, F.lit(1)))
    )
    return rows.select(split, order, shard.cast("int").alias("shard"))


def in_order(df: DataFrame, offsets: DataFrame, order: str = "doc_id", split: str = "split") -> DataFrame:
    """Rows of ``df`` with their ``start``, in order of ``(split, order)`` within every task.

    Rows and offsets meet under their key by one range partitioning: each wide row travels
    once.  The ``groupBy`` only pairs the two; it finds its rows placed and needs no exchange.
    """
    rest = [c for c in df.columns if c not in (split, order)]
    wide = df.select(split, order, F.struct(*rest).alias("_row"), F.lit(None).cast("bigint").alias("start"))
    empty = F.lit(None).cast(wide.schema["_row"].dataType)
    starts = offsets.select(split, order, empty.alias("_row"), "start")
    met = wide.unionByName(starts).repartitionByRange(split, order).groupBy(split, order)
    paired = met.agg(F.first("_row", ignorenulls=True).alias("_row"), F.max("start").alias("start"))
    return paired.select(split, order, "_row.*", "start")


class _Cutter:
    """Cuts a stream of ids with known places at page borders."""

    def __init__(self, page_size: int) -> None:
        self.size = page_size
        self.split, self.next, self.held = None, None, np.empty(0, np.int32)
        self.out: list[tuple] = []  # split, first page, place in it (None: whole pages), ids

    def feed(self, split, start: int, ids: np.ndarray) -> None:
        if split != self.split or start != self.next:
            self.flush()
            self.split, self.next = split, start
        data = np.concatenate([self.held, ids]) if len(self.held) else ids
        begin = self.next - len(self.held)
        self.next += len(ids)
        head = -begin % self.size
        if head and len(data) >= head:
            self.out.append((split, begin // self.size, begin % self.size, data[:head]))
            data, begin, head = data[head:], begin + head, 0
        whole = 0 if head else len(data) // self.size * self.size
        if whole:
            self.out.append((split, begin // self.size, None, data[:whole]))
        self.held = data[whole:]

    def flush(self) -> None:
        if len(self.held):
            begin = self.next - len(self.held)
            self.out.append((self.split, begin // self.size, begin % self.size, self.held))
        self.held = self.held[:0]

    def batch(self, kinds: list[pa.DataType]) -> pa.RecordBatch:
        splits, pages, places, sizes = [], [], [], []
        for split, page, place, ids in self.out:
            n = 1 if place is not None else len(ids) // self.size
            splits += [split] * n
            pages += range(page, page + n)
            places += [place] * n
            sizes += [len(ids) // n] * n
        ids = np.concatenate([np.empty(0, np.int32), *[x for *_, x in self.out]])
        self.out = []
        lists = list_array(ids, np.array(sizes, np.int64), pa.array([False] * len(sizes), pa.bool_()))
        return pa.record_batch([pa.array(splits, kinds[0]), pa.array(pages, pa.int64()), pa.array(places, pa.int32()), lists], names=["split", "page", "at", "ids"])


def page_pieces(df: DataFrame, page_size: int, split: str = "split", ids: str = "ids", start: str = "start") -> DataFrame:
    """``(split, page, at, ids)``: whole pages, with null ``at``, and pieces of pages at place ``at``.

    Rows that follow one another in a task are cut as one stream, so that pieces remain only
    where a stretch of the stream begins or ends.  Any order of rows gives right pieces.
    """
    ship_package(df.sparkSession)
    kind = df.schema[split].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter, kinds = _Cutter(page_size), [pa.string()]
        for batch in batches:
            kinds = [batch.column(0).type]
            splits, starts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            values, ends = list_parts(batch.column(2))
            values, low, i = values.astype(np.int32, copy=False), 0, 0
            while i < len(splits):
                # rows that continue each other are one stretch of the flat values
                j, place = i + 1, starts[i] + int(ends[i]) - low
                while j < len(splits) and splits[j] == splits[i] and starts[j] == place:
                    place += int(ends[j] - ends[j - 1])
                    j += 1
                high = int(ends[j - 1])
                if high > low:
                    cutter.feed(splits[i], starts[i], values[low:high])
                low, i = high, j
            yield cutter.batch(kinds)
        cutter.flush()
        yield cutter.batch(kinds)

    return df.select(split, F.col(start).cast("bigint"), ids).mapInArrow(work, f"split {kind}, page bigint, at int, ids array<int>")


def cut_pages(df: DataFrame, page_size: int, split: str = "split", ids: str = "ids", start: str = "start") -> DataFrame:
    """Pages from rows that know their place: ``(split, page, ids)``.

    Tokens are never rows.  Whole pages stay in the task that cut them, in order; only
    pieces are exchanged, a page at most in a group.
    """
    cut = stored(page_pieces(df, page_size, split, ids, start), "pages")
    pieces = cut.where("at IS NOT NULL").groupBy("split", "page").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("pieces"))
    joined = pieces.select("split", "page", F.flatten(F.col("pieces.ids")).alias("ids"))
    return cut.where("at IS NULL").select("split", "page", "ids").unionByName(joined).withColumnRenamed("split", split)


def token_pages(
    df: DataFrame,
    page_size: int = 1024,
    order: str = "doc_id",
    split: str = "split",
    ids: str = "ids",
    length: str | Column = "len",
    bits: int = SCAN_BITS,
    bounds: tuple[int, int] | None = None,
) -> DataFrame:
    """Documents concatenated in order of ``order`` and cut into pages.

    ``length`` must equal the size of ``ids``.  Where it can be had without encoding
    (characters), the offsets never touch the encoder; otherwise store the encoded rows
    first (``scratch.stored``).  The ids travel once.
    """
    offsets = token_offsets(df, order, length, split, bits, bounds)
    placed = in_order(df.select(split, order, ids), offsets, order, split)
    return cut_pages(placed, page_size, split, ids)
