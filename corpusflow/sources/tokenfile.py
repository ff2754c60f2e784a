"""Flat 16-bit token files as a Spark data source, both ways.

Reading turns byte ranges into partitions, so one large file is read by many tasks.
Writing has two layouts:

``parts``
    Every task writes its own files ``split=…/part-….bin``; ``manifest.json``, written
    last, lists the committed files in order.  Their bytes in that order are the flat
    file.  Works on any file system pyarrow knows.
``single``
    Every task writes its stretch of pages at its place in ``{split}.bin`` itself.  A
    repeated task writes the same bytes again.  Needs a POSIX folder that all executors
    share.
"""

from __future__ import annotations

import json
import os
import posixpath
import uuid
from bisect import bisect_right
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from pathlib import PurePosixPath

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
    WriterCommitMessage,
)

from corpusflow.functions.lists import list_parts
from corpusflow.scratch import qualified
from corpusflow.ship import ship_package

# Fixed values of the format: unsigned 16-bit ids, little endian, no header.
ID_TYPE = np.dtype("<u2")
MAX_ID = 65535

SCHEMA = "split string, page bigint, ids array<int>"
MANIFEST = "manifest.json"
# Pages handed to Spark at a time, and tokens read by one task.
BATCH_PAGES = 1024
TASK_TOKENS = 16 * 1024 * 1024
# Stretches far apart that one task reads at most: each costs a seek.
TASK_RUNS = 64
# Pages of one written file, by default 128 MiB.
FILE_PAGES = 65536


def _filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path.removeprefix("file:")
    if "://" in path:
        # Arrow knows the store by the name without the letter of Hadoop's driver
        return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1) if path.startswith("s3a://") else path)
    return pafs.LocalFileSystem(), os.path.abspath(path)


@dataclass(frozen=True)
class Extent:
    """``count`` tokens of a split from position ``start`` on, held by ``file``."""

    split: str
    file: str
    start: int
    count: int


def _extents(path: str) -> list[Extent]:
    fs, root = _filesystem(path)
    manifest = posixpath.join(root, MANIFEST)
    if fs.get_file_info(manifest).type == pafs.FileType.File:
        with fs.open_input_stream(manifest) as stream:
            listed = json.loads(stream.read())["files"]
        return [Extent(f["split"], posixpath.join(root, f["file"]), f["start"], f["count"]) for f in listed]
    found: dict[str, Extent] = {}
    for info in fs.get_file_info(pafs.FileSelector(root, recursive=True)):
        name = PurePosixPath(info.path)
        if info.type != pafs.FileType.File or name.suffix != ".bin":
            continue
        if name.stem in found:
            raise ValueError(f"two token files for split {name.stem!r}: {found[name.stem].file} and {info.path}")
        if info.size % ID_TYPE.itemsize:
            raise ValueError(f"{info.path} does not hold whole 16-bit ids")
        found[name.stem] = Extent(name.stem, info.path, 0, info.size // ID_TYPE.itemsize)
    if not found:
        raise FileNotFoundError(f"no token files under {path}")
    return [found[k] for k in sorted(found)]


@dataclass(frozen=True)
class PageRun:
    """Consecutive pages of one split, and the file pieces that hold them."""

    split: str
    first_page: int
    pieces: list[tuple[str, int, int]]  # file, first token, tokens


class TokenRange(InputPartition):
    """What one task reads."""

    def __init__(self, runs: list[PageRun]) -> None:
        self.runs = runs


class TokenFileReader(DataSourceReader):
    def __init__(self, path: str, page_size: int, task_tokens: int) -> None:
        self.path, self.page_size = path, page_size
        self.task_tokens = max(task_tokens // page_size, 1) * page_size
        self.kept: dict[str, set | None] = {"split": None, "page": None}
        self.low, self.high = 0, None  # pages from low on, below high

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for f in filters:
            if isinstance(f, (EqualTo, In)) and len(f.attribute) == 1 and f.attribute[0] in self.kept:
                name, values = f.attribute[0], {f.value} if isinstance(f, EqualTo) else set(f.value)
                before = self.kept[name]
                self.kept[name] = values if before is None else before & values
            else:
                if getattr(f, "attribute", None) == ("page",) and isinstance(getattr(f, "value", None), int):
                    self._bound(f)
                yield f  # Spark filters the pages of the outermost stretches itself

    def _bound(self, f: Filter) -> None:
        if isinstance(f, (GreaterThan, GreaterThanOrEqual)):
            self.low = max(self.low, f.value + isinstance(f, GreaterThan))
        elif isinstance(f, (LessThan, LessThanOrEqual)):
            end = f.value + isinstance(f, LessThanOrEqual)
            self.high = end if self.high is None else min(self.high, end)

    def _stretches(self, tokens: int) -> Iterator[tuple[int, int]]:
        """Token ranges of a split for one task each: everything, or the wanted pages."""
        if self.kept["page"] is None:
            last = tokens if self.high is None else min(tokens, max(self.high, 0) * self.page_size)
            for low in range(self.low * self.page_size, last, self.task_tokens):
                yield low, min(low + self.task_tokens, last)
            return
        wanted = sorted(p for p in self.kept["page"] if p is not None and 0 <= p * self.page_size < tokens)
        for i, page in enumerate(wanted):
            if i == 0 or page != wanted[i - 1] + 1 or (page - first) * self.page_size >= self.task_tokens:
                first = page
            if i + 1 == len(wanted) or wanted[i + 1] != page + 1 or (page + 1 - first) * self.page_size >= self.task_tokens:
                yield first * self.page_size, min((page + 1) * self.page_size, tokens)

    def partitions(self) -> Sequence[InputPartition]:
        by_split: dict[str, list[Extent]] = {}
        for extent in _extents(self.path):
            if self.kept["split"] is None or extent.split in self.kept["split"]:
                by_split.setdefault(extent.split, []).append(extent)
        runs: list[PageRun] = []
        for split, extents in by_split.items():
            extents.sort(key=lambda e: e.start)
            nearest = 0
            for low, high in self._stretches(extents[-1].start + extents[-1].count):
                while extents[nearest].start + extents[nearest].count <= low:
                    nearest += 1
                pieces, i = [], nearest
                while i < len(extents) and extents[i].start < high:
                    e = extents[i]
                    first, last = max(low, e.start), min(high, e.start + e.count)
                    if last > first:
                        pieces.append((e.file, first - e.start, last - first))
                    i += 1
                runs.append(PageRun(split, low // self.page_size, pieces))
        return self._tasks(runs)

    def _tasks(self, runs: list[PageRun]) -> list[InputPartition]:
        """Single pages far apart share a task, up to the size of a task and so many seeks."""
        tasks: list[InputPartition] = []
        held, size = [], 0
        for run in runs:
            tokens = sum(count for _, _, count in run.pieces)
            if held and (size + tokens > self.task_tokens or len(held) == TASK_RUNS):
                tasks.append(TokenRange(held))
                held, size = [], 0
            held.append(run)
            size += tokens
        if held:
            tasks.append(TokenRange(held))
        return tasks

    def read(self, partition: TokenRange) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(self.path)
        step = BATCH_PAGES * self.page_size
        for run in partition.runs:
            page, held = run.first_page, np.empty(0, dtype=ID_TYPE)
            for file, first, count in run.pieces:
                with fs.open_input_file(file) as source:
                    for at in range(first, first + count, step):
                        take = min(step, first + count - at)
                        raw = source.read_at(take * ID_TYPE.itemsize, at * ID_TYPE.itemsize)
                        held = np.concatenate([held, np.frombuffer(raw, dtype=ID_TYPE)])
                        whole = len(held) // self.page_size * self.page_size
                        if whole:
                            yield self._batch(run.split, page, held[:whole])
                            page += whole // self.page_size
                            held = held[whole:]
            if len(held):
                yield self._batch(run.split, page, held)

    def _batch(self, split: str, page: int, ids: np.ndarray) -> pa.RecordBatch:
        ends = np.append(np.arange(0, len(ids), self.page_size), len(ids)).astype(np.int32)
        n = len(ends) - 1
        return pa.record_batch(
            {
                "split": pa.array([split] * n, type=pa.string()),
                "page": pa.array(np.arange(page, page + n), type=pa.int64()),
                "ids": pa.ListArray.from_arrays(pa.array(ends), pa.array(ids.astype(np.int32))),
            }
        )


@dataclass
class WrittenFiles(WriterCommitMessage):
    """What one task wrote: ``(split, file, first page, pages, tokens)`` each."""

    files: list[tuple[str, str, int, int, int]]


def _page_runs(batches: Iterator[pa.RecordBatch], page_size: int) -> Iterator[tuple[str, int, int, np.ndarray]]:
    """Stretches of consecutive full pages as ``(split, first page, pages, ids)``, after the range check."""
    for batch in batches:
        splits = batch.column(batch.schema.get_field_index("split")).to_pylist()
        pages = batch.column(batch.schema.get_field_index("page")).to_pylist()
        values, ends = list_parts(batch.column(batch.schema.get_field_index("ids")))
        if len(values) and (values.min() < 0 or values.max() > MAX_ID):
            raise ValueError(f"id outside 0..{MAX_ID} does not fit a 16-bit token file")
        ids, begin, at = values.astype(ID_TYPE), 0, 0
        for i, end in enumerate(ends.tolist()):
            last = i + 1 == len(pages)
            full = end - (ends[i - 1] if i else 0) == page_size
            if last or not full or splits[i + 1] != splits[i] or pages[i + 1] != pages[i] + 1:
                yield splits[i], pages[begin], i + 1 - begin, ids[at:end]
                begin, at = i + 1, end


class PartsWriter(DataSourceArrowWriter):
    """Layout ``parts``: pages arrive ordered by split and page within a task."""

    def __init__(self, path: str, page_size: int, overwrite: bool) -> None:
        self.path, self.page_size, self.overwrite = path, page_size, overwrite
        self.job = uuid.uuid4().hex[:12]

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        fs, root = _filesystem(self.path)
        attempt = uuid.uuid4().hex[:12]
        done: list[tuple[str, str, int, int, int]] = []
        out, split, first, expected, tokens = None, "", 0, -1, 0
        try:
            for name, page, pages, ids in _page_runs(iterator, self.page_size):
                if out is None or name != split or page != expected:
                    if out is not None:
                        out.close()
                        done.append((split, file, first, expected - first, tokens))
                    split, first, tokens = name, page, 0
                    file = f"split={name}/part-{page:012d}-{self.job}-{attempt}.bin"
                    fs.create_dir(posixpath.join(root, f"split={name}"), recursive=True)
                    out = fs.open_output_stream(posixpath.join(root, file))
                out.write(ids.tobytes())
                tokens += len(ids)
                expected = page + pages
        finally:
            if out is not None:
                out.close()
        if out is not None:
            done.append((split, file, first, expected - first, tokens))
        return WrittenFiles(done)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        fs, root = _filesystem(self.path)
        written = sorted(f for m in messages if m is not None for f in m.files)
        written.sort(key=lambda f: (f[0], f[2]))
        listed, place = [], {}
        for split, file, first, pages, tokens in written:
            start = place.get(split, 0)
            if start != first * self.page_size:
                raise ValueError(f"split {split!r}: pages before {first} are missing, repeated or not full")
            size = fs.get_file_info(posixpath.join(root, file)).size
            if size != tokens * ID_TYPE.itemsize:
                raise ValueError(f"{file} holds {size} bytes, not the {tokens} ids its task wrote")
            listed.append({"split": split, "file": file, "start": start, "count": tokens})
            place[split] = start + tokens
        manifest = posixpath.join(root, MANIFEST)
        old = []
        if fs.get_file_info(manifest).type == pafs.FileType.File:
            with fs.open_input_stream(manifest) as stream:
                old = json.loads(stream.read())["files"]
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{manifest}.{self.job}") as stream:
            stream.write(json.dumps({"page_size": self.page_size, "totals": place, "files": listed}).encode())
        fs.move(f"{manifest}.{self.job}", manifest)
        for entry in old:
            fs.delete_file(posixpath.join(root, entry["file"]))
        # attempts that were repeated have left files that no message names
        self._remove({entry["file"] for entry in listed})

    def _remove(self, kept: set[str]) -> None:
        """Delete this job's files but those kept."""
        fs, root = _filesystem(self.path)
        for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True, recursive=True)):
            if info.type == pafs.FileType.File and f"-{self.job}-" in info.base_name and posixpath.relpath(info.path, root) not in kept:
                fs.delete_file(info.path)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        # failed tasks send no message, so the job's number in the name finds their files
        self._remove(set())


class SingleWriter(DataSourceArrowWriter):
    """Layout ``single``: pages go straight to their places in ``{split}.bin``."""

    def __init__(self, path: str, page_size: int) -> None:
        self.root, self.page_size = _local_root(path), page_size
        self.job = uuid.uuid4().hex[:12]

    def _unfinished(self, split: str) -> str:
        return os.path.join(self.root, f".{split}.{self.job}.tmp")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        os.makedirs(self.root, exist_ok=True)
        handles: dict[str, int] = {}
        totals: dict[str, list[int]] = {}
        try:
            for split, page, pages, ids in _page_runs(iterator, self.page_size):
                if split not in handles:
                    handles[split] = os.open(self._unfinished(split), os.O_CREAT | os.O_WRONLY, 0o644)
                    totals[split] = [0, 0]
                view, at = memoryview(ids.tobytes()), page * self.page_size * ID_TYPE.itemsize
                while view:
                    n = os.pwrite(handles[split], view, at)
                    view, at = view[n:], at + n
                totals[split][0] += pages
                totals[split][1] += len(ids)
        finally:
            for handle in handles.values():
                os.fsync(handle)
                os.close(handle)
        return WrittenFiles([(s, self._unfinished(s), 0, pages, tokens) for s, (pages, tokens) in totals.items()])

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        totals: dict[str, int] = {}
        for message in messages:
            for split, _, _, _, tokens in message.files if message is not None else []:
                totals[split] = totals.get(split, 0) + tokens
        for split, tokens in totals.items():
            if os.path.getsize(self._unfinished(split)) != tokens * ID_TYPE.itemsize:
                raise ValueError(f"split {split!r}: pages are missing, repeated or not full")
        for split in totals:
            os.replace(self._unfinished(split), os.path.join(self.root, f"{split}.bin"))

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        for entry in os.scandir(self.root) if os.path.isdir(self.root) else ():
            if entry.name.endswith(f".{self.job}.tmp"):
                os.remove(entry.path)


def _local_root(path: str) -> str:
    fs, root = _filesystem(path)
    if not isinstance(fs, pafs.LocalFileSystem):
        raise ValueError("layout 'single' needs a POSIX path; use layout 'parts'")
    return root


class TokenFiles(DataSource):
    """``spark.read.format("tokenfiles")``."""

    @classmethod
    def name(cls) -> str:
        return "tokenfiles"

    def schema(self) -> str:
        return SCHEMA

    def _page_size(self) -> int:
        return int(self.options.get("page_size", 1024))

    def reader(self, schema) -> DataSourceReader:
        return TokenFileReader(self.options["path"], self._page_size(), int(self.options.get("task_tokens", TASK_TOKENS)))

    def writer(self, schema, overwrite: bool) -> DataSourceArrowWriter:
        path = self.options["path"]
        if self.options.get("layout", "parts") == "single":
            return SingleWriter(path, self._page_size())
        fs, root = _filesystem(path)
        if not overwrite and fs.get_file_info(posixpath.join(root, MANIFEST)).type == pafs.FileType.File:
            raise FileExistsError(f"{path} already holds token files")
        return PartsWriter(path, self._page_size(), overwrite)


def read_token_files(spark: SparkSession, path: str, page_size: int = 1024, task_tokens: int = TASK_TOKENS) -> DataFrame:
    """``(split, page, ids)`` from a folder of token files.

    A filter on ``split`` skips the other files, one on ``page`` (``=``, ``isin`` or a range)
    reads these pages only.
    """
    spark.dataSource.register(TokenFiles)
    # filters reach Python sources only where the session allows it
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    reader = spark.read.format("tokenfiles").option("page_size", page_size).option("task_tokens", task_tokens)
    return reader.load(qualified(spark, path))


def sample_token_files(spark: SparkSession, path: str, iters: int, batch: int, block: int, seed: int = 1337, tasks: int | None = None) -> DataFrame:
    """``(split, iter, row, start, x, y)``: the blocks of ``sample_blocks``, read at the drawn places of token files.

    The draws are dealt to tasks in order of place, each reads ``block + 1`` ids: no page is
    read whole and nothing is exchanged but the draws.  The list of files comes from the
    manifest or the folder, one short entry each.
    """
    from corpusflow.operators.sampling import draw_starts

    ship_package(spark)
    path = qualified(spark, path)
    extents = sorted(_extents(path), key=lambda e: (e.split, e.start))
    totals = {e.split: e.start + e.count for e in extents}
    sizes = spark.createDataFrame(sorted(totals.items()), "split string, n bigint")
    draws = draw_starts(sizes, iters, batch, block, seed)
    draws = draws.repartitionByRange(tasks or 2 * spark.sparkContext.defaultParallelism, "split", "start").sortWithinPartitions("split", "start")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = _filesystem(path)
        places = {split: [e for e in extents if e.split == split] for split in totals}
        starts = {split: [e.start for e in held] for split, held in places.items()}
        name, file = None, None
        for part in batches:
            ids = np.empty((part.num_rows, block + 1), ID_TYPE)
            for i, (split, start) in enumerate(zip(part.column(0).to_pylist(), part.column(3).to_pylist(), strict=True)):
                at, k = 0, bisect_right(starts[split], start) - 1
                while at <= block:
                    e = places[split][k]
                    if e.file != name:
                        name, file = e.file, fs.open_input_file(e.file)
                    take = min(block + 1 - at, e.start + e.count - start - at)
                    raw = file.read_at(take * ID_TYPE.itemsize, (start + at - e.start) * ID_TYPE.itemsize)
                    ids[i, at : at + take] = np.frombuffer(raw, ID_TYPE)
                    at, k = at + take, k + 1
            ends = pa.array(np.arange(0, (part.num_rows + 1) * block, block, dtype=np.int32))
            lists = [pa.ListArray.from_arrays(ends, pa.array(ids[:, cut].reshape(-1).astype(np.int32))) for cut in (slice(0, block), slice(1, block + 1))]
            yield pa.record_batch([*part.columns, *lists], names=["split", "iter", "row", "start", "x", "y"])

    return draws.mapInArrow(work, "split string, iter int, row int, start bigint, x array<int>, y array<int>")


def pages_per_file(tokens: int, page_size: int, tasks: int) -> int:
    """Consecutive pages for one task, so that small stores still use ``tasks`` tasks."""
    return max(1, min(FILE_PAGES, -(-tokens // page_size // tasks)))


def write_token_files(
    pages: DataFrame,
    path: str,
    page_size: int = 1024,
    layout: str = "parts",
    mode: str = "append",
    file_pages: int = FILE_PAGES,
    in_stretches: bool = False,
) -> None:
    """Write ``(split, page, ids)`` as flat token files; see the module for the layouts.

    A task writes stretches of ``file_pages`` consecutive pages.  They are brought together
    by their number, without the sampling pass that a range partitioning needs.  Pages that
    lie in order already, as :func:`cut_pages` leaves them, are written ``in_stretches`` where
    they are; a stretch becomes a file.
    """
    if layout not in ("parts", "single"):
        raise ValueError(f"unknown layout {layout!r}")
    spark = pages.sparkSession
    spark.dataSource.register(TokenFiles)
    rows = pages.select("split", "page", F.col("ids").cast("array<int>").alias("ids"))
    if not in_stretches:
        rows = rows.repartition("split", F.expr(f"page div {file_pages}")).sortWithinPartitions("split", "page")
    writer = rows.write.format("tokenfiles").mode(mode)
    writer.option("page_size", page_size).option("layout", layout).save(qualified(spark, path))
