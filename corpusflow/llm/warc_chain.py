"""WARC archives: written by Spark's text writer, read back along verified record chains.

Writing: a record is one line of the text sink with two line ends as separator, which is
just how WARC sets records apart, so archives go to any file system Spark writes, with its
commit of whole tasks.  A payload that occurred before becomes a ``revisit`` without body.

Reading: files are cut into chunks, and each task looks for the record magic in its chunk.
The magic may also stand inside payloads, so a find is only a candidate: its own header
says where its successor begins.  Inside a chunk candidates are followed up to where their
chain leaves it.  Over chunks the chains are joined by pointer jumping from the file's
start, doubling the reach each round; only records reached from there are real.  Every
chunk is then read from its entry record on.

Pages: null html is an empty payload.  Rows that repeat the smallest ``page_id`` of a
payload are all responses; a null ``page_id`` is larger than any other and, where it comes
first, is referred to by null.  Null urls give records without target.  Repeated rows give
repeated records.  An empty table gives an empty result, an archive folder without records
likewise.  Headers may have any length: they are read line by line up to their empty line.  A
chain that breaks (a cut file, a length that leads nowhere) ends there: records before the break are
returned, ``chain_ends`` gives its place, and ``read_archive(whole=True)``, which the query
uses on the archive it wrote, makes it an error.  Very long pages are one record, held whole
by the task that reads it.  Columns beside the three that are read may have any names.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.llm.common import sent_whole
from corpusflow.scratch import stored

MAGIC = b"WARC/1.0\r\n"
GAP = b"\r\n\r\n"
CHUNK = 4 << 20
TASK_CHUNKS = 32
#: Bytes by which a task reads on at least.
HEADER = 1 << 16
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
RECORD_ID = "urn:page:"


def payload_digest(payload: bytes) -> str:
    """Bare base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def digests(pages: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest`` of every row of ``pages(page_id, html)``."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [p.as_py() or b"" for p in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(p) for p in payloads], pa.int64()), pa.array([payload_digest(p) for p in payloads], pa.string())],
                ["page_id", "payload_bytes", "payload_digest"],
            )

    rows = pages.select(F.col("page_id").cast("long"), F.col("html").cast("binary"))
    return rows.mapInArrow(work, "page_id long, payload_bytes long, payload_digest string")


def revisits(found: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``page_id, payload_digest, refers_to`` of the rows that repeat another page's payload.

    Firsts come from partial aggregates, so a payload in very many rows is one small group.
    """
    large = found.where(F.col("payload_bytes") >= least_bytes)
    firsts = large.groupBy("payload_digest").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    later = large.join(firsts, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
    return later.select("page_id", "payload_digest", "refers_to").distinct()


def _head(*lines: Column) -> Column:
    return F.concat(F.lit(MAGIC.decode()), *lines)


def _field(name: str, value: Column) -> Column:
    """One header line; none for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_archive(pages: DataFrame, path: str, least_bytes: int = 0) -> None:
    """Write ``pages(page_id, url, html)`` as uncompressed WARC files under ``path``."""
    found = stored(digests(pages), "digests")
    later = stored(revisits(found, least_bytes), "revisits")
    hexes = later.select(F.col("page_id").alias("_id"), F.col("payload_digest").alias("_digest"), "refers_to", F.lit(True).alias("again"))
    digest = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce(F.col("html"), F.lit("")).alias("html"))
    rows = digest.withColumn("_d", _base32(F.unhex(F.sha1(F.col("html").cast("binary")))))
    same = rows.page_id.eqNullSafe(F.col("_id")) & (rows["_d"] == F.col("_digest"))
    rows = rows.join(sent_whole(hexes), same, "left")
    again = F.coalesce("again", F.lit(False))
    size = F.octet_length("html").cast("string")
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), size, F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, F.col("html")))
    name = lambda c: F.concat(F.lit(f"<{RECORD_ID}"), F.coalesce(c.cast("string"), F.lit("null")), F.lit(">"))
    record = _head(
        _field("WARC-Type", F.when(again, "revisit").otherwise("response")),
        _field("WARC-Record-ID", name(F.col("page_id"))),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("_d"))),
        _field("WARC-Refers-To", F.when(again, name(F.col("refers_to")))),
        _field("WARC-Profile", F.when(again, F.lit(PROFILE))),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"),
        block,
    )
    rows.select(record.alias("value")).write.option("lineSep", GAP.decode()).text(path)


def _base32(value: Column) -> Column:
    def encode(values: pd.Series) -> pd.Series:
        return values.map(lambda v: base64.b32encode(bytes(v)).decode())

    return F.pandas_udf(encode, "string")(value)


FIELD = re.compile(rb"[!-9;-~]++[ \t]*+:")
#: What a line of a header may be so far, where the data ends inside it.
OPEN = re.compile(rb"[!-9;-~]*+[ \t]*+\r?")
LENGTH = re.compile(rb"(?i)content-length[ \t]*:[ \t]*([0-9]{1,18})[ \t]*")


class Bytes:
    """Some bytes of a file, more of them when asked."""

    def __init__(self, data: bytes, base: int, whole: int, read: Callable[[int, int], bytes] | None = None):
        self.data, self.base, self.whole, self.read, self.step = bytearray(data), base, whole, read, HEADER

    def grow(self) -> bool:
        """Read on, twice as far each time; False at the end of the file."""
        at = self.base + len(self.data)
        more = self.read(at, min(self.step, self.whole - at)) if self.read and at < self.whole else b""
        self.data += more
        self.step *= 2
        return bool(more)


def _header(held: Bytes, at: int, known: dict[int, tuple[int, bytes | None] | None]) -> tuple[int, bytes | None] | None:
    """Where the empty line of the header at ``data[at]`` begins, and its length field; None if it is no header.

    Lines are read one by one, however many and long.  ``known`` holds what was found from
    any line on, so that headers inside headers are read once.
    """
    pos, lines = at + len(MAGIC), []
    while pos not in known:
        end = held.data.find(b"\r\n", pos)
        if end < 0:
            line = OPEN.fullmatch(held.data, pos) or FIELD.match(held.data, pos)
            if line is None or not held.grow():
                known[pos] = None
        elif end == pos:
            known[pos] = (pos, None)
        elif FIELD.match(held.data, pos, end) is None:
            known[pos] = None
        else:
            lines.append((pos, end))
            pos = end + 2
    found = known[pos]
    for start, end in reversed(lines):
        if found is not None and found[1] is None and (m := LENGTH.fullmatch(held.data, start, end)):
            found = (found[0], bytes(m[1]))
        known[start] = found
    return found


@dataclass
class Record:
    """A record: where it begins, where its block does, and where the next record must."""

    start: int
    block: int
    next: int


def parse_header(held: Bytes, at: int, known: dict) -> Record | None:
    """The record whose magic is at ``data[at]``, if its header is whole and has a length."""
    found = _header(held, at, known)
    if found is None or found[1] is None:
        return None
    block = held.base + found[0] + 2
    return Record(held.base + at, block, block + int(found[1]) + len(GAP))


def header_fields(lines: bytes) -> dict[str, str]:
    fields = {}
    for line in lines.split(b"\r\n"):
        name, _, value = line.partition(b":")
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields


class _Range:
    """Reads of byte ranges of one file, on any file system that Arrow opens."""

    def __init__(self, path: str):
        if "://" not in path and path.startswith("file:"):
            path = "file://" + path.removeprefix("file:")
        system, name = pafs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)

    def read(self, start: int, size: int) -> bytes:
        return self.file.read_at(size, start)


def scan_chunk(data: bytes, base: int, size: int, whole: int, read: Callable[[int, int], bytes] | None = None) -> list[tuple[int, int]]:
    """``(offset, exit)`` of every candidate in the first ``size`` bytes of ``data``.

    ``exit`` is where the candidate's chain leaves the chunk: at a later chunk, at the end of
    the file (``whole``), or -1 where it breaks.  Candidates are taken from the back, so each
    one's successor is settled before it.  ``read`` gives more of the file for headers that
    leave the data.
    """
    held, known, found = Bytes(data, base, whole, read), {}, []
    at = held.data.find(MAGIC, 0, size + len(MAGIC) - 1)
    while 0 <= at < size:
        if (record := parse_header(held, at, known)) is not None:
            found.append((record.start, record.next))
        at = held.data.find(MAGIC, at + 1, size + len(MAGIC) - 1)
    exits: dict[int, int] = {}
    for start, following in reversed(found):
        exits[start] = following if base + size <= following <= whole else exits.get(following, -1)
    return sorted(exits.items())


def _chunks(spark: SparkSession, path: str, chunk: int) -> DataFrame:
    """``path, size, start`` of every chunk of every file; contents are not read."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("size") - 1, F.lit(chunk).cast("long"))).alias("start")
    return files.select("path", "size", starts)


def _dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """The stored rows over tasks of up to about ``TASK_CHUNKS`` chunks each, all cores busy first.

    A row is a few bytes and stands for a chunk of work, which sizes of rows do not show.
    """
    count, cores = rows.count(), rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(max(1, min(count, max(2 * cores, -(-count // TASK_CHUNKS)))), *keys)


def chain_entries(spark: SparkSession, path: str, chunk: int = CHUNK) -> DataFrame:
    """``path, size, entry, exit``: the first real record of every chunk that has one, and where its chain leaves."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                inside = min(chunk, size - start)
                read = _Range(name).read
                found = scan_chunk(read(start, min(inside + len(MAGIC), size - start)), start, inside, size, read)
                if found:
                    rows = len(found)
                    arrays = [[name] * rows, [size] * rows, [a for a, _ in found], [b for _, b in found]]
                    yield pa.RecordBatch.from_arrays([pa.array(a, t) for a, t in zip(arrays, (pa.string(), *[pa.int64()] * 3), strict=True)], ["path", "size", "entry", "exit"])

    chunks = _dealt(stored(_chunks(spark, path, chunk), "chunks"), "path", "start")
    candidates = stored(chunks.mapInArrow(work, "path string, size long, entry long, exit long"), "candidates")
    reached = candidates.where("entry = 0")
    jumps = candidates.select("path", "entry", "exit")
    farther = lambda a, b: a.join(b.select("path", F.col("entry").alias("exit"), F.col("exit").alias("to")), ["path", "exit"], "left")
    known = stored(reached.select("path", "entry", "exit"), "reached")
    while True:
        # all that is reached jumps once more, then every pointer reaches twice as far
        landed = farther(known.select("path", "exit"), jumps).where("to IS NOT NULL").select("path", F.col("exit").alias("entry"), F.col("to").alias("exit"))
        doubled = stored(farther(jumps, jumps).select("path", "entry", F.coalesce("to", "exit").alias("exit"), F.col("to").isNotNull().alias("moved")), "jumps")
        more = stored(known.select("path", "entry", "exit").unionByName(landed).groupBy("path", "entry").agg(F.max("exit").alias("exit")), "reached")
        known = more
        if not doubled.where("moved").head(1):
            break
        jumps = doubled.drop("moved")
        known = stored(known.select("path", "entry").join(jumps, ["path", "entry"]), "reached")
    return known.select("path", "entry").join(candidates, ["path", "entry"]).select("path", "size", "entry", "exit")


def chain_ends(spark: SparkSession, path: str, entries: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``path, size, end``: where the chain of every file that has bytes ends; at its size if nothing is lost."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ends = []
            for name, size, entry in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = 0 if entry is None else entry
                for _, at in chain_records(_Range(name), size, at, at // chunk * chunk + chunk if entry is not None else 0):
                    pass
                ends.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(ends, pa.int64())], ["path", "size", "end"])

    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).where("size > 0")
    last = entries.groupBy("path").agg(F.max("entry").alias("entry"))
    return _dealt(stored(files.join(last, "path", "left"), "files"), "path").mapInArrow(work, "path string, size long, end long")


def read_archive(spark: SparkSession, path: str, chunk: int = CHUNK, whole: bool = False) -> DataFrame:
    """``path, offset, type, record_id, target, refers_to, declared_digest, http_length, payload`` of every real record.

    With ``whole`` a file whose chain breaks before its end is an error; otherwise the
    records before the break are returned, and :func:`chain_ends` tells where it is.
    """
    entries = stored(chain_entries(spark, path, chunk), "entries")
    if whole and (broken := chain_ends(spark, path, entries, chunk).where("end < size").first()):
        raise ValueError(f"the record chain of {broken['path']} breaks at byte {broken['end']} of {broken['size']}")
    schema = "path string, offset long, type string, record_id string, target string, refers_to string, declared_digest string, http_length long, payload binary"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.binary())
        for batch in batches:
            for name, size, entry in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                rows = [(name, *row) for row, _ in chain_records(_Range(name), size, entry, entry // chunk * chunk + chunk)]
                if rows:
                    columns = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in schema.split(", ")])

    return _dealt(entries, "path", "entry").select("path", "size", "entry").mapInArrow(work, schema)


def chain_records(file: _Range, size: int, entry: int, end: int) -> Iterator[tuple[tuple, int]]:
    """Records from ``entry`` on that begin before ``end``, along the chain, each with the place of its successor."""
    at, stop = entry, min(size, end)
    held = Bytes(file.read(at, stop - at) if at < stop else b"", at, size, file.read)
    while at < stop:
        while at - held.base + len(MAGIC) > len(held.data) and held.grow():
            pass
        record = parse_header(held, at - held.base, {}) if held.data.startswith(MAGIC, at - held.base) else None
        if record is None or record.next > size:
            return
        fields = header_fields(bytes(held.data[at - held.base + len(MAGIC) : record.block - held.base - len(GAP)]))
        last = record.next - len(GAP)
        inside = last <= held.base + len(held.data)
        block = bytes(held.data[record.block - held.base : last - held.base]) if inside else file.read(record.block, last - record.block)
        head, gap, body = block.partition(GAP)
        length = re.search(rb"(?im)^content-length:\s*([0-9]+)", head) if gap else None
        kind = fields.get("warc-type")
        row = (
            record.start,
            kind,
            fields.get("warc-record-id"),
            fields.get("warc-target-uri"),
            fields.get("warc-refers-to"),
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            int(length[1]) if length else None,
            None if kind == "revisit" else body,
        )
        at = record.next
        yield row, at


def page_number(name: Column) -> Column:
    """The ``page_id`` in a record id that :func:`write_archive` made."""
    found = F.regexp_extract(name, rf"^<{RECORD_ID}(-?[0-9]+)>$", 1)
    return F.when(found != "", found.cast("long"))


def page_records(records: DataFrame) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to, digest_holds`` of records read back.

    Lengths and digests of responses are taken from the payload; a revisit has those it declares.
    """
    schema = "record_id string, refers string, record_type string, payload_bytes long, payload_digest string, digest_holds boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, refers, kind, declared, length, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                size, digest = (length, declared) if payload is None else (len(payload), payload_digest(payload))
                rows.append((name, refers, kind, size, digest, digest == declared and (length is None or length == size)))
            types = (pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_())
            columns = list(zip(*rows, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [f.split()[0] for f in schema.split(", ")])

    rows = records.select("record_id", "refers_to", "type", "declared_digest", "http_length", "payload").mapInArrow(work, schema)
    return rows.select(
        page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type", page_number(F.col("refers")).alias("refers_to"), "digest_holds"
    )
