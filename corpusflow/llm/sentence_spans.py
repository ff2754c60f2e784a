"""Repeated passages, found and removed as runs of consecutive sentences.

A text is cut after sentence marks of Latin and East Asian scripts, with closing quotes and
brackets, and after line ends.  A sentence of more than ``LONG`` words is cut on where a hash of
two neighbouring words says so, after ``LONG`` words at the latest: places that lie in the
passage itself, so that a passage without marks is cut alike wherever it begins.  From each sentence on, and back from each sentence, the
shortest run of ``SENTENCES`` or more sentences with ``WORDS`` or more words is hashed, in
lower case and with single spaces.  A run that occurs before, in another document or
earlier in the same one, is repeated, and all sentences of its non-first occurrences go.
The first occurrence is the one with the smallest ``doc_id``, then text key, then position.

Each task first settles the runs of a piece of its input among themselves and passes on one
row for each run, so that a run in a third of all documents stays small; these rows are
then sorted by hash and passed through once.  Hashes have 96 bits.

Null and empty texts have no sentences and stay as they are.  Repeated rows count as one
document: they all keep or lose the same sentences.  Rows without ``doc_id`` come last
when the first occurrence is chosen.  Texts of fewer sentences than a run stay.  Very long texts
are cut whole, sentence by sentence.  An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import free_names, numbered_columns
from corpusflow.scratch import stored

SENTENCES = 2
WORDS = 20
LONG = 25
PIECE = 100_000
LAST_ID = np.iinfo(np.int64).max
SCHEMA = "h long, check int, doc_id long, text_key long, first int, last int"
#: A mark or line end; the first character is a plain class, which the search skips to quickly.
END = re.compile(r"""[.!?\n\u3002\uff01\uff1f](?:(?<=\n)|(?<=[.!?])[.!?]*["'\u2019\u201d\u00bb)\]]*(?=\s)|(?<=[\u3002\uff01\uff1f])[\u3002\uff01\uff1f]*["'\u2019\u201d\u300d\u300f\uff09]*)\s*""")
#: Letters of scripts that are written without spaces; two of them count as a word.
UNSPACED = re.compile(r"[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff]")
#: A long sentence is cut at one in so many places on average.
CUT_EVERY = 16
WORD = re.compile(r"\S+\s*")


def cut_sentences(text: str) -> list[str]:
    """Pieces of the text that join to it again."""
    pieces, at = [], 0
    for end in [*(m.end() for m in END.finditer(text)), len(text)]:
        if end <= at:
            continue
        piece = text[at:end]
        at = end
        if piece.count(" ") < LONG:
            pieces.append(piece)
            continue
        pieces += _cut_long(piece)
    return pieces


def _cut_long(piece: str) -> list[str]:
    """A long sentence in pieces of ``LONG`` words at most, cut where its words say so."""
    out, begin, count, before = [], 0, 0, 0
    words = piece.lower().encode("utf-8", "surrogatepass").split()
    ends = [m.end() for m in WORD.finditer(piece)]
    hashes = map(crc32, words) if len(words) == len(ends) else (crc32(w.encode("utf-8", "surrogatepass")) for w in piece.lower().split())
    for end, now in zip(ends, hashes, strict=True):
        count += 1
        if count == LONG or (now + 3 * before) // 5 % CUT_EVERY == 0:
            out.append(piece[begin:end])
            begin, count = end, 0
        before = now
    return [*out, piece[begin:]] if begin < len(piece) else out


def sentence_runs(text: str, sentences: int = SENTENCES, words: int = WORDS) -> list[tuple[int, int, int, int]]:
    """``(hash, check, first, last)`` of every run, last included."""
    plain = [" ".join(piece.lower().split()) for piece in cut_sentences(text)]
    sizes = [p.count(" ") + 1 if p else 0 for p in plain]
    if not text.isascii() and UNSPACED.search(text):
        sizes = [n + len(UNSPACED.findall(p)) // 2 for n, p in zip(sizes, plain, strict=True)]
    n, runs = len(plain), set()
    end, total = 0, 0
    for i in range(n):  # forward: runs from i to end - 1
        while end < n and (end - i < sentences or total < words):
            total += sizes[end]
            end += 1
        if end - i >= sentences and total >= words:
            runs.add((i, end - 1))
        total -= sizes[i]
    begin, total = n - 1, 0
    for i in range(n - 1, -1, -1):  # backward: runs from begin + 1 to i
        while begin >= 0 and (i - begin < sentences or total < words):
            total += sizes[begin]
            begin -= 1
        if i - begin >= sentences and total >= words:
            runs.add((begin + 1, i))
        total -= sizes[i]
    out = []
    for first, last in sorted(runs):
        both = xxhash.xxh3_128_intdigest(" ".join(plain[first : last + 1]).encode("utf-8", "surrogatepass"))
        out.append((both & (2**64 - 1), both >> 96, first, last))
    return out


def _marked(columns: list[np.ndarray], before: list | None = None) -> tuple[np.ndarray, np.ndarray, list]:
    """For rows sorted by run and occurrence: which begin a run, which are not of its first occurrence, and the last run's first row.

    ``before`` is the first row of the run that the rows may continue.
    """
    n = len(columns[0])
    new = np.ones(n, bool)
    new[1:] = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
    goes_on = before is not None and before[0] == columns[0][0] and before[1] == columns[1][0]
    new[0] = not goes_on
    start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
    later = np.zeros(n, bool)
    for c, b in zip(columns[2:], before[2:] if goes_on else columns[2:], strict=True):
        later |= c != np.where(start < 0, b if goes_on else c, c[start])
    at = start[-1]
    return new, later, [c[at] for c in columns] if at >= 0 else before


def _batch(columns: list[np.ndarray], later: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array(c) for c in columns]
    arrays[2] = pa.array(columns[2], mask=columns[2] == LAST_ID)
    return pa.RecordBatch.from_arrays([*arrays, pa.array(later)], [f.split()[0] for f in SCHEMA.split(", ")] + ["repeated"])


def _runs_work(sentences: int, words: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def settle() -> Iterator[pa.RecordBatch]:
            if held:
                h, check, doc, key, first, last = (list(c) for c in zip(*held, strict=True))
                columns = [np.array(h, np.uint64).view(np.int64), np.array(check, np.uint32).view(np.int32), np.array(doc, np.int64), np.array(key, np.int64)]
                columns += [np.array(first, np.int32), np.array(last, np.int32)]
                order = np.lexsort(columns[::-1])
                columns = [c[order] for c in columns]
                new, later, _ = _marked(columns)
                stay = new | later
                yield _batch([c[stay] for c in columns], later[stay])
                held.clear()

        for batch in batches:
            for doc, key, text in zip(*batch.columns, strict=True):
                value = text.as_py()
                if value:
                    place = doc.as_py() if doc.is_valid else LAST_ID
                    held += [(h, c, place, key.as_py(), a, b) for h, c, a, b in sentence_runs(value, sentences, words)]
                if len(held) >= PIECE:
                    yield from settle()
        yield from settle()

    return work


def _repeats_work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows, sorted by run and occurrence, that are not of the first occurrence of their run."""
    before = None
    for batch in batches:
        if batch.num_rows:
            columns = [c.fill_null(LAST_ID if k == 2 else 0).to_numpy() for k, c in enumerate(batch.columns)]
            _, later, before = _marked(columns, before)
            yield batch.filter(pa.array(later))


def repeated_runs(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``doc_id, text_key, first, last`` of every repeated run of ``docs(doc_id, text)`` but the first occurrences."""
    rows = docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_key"), "text")
    runs = stored(rows.mapInArrow(_runs_work(sentences, words), SCHEMA + ", repeated boolean"), "runs")
    order = ["h", "check", F.col("doc_id").asc_nulls_last(), "text_key", "first", "last"]
    once = runs.where(~F.col("repeated")).drop("repeated")
    later = once.repartition("h", "check").sortWithinPartitions(*order).mapInArrow(_repeats_work, SCHEMA)
    return runs.where("repeated").drop("repeated").unionByName(later).select("doc_id", "text_key", "first", "last")


def remove_repeated_spans(docs: DataFrame, sentences: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``docs`` with repeated sentences cut from ``text``, and ``n_sentences, n_removed, n_words, n_words_removed``.

    All rows and the other columns stay, whatever their names, but for columns of the four
    names, which are replaced; ``n_chars`` is not recomputed.
    """
    spans = repeated_runs(docs, sentences, words).groupBy("doc_id", "text_key").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    more = ["n_sentences", "n_removed", "n_words", "n_words_removed"]
    docs = docs.drop(*more)
    of_id, of_text, found, key = free_names(docs, "of_id", "of_text", "spans", "text_key")
    spans = spans.select(F.col("doc_id").alias(of_id), F.col("text_key").alias(of_text), F.col("spans").alias(found))
    marked = docs.withColumn(key, F.xxhash64("text"))
    same = marked["doc_id"].cast("long").eqNullSafe(F.col(of_id)) & (marked[key] == F.col(of_text))
    joined = marked.join(spans, same, "left").select(*[f"`{c}`" for c in docs.columns], found)
    at, names = docs.columns.index("text"), [*docs.columns, *more]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields] + [f"{m} long" for m in more])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, numbers = [], []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                pieces = cut_sentences(text or "")
                gone = {k for s in spans or () for k in range(s["first"], s["last"] + 1)}
                sizes = [len(p.split()) for p in pieces]
                texts.append("".join(p for k, p in enumerate(pieces) if k not in gone) if gone else text)
                numbers.append((len(pieces), len(gone), sum(sizes), sum(sizes[k] for k in gone)))
            columns = list(batch.columns[:-1])
            columns[at] = pa.array(texts, pa.string())
            columns += [pa.array([n[k] for n in numbers], pa.int64()) for k in range(4)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return numbered_columns(joined).mapInArrow(work, schema)
