"""Character level columns: length, explode, encode, decode."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from corpusflow.functions.lists import list_array, list_parts, row_stretches, text_stretches

# Fixed value: number of Unicode code points, the largest possible character vocabulary.
MAX_CODE_POINTS = 0x110000


def char_len(col: str | Column) -> Column:
    """Length in characters (code points)."""
    return F.length(col)


def explode_chars(df: DataFrame, text: str = "text", keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per character: ``keys…, pos, ch``; an empty text gives no row."""
    rows = df.select(*keys, F.posexplode(F.split(text, "")).alias("pos", "ch"))
    return rows.where(F.col("ch") != "")


def collect_vocab(vocab: DataFrame) -> dict[str, int]:
    """Character to id map on the driver; a vocabulary is bounded by Unicode itself."""
    rows = vocab.select("ch", "id").limit(MAX_CODE_POINTS + 1).toArrow()
    if rows.num_rows > MAX_CODE_POINTS:
        raise ValueError("more rows than there are characters: not a character vocabulary")
    return dict(zip(rows.column("ch").to_pylist(), rows.column("id").to_pylist()))


def encode_column(text: str | Column, vocab: dict[str, int], oov: str = "error", unk: int | None = None) -> Column:
    """Ids of the characters of ``text``.

    ``oov`` decides about characters outside the vocabulary: ``error`` fails the job,
    ``drop`` leaves them out, ``unk`` writes the id ``unk``.
    The look-up is one table access per character, a stretch of texts at a time: beside the
    texts and ids of a batch a worker holds those of one stretch.
    """
    if oov not in ("error", "drop", "unk"):
        raise ValueError(f"unknown oov policy {oov!r}")
    if oov == "unk" and unk is None:
        raise ValueError("oov='unk' needs an id")
    points = np.array([ord(c) for c in vocab], dtype=np.int64)
    table = np.full(int(points.max(initial=0)) + 2, -1, dtype=np.int32)
    table[points] = np.fromiter(vocab.values(), dtype=np.int32, count=len(vocab))

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded, row, size = np.empty(int(lengths.sum()), np.int32), 0, 0
        for part in text_stretches(texts):
            ids, kept = look_up(part, lengths[row : row + len(part)])
            coded[size : size + len(ids)] = ids
            lengths[row : row + len(part)] = kept
            row, size = row + len(part), size + len(ids)
        return list_array(coded[:size], lengths, texts.is_null())

    def look_up(texts: pa.Array, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        points = np.frombuffer("".join(texts.to_pylist()).encode("utf-32-le"), dtype=np.uint32)
        ids = table[np.minimum(points, len(table) - 1)]
        unknown = ids < 0
        if unknown.any():
            if oov == "error":
                seen = sorted({chr(p) for p in points[unknown].tolist()})
                raise KeyError(f"characters outside the vocabulary: {seen[:20]}")
            if oov == "unk":
                ids[unknown] = unk
            else:
                owner = np.repeat(np.arange(len(lengths)), lengths)
                lengths = np.bincount(owner[~unknown], minlength=len(lengths))
                ids = ids[~unknown]
        return ids, lengths

    return encode(text)


def decode_column(ids: str | Column, vocab: dict[str, int]) -> Column:
    """Text of a list of character ids; an unknown id fails the job."""
    numbers = np.fromiter(vocab.values(), dtype=np.int64, count=len(vocab))
    table = np.full(int(numbers.max(initial=0)) + 1, MAX_CODE_POINTS, dtype=np.uint32)
    table[numbers] = [ord(c) for c in vocab]

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
        parts = [spell(lists.slice(low, high - low)) for low, high in row_stretches(sizes)]
        return pa.chunked_array(parts, type=pa.string()).combine_chunks()

    def spell(lists: pa.Array) -> pa.Array:
        values, ends = list_parts(lists)
        if len(values) and (values.min() < 0 or values.max() >= len(table)):
            raise KeyError("id outside the vocabulary")
        text = table[values].tobytes().decode("utf-32-le")
        starts = [0, *ends[:-1].tolist()] if len(ends) else []
        out = [text[a:b] for a, b in zip(starts, ends.tolist())]
        missing = lists.is_null().to_pylist()
        return pa.array([None if m else t for m, t in zip(missing, out)], type=pa.string())

    return decode(ids)
