"""Text quality by histogram gradient-boosted trees over document statistics.

Statistics are taken from whole texts where the texts are; only the fixed-length vectors of
at most ``FIT_ROWS`` labelled documents, those with the smallest hashes, reach the driver.
Trees grow level by level on histograms of ``BINS`` quantile bins, with the logistic loss.
A forest is four arrays over complete binary trees, walked for all trees and rows of a batch
at once.

Null and empty texts have all statistics zero and get a score like any other.  Repeated rows
score alike; labels with a null id or class are left out, a document with both labels counts
once for each.  Without training rows every score is 0.5, with one class only nearly that
class.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.scratch import stored

FIT_ROWS = 20_000
TREES = 80
DEPTH = 4
BINS = 64
RATE = 0.15
RIDGE = 1.0
LEAST_CURVATURE = 1.0
THRESHOLD = 0.3

FEATURES = (
    "log_bytes", "log_words", "word_bytes", "word_bytes_spread", "upper", "digits", "sentence_marks", "symbols",
    "other_signs", "beyond_ascii", "lines", "byte_entropy", "distinct_words", "distinct_pairs", "same_as_before",
    "top_word", "distinct_lines", "signed_words", "bare_signs",
)
SYMBOLS = np.frombuffer(b"#*$%&|<>", np.uint8)
MARKS = np.frombuffer(b".!?,", np.uint8)
LETTER_OR_DIGIT = np.array([chr(i).isalnum() and i < 128 or i >= 128 for i in range(256)])


def statistics(text: bytes | None) -> np.ndarray:
    """The statistics of one UTF-8 text, in the order of ``FEATURES``."""
    out = np.zeros(len(FEATURES), np.float32)
    words = (text or b"").split()
    if not words:
        return out
    n, k = len(text), len(words)
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = count[count > 0] / n
    sizes = np.fromiter(map(len, words), np.int32, k)
    bare = np.fromiter((w.isalnum() or max(w) > 127 for w in words), bool, k)
    lines = [line for line in text.split(b"\n") if line.strip()]
    seen: dict[bytes, int] = {}
    for w in words:
        seen[w] = seen.get(w, 0) + 1
    symbols, marks = count[SYMBOLS].sum(), count[MARKS].sum()
    signs = count[~LETTER_OR_DIGIT].sum() - count[[9, 10, 11, 12, 13, 32]].sum() - symbols - marks
    out[:] = (
        np.log(n),
        np.log(k),
        sizes.mean(),
        sizes.std(),
        count[65:91].sum() / n,
        count[48:58].sum() / n,
        marks / k,
        symbols / k,
        signs / k,
        count[128:].sum() / n,
        len(lines) / k,
        -(share * np.log2(share)).sum(),
        np.log(len(seen)) / np.log(k + 1),
        len(set(zip(words, words[1:], strict=False))) / max(k - 1, 1),
        sum(a == b for a, b in zip(words, words[1:], strict=False)) / k,
        max(seen.values()) / k,
        len(set(lines)) / max(len(lines), 1),
        1 - bare.mean(),
        np.mean([not LETTER_OR_DIGIT[np.frombuffer(w, np.uint8)].any() for w in words if len(w) < 4] or [0]),
    )
    return out


@dataclass
class Forest:
    """``feature`` and ``limit`` per tree and inner node, ``value`` per tree and leaf, and the start value."""

    feature: np.ndarray
    limit: np.ndarray
    value: np.ndarray
    start: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1 for every row, all trees walked together."""
        trees = np.arange(len(self.feature))
        node = np.zeros((len(x), len(trees)), np.int64)
        rows = np.arange(len(x))[:, None]
        for _ in range(DEPTH):
            right = x[rows, self.feature[trees, node]] > self.limit[trees, node]
            node = 2 * node + 1 + right
        total = self.start + self.value[trees, node - (2**DEPTH - 1)].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES) -> Forest:
    """Boosted trees of depth ``DEPTH`` for the logistic loss."""
    inner, leaves = 2**DEPTH - 1, 2**DEPTH
    forest = Forest(np.zeros((trees, inner), np.int64), np.full((trees, inner), np.inf, np.float32), np.zeros((trees, leaves)), 0.0)
    if not len(y):
        return forest
    mean = (y.sum() + 0.5) / (len(y) + 1)
    forest.start = float(np.log(mean / (1 - mean)))
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    total = np.full(len(y), forest.start)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        slope, curve = p - y, p * (1 - p)
        node = np.zeros(len(y), np.int64)
        for depth in range(DEPTH):
            first, width = 2**depth - 1, 2**depth
            feature, cut = _splits(binned, slope, curve, node - first, width, cuts)
            forest.feature[t, first : first + width] = feature
            limits = [cuts[f][c] if c >= 0 else np.inf for f, c in zip(feature, cut, strict=True)]
            forest.limit[t, first : first + width] = limits
            right = (binned[np.arange(len(y)), feature[node - first]] > cut[node - first]) & (cut[node - first] >= 0)
            node = 2 * node + 1 + right
        leaf = node - inner
        value = -RATE * np.bincount(leaf, slope, leaves) / (np.bincount(leaf, curve, leaves) + RIDGE)
        forest.value[t] = value
        total += value[leaf]
    return forest


def _splits(binned, slope, curve, node, width, cuts) -> tuple[np.ndarray, np.ndarray]:
    """Best feature and bin for every node of a level; bin -1 where no split helps."""
    best = np.full(width, 1e-6)
    feature, cut = np.zeros(width, np.int64), np.full(width, -1, np.int64)
    for f, limits in enumerate(cuts):
        bins = len(limits) + 1
        place = node * bins + binned[:, f]
        g = np.bincount(place, slope, width * bins).reshape(width, bins).cumsum(axis=1)
        h = np.bincount(place, curve, width * bins).reshape(width, bins).cumsum(axis=1)
        left_g, left_h = g[:, :-1], h[:, :-1]
        right_g, right_h = g[:, -1:] - left_g, h[:, -1:] - left_h
        gain = left_g**2 / (left_h + RIDGE) + right_g**2 / (right_h + RIDGE) - g[:, -1:] ** 2 / (h[:, -1:] + RIDGE)
        gain[(left_h < LEAST_CURVATURE) | (right_h < LEAST_CURVATURE)] = 0
        if not gain.shape[1]:
            continue
        at = gain.argmax(axis=1)
        top = gain[np.arange(width), at]
        better = top > best
        best[better], feature[better], cut[better] = top[better], f, at[better]
    return feature, cut


def _vectors(docs: DataFrame, keep: list[str]) -> DataFrame:
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["x binary"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [statistics(t.as_py()).tobytes() for t in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found, pa.binary())], [*keep, "x"])

    return docs.select(*keep, F.col("text").cast("binary").alias("text")).mapInArrow(work, schema)


def train_quality(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Forest:
    """A forest from ``docs(doc_id, text)`` and ``labels(doc_id, quality)``, all rows of which may be learned from."""
    known = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where("doc_id IS NOT NULL AND quality IN (0, 1)").distinct()
    chosen = stored(known.orderBy(F.xxhash64(F.col("doc_id").cast("string")), "doc_id", "quality").limit(rows), "chosen")
    sample = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id")
    found = _vectors(sample, ["doc_id", "quality"]).orderBy("doc_id", "quality", "x").limit(2 * rows).collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in found), np.float32).reshape(-1, len(FEATURES))
    return fit_forest(x, np.array([r.quality for r in found], np.float64))


def score_quality(docs: DataFrame, forest: Forest, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with ``score`` and ``predicted``."""
    sent = docs.sparkSession.sparkContext.broadcast(forest)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["score double", "predicted int"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([statistics(t.as_py()) for t in batch.column(len(keep))]) if batch.num_rows else np.zeros((0, len(FEATURES)), np.float32)
            score = sent.value.score(x)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))], [*keep, "score", "predicted"]
            )

    return docs.select(*keep, F.col("text").cast("binary").alias("text")).mapInArrow(work, schema)
