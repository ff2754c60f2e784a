"""Runs of repeated words: maximal stretches that repeat with a period, found by minimizers.

A run is a stretch of consecutive words in which words ``period`` apart are identical, at
least two periods long, that no neighbouring word extends; ``period`` is its smallest.

Periods below ``DIRECT`` are found by comparing the text with itself at every such lag.
Longer ones are found scale by scale, a scale being the periods from ``P`` to ``2 * P - 1``:

* A window covers ``P / 4`` overlapping stretches of ``P / 2`` words and selects the one with
  the least hash, the leftmost of equal ones.  Windows inside a run come back one period
  later with the same selection, so a place where the selection changes does so as well.  A
  run has such a place in its first period: places with equal windows, ``P`` to ``2 * P - 1``
  words apart, seed a run of their distance.
* Where the window itself has a short period, its places would pair with very many others.
  Such windows lie inside runs that smaller scales have found; they seed nothing, the border
  of such a stretch does.  Windows that are left repeat at distances of a third of ``P`` or
  more, so a place has a few partners at most, whatever the text.
* A run of which a whole period lies in a run of a shorter period has no such place.  It
  stretches over two neighbouring runs of that shorter period, and its period is fixed by
  them up to multiples: these are seeds too.

Every seed is extended both ways by comparing hashes of prefixes, by bisection, and what is
at least two periods long is compared word by word before it counts.  Texts of one Arrow
batch are worked on together, each ended by a word of its own, in stretches of about
``TOGETHER`` words; the work is near ``n log n`` in the number of words for any text.

Null and empty texts have no words and no runs.  Very long texts are treated whole, in
memory of some hundred bytes a word in the one task that holds the row.  Rows are judged one
by one: repeated rows and ids make no difference, an empty table gives no rows.  Columns
beside those named are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LEAST = 12
DIRECT = 16
TOGETHER = 200_000

#: Two primes below 2**31 and bases for the hashes of stretches.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525_011)

Runs = np.ndarray  # rows of (start, end, period)


class Stretches:
    """Hashes of all stretches of a word sequence, from hashes of its prefixes."""

    def __init__(self, words: np.ndarray):
        self.words, n = words, len(words)
        self.powers, self.sums = [], []
        for prime, base in zip(PRIMES, BASES, strict=True):
            p, b = np.uint64(prime), np.uint64(base)
            power = np.ones(n + 1, np.uint64)
            filled, step = 1, b
            while filled <= n:
                take = min(filled, n + 1 - filled)
                power[filled : filled + take] = power[:take] * step % p
                step, filled = step * step % p, filled + take
            value = (words.astype(np.uint64) * np.uint64(2_654_435_761) + np.uint64(97)) % p
            # a sum of 2**33 values below 2**31 still fits
            total = np.concatenate(([np.uint64(0)], np.cumsum(value * power[:n] % p) % p))
            self.powers.append(power)
            self.sums.append(total)

    def of(self, size: int) -> np.ndarray:
        """Hash of every stretch of ``size`` words, equal for equal stretches wherever they lie."""
        n = len(self.words)
        out = None
        for prime, power, total in zip(PRIMES, self.powers, self.sums, strict=True):
            p = np.uint64(prime)
            part = (total[size:] + p - total[: n + 1 - size]) % p * power[n - size :: -1][: n + 1 - size] % p
            out = part if out is None else out << np.uint64(31) | part
        return out

    def same(self, a: np.ndarray, b: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether the stretches of ``size`` words at ``a`` and at ``b > a`` are equal."""
        good = np.ones(len(a), bool)
        for prime, power, total in zip(PRIMES, self.powers, self.sums, strict=True):
            p = np.uint64(prime)
            left = (total[a + size] + p - total[a]) % p * power[b - a] % p
            good &= left == (total[b + size] + p - total[b]) % p
        return good

    def extended(self, at: np.ndarray, lag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The largest ``[low, high)`` around ``at`` in which words ``lag`` apart are equal."""
        n = len(self.words)
        forward, backward = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        for bit in range(max(1, n).bit_length(), -1, -1):
            step = np.int64(1 << bit)
            more = forward + step
            inside = np.flatnonzero(at + lag + more <= n)
            fits = inside[self.same(at[inside], at[inside] + lag[inside], more[inside])]
            forward[fits] = more[fits]
            more = backward + step
            inside = np.flatnonzero(at - more >= 0)
            fits = inside[self.same(at[inside] - more[inside], at[inside] - more[inside] + lag[inside], more[inside])]
            backward[fits] = more[fits]
        return at - backward, at + forward


def _stretches(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges[::2].astype(np.int64), edges[1::2].astype(np.int64)


def _direct(words: np.ndarray, lag: int) -> Runs:
    """Stretches of at least two periods at one lag."""
    low, high = _stretches(words[lag:] == words[:-lag]) if lag < len(words) else (np.zeros(0, np.int64),) * 2
    keep = high - low >= lag
    return np.stack([low[keep], high[keep] + lag, np.full(keep.sum(), lag)], axis=1)


def _least(words: np.ndarray, width: int) -> np.ndarray:
    """Place of the least value in every window of ``width``, the leftmost of equal ones."""
    values = (words >> np.uint64(31)) << np.uint64(32) | np.arange(len(words), dtype=np.uint64)
    done = 1
    while done < width:
        step = min(done, width - done)
        values = np.minimum(values[: len(values) - step], values[step:])
        done += step
    return (values & np.uint64(0xFFFFFFFF)).astype(np.int64)


def _periodic(n: int, runs: Runs, size: int) -> np.ndarray:
    """For every window of ``size`` words, whether it lies in a run of at most half its size."""
    inside = runs[(runs[:, 2] <= size // 2) & (runs[:, 1] - runs[:, 0] >= size)]
    marks = np.zeros(n - size + 2, np.int32)
    np.add.at(marks, inside[:, 0], 1)
    np.add.at(marks, inside[:, 1] - size + 1, -1)
    return np.cumsum(marks[:-1]) > 0


def _minimizer_seeds(hashes: Stretches, runs: Runs, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` of equal windows ``scale`` to ``2 * scale - 1`` words apart, at places where the selection changes."""
    width, short = scale // 4, scale // 2
    size = width + short - 1
    n = len(hashes.words)
    selected = _least(hashes.of(short), width)
    periodic = _periodic(n, runs, size)
    changes = np.concatenate(([True], selected[1:] != selected[:-1]))
    border = np.zeros(len(periodic), bool)
    border[1:] |= periodic[:-1]
    border[:-1] |= periodic[1:]
    places = np.flatnonzero(~periodic & (changes | border)).astype(np.int64)
    keys = hashes.of(size)[places]
    order = np.lexsort((places, keys))
    places, keys = places[order], keys[order]
    found, apart = [], 1
    while apart < len(places):
        lag = places[apart:] - places[:-apart]
        near = (keys[apart:] == keys[:-apart]) & (lag < 2 * scale)
        if not near.any():
            break
        good = near & (lag >= scale)
        found.append((places[:-apart][good], lag[good]))
        apart += 1
    return tuple(np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64),) * 2


def _neighbour_seeds(words: np.ndarray, runs: Runs, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """``(place, lag)`` of lags that carry a run of a short period into a neighbouring one of the same."""
    half = (scale // 4 + scale // 2 - 1) // 2
    short = runs[(runs[:, 2] <= half) & (runs[:, 1] - runs[:, 0] >= scale - 2)]
    short = short[np.lexsort((short[:, 0], short[:, 2]))]
    places, lags = [], []
    for apart in (1, 2):
        first, second = short[:-apart], short[apart:]
        close = (first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 1] + 2)
        for (s1, _, q), (s2, _, _) in zip(first[close], second[close], strict=True):
            turned = np.lib.stride_tricks.sliding_window_view(words[s1 : s1 + 2 * q - 1], q)
            match = np.flatnonzero((turned == words[s2 : s2 + q]).all(axis=1))
            if len(match):
                rest = (s2 - s1 - match[0]) % q
                lag = np.arange(scale + (rest - scale) % q, 2 * scale, q, dtype=np.int64)
                places.append(np.maximum(s1, s2 - lag))
                lags.append(lag)
    return (np.concatenate(places), np.concatenate(lags)) if places else (np.zeros(0, np.int64),) * 2


def _smallest(runs: Runs) -> Runs:
    """One row for each stretch, with its smallest period."""
    runs = runs[np.lexsort((runs[:, 2], runs[:, 1], runs[:, 0]))]
    first = np.ones(len(runs), bool)
    first[1:] = (runs[1:, :2] != runs[:-1, :2]).any(axis=1)
    return runs[first]


def maximal_runs(words: np.ndarray, longest: int | None = None) -> Runs:
    """``(start, end, period)`` of every maximal run of two periods or more, by start and period.

    ``longest`` bounds the periods: half the longest text where several lie side by side.
    """
    n = len(words)
    longest = n // 2 if longest is None else min(longest, n // 2)
    runs = _smallest(np.concatenate([np.zeros((0, 3), np.int64), *[_direct(words, lag) for lag in range(1, min(DIRECT - 1, longest) + 1)]]))
    hashes, scale = None, DIRECT
    while scale <= longest:
        hashes = hashes or Stretches(words)
        seeds = [_minimizer_seeds(hashes, runs, scale), _neighbour_seeds(words, runs, scale)]
        at, lag = (np.concatenate(x) for x in zip(*seeds, strict=True))
        inside = at + lag < n
        at, lag = at[inside], lag[inside]
        low, high = hashes.extended(at, lag)
        found = np.unique(np.stack([low, high + lag, lag], axis=1)[high - low >= lag], axis=0)
        exact = [r for r in found if np.array_equal(words[r[0] : r[1] - r[2]], words[r[0] + r[2] : r[1]])]
        runs = _smallest(np.concatenate([runs, np.array(exact, np.int64).reshape(-1, 3)]))
        scale *= 2
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _texts_together(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    """The texts in stretches of about ``TOGETHER`` words, a long text by itself."""
    held, total = [], 0
    for words in texts:
        if held and total + len(words) > TOGETHER:
            yield held
            held, total = [], 0
        held.append(words)
        total += len(words)
    if held:
        yield held


def _of_texts(texts: list[list[bytes]], least: int) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs ``(start, length, period)`` of every text, and its words without repeats."""
    codes: dict[bytes, int] = {}
    ids: list[int] = []
    starts = []
    for words in texts:
        starts.append(len(ids))
        ids += [codes.setdefault(w, len(codes)) for w in words]
        ids.append(-len(starts))
    numbers = np.array(ids, np.int64)
    ends = numbers < 0
    numbers[ends] = len(codes) - 1 - numbers[ends]
    runs = maximal_runs(numbers, max(map(len, texts)) // 2)
    runs = runs[runs[:, 1] - runs[:, 0] >= least]
    marks = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
    np.add.at(marks, runs[:, 1], -1)
    kept = np.cumsum(marks[:-1]) == 0
    cut = np.searchsorted(runs[:, 0], [*starts, len(numbers)])
    for i, words in enumerate(texts):
        own = runs[cut[i] : cut[i + 1]]
        found = [(a - starts[i], b - a, q) for a, b, q in own.tolist()]
        if found:
            words = [w for w, keep in zip(words, kept[starts[i] : starts[i] + len(words)].tolist(), strict=True) if keep]
        yield found, b" ".join(words)


def periodic_runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``doc_id, n_words, runs, collapsed`` for every row of ``docs(doc_id, text)``.

    ``runs`` holds ``(start, length, period)`` of every run of at least ``least`` words, by
    start and period; ``collapsed`` is the text's words, joined by one space, without those
    that lie in a run behind its first period.
    """
    schema = "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            # splitting bytes parts words at spaces, tabs and line ends of ASCII and nowhere else
            texts = [(value.as_py() or "").encode().split() for value in batch.column(1)]
            for group in _texts_together(texts):
                rows = list(_of_texts(group, least))
                columns = [
                    batch.column(0).slice(at, len(group)),
                    pa.array([len(words) for words in group], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in found] for found, _ in rows], pa.list_(run)),
                    pa.array([text.decode() for _, text in rows], pa.string()),
                ]
                at += len(group)
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "runs", "collapsed"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(work, schema)


def run_digests(found: DataFrame) -> DataFrame:
    """``doc_id, n_runs``, the longest run and digests, from :func:`periodic_runs`."""
    sha = lambda text: F.sha2(text.cast("binary"), 256)
    # the greatest of (length, -start, -period)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[x].cast("string") for x in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).cast("long").alias("exponent_milli"),
        sha(F.array_join(lines, "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
        "n_words",
    )


def planted(words: Column, doc_id: Column) -> Column:
    """The words, in every tenth document from some word on with a period of some words."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g, n = F.floor(h / 10), F.size(words)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    turned = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p)))
    return F.when((h % 10 == 0) & (n > 0), turned).otherwise(words)
