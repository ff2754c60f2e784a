"""Toxic documents by a gapped-subsequence string kernel over the words of sentences.

The kernel of two windows, a word or two neighbouring words of one sentence, counts the runs
of ``ORDER`` letters, in order, that both hold within ``SPAN`` positions; word ends are letters
too, and runs cross from one word of a window to the other.  A run that spreads over more
positions counts less.  Inserted letters, spaced-out letters, signs between letters and
look-alike digits so leave most of an insult's value, and an insult of two plain words has
runs that neither word has.
An SVM is trained in the space of Nystroem landmarks.  As the kernel has an explicit map to
runs of letters, the trained vector folds back into one weight per hashed run, and a whole
text is scored by table look-ups.

Training units are sentences: a sentence counts as much as its worst window, a document as
much as its worst sentence.  Of a clean document every sentence is clean, so its worst window
under the present weights joins the counterexamples in each round.  A toxic document has one
toxic sentence at least; the window that explains its label best stands for it, at first the one
of most evidence, the log-likelihood ratio of its counts in toxic and clean sentences.  Windows of
much evidence in several documents are examples throughout, as an insult may never be the best in
any document.  Equal sentences count once, so that copies of a document do not make its words suspect.

Training takes the labelled documents with the smallest hashes, ``FIT_TOXIC`` and
``FIT_CLEAN`` at most, a quarter of them to turn values into probabilities, the others to fit.  A
sentence of more than ``BAG`` words trains as several that share a word.

Letters are folded to their base by compatibility forms, also those of mathematical alphabets;
every letter of every script has a code of its own.  Null, empty and wordless texts have the
value of no insult.  Repeated rows and ids score alike; labels with a null id or class are left
out.  Texts are read in pieces of a million characters that share a word, so the time is in
proportion to the length; only a word longer than that is cut, and letters spaced out across the
end of a piece stay apart.  Without training rows of both
classes every score is the share of toxic labels, 0 if there are none.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import numbered_columns
from corpusflow.scratch import stored

ORDER = 3
SPAN = 5
DECAY = 0.7
LANDMARKS = 320
FIT_TOXIC, FIT_CLEAN = 3_000, 6_000
WINDOWS = 16_000  # clean windows
SUSPECTS = 40_000  # windows of toxic documents
SENTENCES = 8_000  # clean sentences searched for their worst window
LIFT = 2.0  # how many times as often toxic sentences hold a suspect
EVIDENCE, SUPPORT = 30.0, 3  # least evidence and documents of a window that is an example by itself
ROUNDS = 4
EXPLAINED = 0.2  # least value of a window that explains a toxic label
COST = 4.0
THRESHOLD = 0.3
LONGEST = 40
BAG = 64
BITS = 18
DIM = 1 << BITS
PIECE = 1 << 20
BLOCK = 250  # windows whose kernel rows are built at once
STOP, END, SIGN = 10, 32, 1  # codes: end of a sentence, of a word, a sign to be passed over

#: Odd factors that hash the letters of a run, one for each place in it.
FACTORS = (0x9E3779B1, 0x85EBCA6B, 0xC2B2AE35)

#: Signs that stand for letters.
LOOKALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s"}

#: Signs that end a sentence before white space, and those that do without it.
MARKS, FULL_STOPS = ".!?\u2026", "\u3002\uff01\uff1f\n"

#: Positions of a run's letters after the first, by the last of them.
PATTERNS = {last: [(*inner, last) for inner in combinations(range(1, last), ORDER - 2)] for last in range(ORDER - 1, SPAN)}


def _letter_code(char: str) -> int:
    if char in FULL_STOPS:
        return STOP
    if char.isspace():
        return END
    if char in LOOKALIKES:
        return ord(LOOKALIKES[char])
    base = unicodedata.normalize("NFKD", char.lower())[0]
    return ord(base) if base.isalpha() else SIGN


#: Code of every character of the first plane.
LETTERS = np.array([_letter_code(chr(point)) for point in range(1 << 16)], np.uint32)


def coded(text: str) -> np.ndarray:
    """Letter codes of a text with a sentence's end on either side; signs are left out, spaced-out letters closed up."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.full(len(points) + 2, STOP, np.uint32)
    codes[1:-1] = LETTERS[np.minimum(points, 0xFFFF)]
    for point in np.unique(points[points > 0xFFFF]):
        codes[1:-1][points == point] = _letter_code(chr(point))
    marked = np.zeros(len(codes), bool)
    marked[2:-1] = np.isin(points[:-1], [ord(c) for c in MARKS])
    codes[marked & (codes == END)] = STOP
    codes = codes[codes != SIGN]
    gap = codes <= END
    starts = np.flatnonzero(gap & np.r_[True, ~gap[:-1]])  # of several ends in a row one is left, a sentence's if there is one
    stops = np.add.reduceat(codes == STOP, starts, dtype=np.int64) > 0
    codes[starts] = np.where(stops, STOP, END)
    codes = codes[~gap | np.r_[True, ~gap[:-1]]]
    gap = codes <= END
    lone = np.zeros(len(codes), bool)
    lone[1:-1] = gap[:-2] & ~gap[1:-1] & gap[2:]
    between = np.zeros(len(codes), bool)
    between[1:-1] = lone[:-2] & gap[1:-1] & lone[2:]
    close = np.zeros(len(codes), bool)  # the spaces of three lone letters in a row
    close[2:] |= between[2:] & between[:-2]
    close[:-2] |= between[:-2] & between[2:]
    return codes[~close]


def sentences(text: str | None) -> list[str]:
    """Coded sentences, words joined by one space."""
    return [part for part in coded(text or "").tobytes().decode("utf-32-le").split("\n") if part]


def windows(sentence: str) -> list[str]:
    """The words and pairs of neighbouring words of a coded sentence, each once."""
    words = sentence.split(" ")
    found = [w for w in words if len(w) >= ORDER] + [f"{a} {b}" for a, b in zip(words, words[1:], strict=False)]
    return sorted({w for w in found if len(w) <= LONGEST})


def _points(parts: list[str]) -> np.ndarray:
    return np.frombuffer("\n".join(["", *parts, ""]).encode("utf-32-le"), np.uint32)


def _runs(codes: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each length: weight, word ends within a run that starts here, whether a sentence ends there, indexes of the runs."""
    ends, stops = np.cumsum(codes <= END, dtype=np.int32), np.cumsum(codes == STOP, dtype=np.int32)
    letters = np.where(codes == STOP, np.uint32(END), codes)
    hashed = [letters * np.uint32(factor) for factor in FACTORS]
    for last, patterns in PATTERNS.items():
        n = len(codes) - last
        if n <= 0:
            continue
        inner = slice(last - 1, last - 1 + n)
        indexes = []
        for offsets in patterns:
            index = hashed[0][:n].copy()
            for o, place in zip(offsets, hashed[1:], strict=True):
                index += place[o : o + n]
            indexes.append((index >> np.uint32(32 - BITS)).view(np.int32))
        yield DECAY**last, ends[inner] - ends[:n], stops[inner] != stops[:n], indexes


def window_values(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of every word of a coded text and of every word with the next: normalised kernel sums, without the bias.

    What has no run, and the pair of a sentence's last word, is -inf.
    """
    starts = np.flatnonzero(codes <= END)[:-1]
    if not len(starts):
        return np.empty(0), np.empty(0)
    size = np.zeros((4, len(codes)), np.float32)  # sums and squared norms within words and across the next word's start
    for weight, crossed, stopped, indexes in _runs(codes):
        part = weights[indexes[0]]
        for index in indexes[1:]:
            part += weights[index]
        part *= np.float32(weight)
        square = np.float32(weight * weight * len(indexes))
        for row, here in ((0, crossed == 0), (2, (crossed == 1) & ~stopped)):
            size[row, : len(part)] += part * here
            size[row + 1, : len(part)] += square * here
    size[:, -1] = 0
    total, norm, over, over_norm = np.add.reduceat(size, starts, axis=1).astype(np.float64)
    total2, norm2 = total[:-1] + total[1:] + over[:-1], norm[:-1] + norm[1:] + over_norm[:-1]
    joined = (codes[starts[1:]] != STOP) & (norm2 > 0)
    with np.errstate(invalid="ignore", divide="ignore"):
        single = np.where(norm > 0, total / np.sqrt(norm), -np.inf)
        pair = np.where(joined, total2 / np.sqrt(norm2), -np.inf)
    return single, pair


def text_value(text: str | None, weights: np.ndarray, bias: float) -> tuple[float, int]:
    """The worst window's value and the number of words and pairs with a value above zero, over the whole text."""
    worst, count = -1.0, 0
    text, at, fresh, again = text or "", 0, 0, False  # a piece begins at `at`, what is new in it at `fresh`
    while fresh < len(text):
        end = min(len(text), fresh + PIECE)
        while end < len(text) and not text[end].isspace() and end < fresh + 2 * PIECE:
            end += 1
        single, pair = (values + bias for values in window_values(coded(text[at:end]), weights))
        for values in (single, pair):
            worst = max(worst, float(values.max(initial=-np.inf)))
        count += int((single[again:] > 0).sum() + (pair > 0).sum())
        again, back = False, end
        if end < len(text) and text[end].isspace():
            while back > at and not again:  # the next piece begins with this one's last word
                back = max(at, *(text.rfind(c, at, back) for c in " \n\t"))
                again = len(coded(text[back:end])) > 1
        at, fresh = back if again else end, end
    return worst, count


@dataclass
class ToxicModel:
    """Weights of hashed letter runs, bias, and the logistic curve of a document's value."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    def probability(self, value: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * value + self.shift, -30, 30)))


def runs_of(windows: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``row, index, value`` of the normalised run features of windows."""
    rows, columns, values = [], [], []
    codes = _points(windows)
    window = np.cumsum(codes == STOP) - 1
    for weight, _, stopped, indexes in _runs(codes):
        here = np.flatnonzero(~stopped & (window[: len(stopped)] < len(windows)))
        for index in indexes:
            rows.append(window[here])
            columns.append(index[here])
            values.append(np.full(len(here), weight, np.float32))
    if not rows:
        return np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.float32)
    row, column, value = np.concatenate(rows), np.concatenate(columns), np.concatenate(values)
    norm = np.sqrt(np.bincount(row, value * value, len(windows)))
    return row, column, value / np.maximum(norm[row], 1e-9).astype(np.float32)


def kernel(windows: list[str], marks: list[str]) -> np.ndarray:
    """Kernel values of windows against landmarks, in blocks of windows."""
    row, column, value = runs_of(marks)
    used, place = np.unique(column, return_inverse=True)
    table = np.zeros((len(used) + 1, len(marks)), np.float32)
    np.add.at(table, (place, row), value)
    out = np.zeros((len(windows), len(marks)), np.float32)
    for at in range(0, len(windows), BLOCK):
        r, c, v = runs_of(windows[at : at + BLOCK])
        spot = np.minimum(np.searchsorted(used, c), len(used) - 1)
        held = used[spot] == c
        r, spot, v = r[held], spot[held], v[held]
        order = np.argsort(r, kind="stable")
        r, spot, v = r[order], spot[order], v[order]
        if len(r):
            starts = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
            part = table[spot]
            part *= v[:, None]
            out[at + r[starts]] = np.add.reduceat(part, starts, axis=0)
    return out


def squared_hinge_svm(parts: list[tuple[np.ndarray, float]], cost: float, steps: int = 12) -> np.ndarray:
    """Primal SVM with squared hinge loss by Newton steps, over ``(rows, label)`` parts; the last column is the bias.

    Sums are formed over stretches of rows, so that no second copy of the rows is made.
    """
    size = parts[0][0].shape[1]
    w, ridge = np.zeros(size), np.eye(size)
    ridge[-1, -1] = 1e-3
    active = [np.ones(len(x), bool) for x, _ in parts]
    for _ in range(steps):
        square, linear = ridge.copy(), np.zeros(size)
        for (x, y), on in zip(parts, active, strict=True):
            for at in range(0, len(x), 4_000):
                xa = x[at : at + 4_000][on[at : at + 4_000]]
                square += cost * (xa.T @ xa)
                linear += cost * y * xa.sum(axis=0, dtype=np.float64)
        w = np.linalg.solve(square, linear)
        now = [y * (x @ w.astype(np.float32)) < 1 for x, y in parts]
        if all(np.array_equal(n, o) for n, o in zip(now, active, strict=True)) or not any(n.any() for n in now):
            break
        active = now
    return w


def worst_windows(bags: list[str], weights: np.ndarray) -> list[tuple[float, str]]:
    """Value and text of every sentence's worst window, without the bias."""
    codes = _points(bags)
    single, pair = window_values(codes, weights)
    words = [w for bag in bags for w in bag.split(" ")]
    bag = np.repeat(np.arange(len(bags)), [b.count(" ") + 1 for b in bags])
    pair = np.append(pair, -np.inf)
    paired = pair > single
    value = np.where(paired, pair, single)
    order = np.lexsort((-value, bag))
    first = order[np.r_[True, bag[order][1:] != bag[order][:-1]]]
    return [(float(value[i]), f"{words[i]} {words[i + 1]}" if paired[i] else words[i]) for i in first if value[i] > -np.inf]


def train_windows(clean: list[str], bags: list[str], suspects: list[tuple[int, str, float]]) -> tuple[np.ndarray, float]:
    """Run weights and bias from clean windows, clean sentences and ``(document, window, evidence)`` suspects."""
    docs, texts, evidence = (list(c) for c in zip(*suspects, strict=True))
    wide = sorted({(-n, w) for w, n in zip(texts, evidence, strict=True)})
    half = LANDMARKS // 2
    take = lambda pool, n: [pool[i] for i in np.unique(np.linspace(0, len(pool) - 1, min(n, len(pool))).astype(int))]
    marks = [w for _, w in wide[:half]] + take(sorted(clean), half)
    values, vectors = np.linalg.eigh(kernel(marks, marks).astype(np.float64))
    held = values > 1e-6 * values[-1]
    whiten = vectors[:, held] / np.sqrt(values[held])
    narrow = whiten.astype(np.float32)
    mark_row, mark_column, mark_value = runs_of(marks)

    def mapped(group: list[str]) -> np.ndarray:
        out = np.ones((len(group), narrow.shape[1] + 1), np.float32)
        for at in range(0, len(group), 2_000):
            np.matmul(kernel(group[at : at + 2_000], marks), narrow, out=out[at : at + 2_000, :-1])
        return out

    def folded(w: np.ndarray) -> np.ndarray:
        out = np.zeros(DIM, np.float32)
        np.add.at(out, mark_column, (mark_value * (whiten @ w[:-1])[mark_row]).astype(np.float32))
        return out

    single = sorted(set(texts))  # a window that several documents hold is mapped once
    place = {text: i for i, text in enumerate(single)}
    row_of = np.array([place[text] for text in texts])
    positive, negative, known = mapped(single), [mapped(clean)], set(clean)
    docs, evidence = np.array(docs), np.array(evidence)
    support = np.bincount(row_of)
    proven = np.zeros(len(single), bool)
    proven[row_of] = evidence >= EVIDENCE
    proven &= support >= SUPPORT
    examples = np.repeat(np.flatnonzero(proven), np.minimum(support[proven], 10))

    def best(value: np.ndarray) -> np.ndarray:
        order = np.lexsort((-value, docs))
        return order[np.r_[True, docs[order][1:] != docs[order][:-1]]]

    witness = best(evidence)
    several = support[row_of[witness]] > 1
    witness = witness[several] if several.any() else witness
    w = np.zeros(positive.shape[1])
    for _ in range(ROUNDS):
        w = squared_hinge_svm([*((x, -1.0) for x in negative), (positive[np.r_[row_of[witness], examples]], 1.0)], COST)
        worst = {text for value, text in worst_windows(bags, folded(w)) if value + w[-1] > -1} if bags else set()
        hard = sorted(text for text in worst - known if len(text) <= LONGEST)
        if hard:
            negative.append(mapped(hard))
            known.update(hard)
        value = (positive @ w.astype(np.float32))[row_of]
        found = best(value)
        found = found[value[found] > EXPLAINED]  # documents that nothing explains stay out
        if not len(found) and not len(examples):
            break
        witness = found
    return folded(w), float(w[-1])


def fit_logistic(value: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps with a small ridge."""
    x, w = np.c_[value, np.ones(len(value))], np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-2 * np.eye(2), x.T @ (label - p) - 1e-2 * w)
        w = w + step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for doc, toxic, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            bags = []
            for words in (s.split(" ") for s in sentences(text)):
                bags += [" ".join(words[at : at + BAG]) for at in range(0, max(len(words) - 1, 1), BAG - 1)]
            if bags:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(bags), pa.int64()), pa.array([toxic] * len(bags), pa.int32()), pa.array(bags, pa.string())], ["doc_id", "toxic", "bag"]
                )


def _bag_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [windows(bag) for bag in batch.column(1).to_pylist()]
        key = batch.column(0).take(pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]), pa.int64()))
        yield pa.RecordBatch.from_arrays([key, pa.array([w for f in found for w in f], pa.string())], [batch.schema.names[0], "window"])


def train_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicModel:
    """A model from ``docs(doc_id, text)`` and ``labels(doc_id, toxic)``, all rows of which may be learned from."""
    spread = F.xxhash64(F.col("doc_id").cast("string"))
    known = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where("doc_id IS NOT NULL AND toxic IN (0, 1)").distinct()
    known = known.withColumn("h", spread)
    chosen = known.where("toxic = 1").orderBy("h", "doc_id").limit(FIT_TOXIC).unionByName(known.where("toxic = 0").orderBy("h", "doc_id").limit(FIT_CLEAN))
    chosen = stored(chosen.select("doc_id", "toxic", (F.pmod(F.shiftright("h", 7), F.lit(4)) == 0).alias("apart")), "chosen")
    sample = stored(docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), "doc_id"), "sample")
    bags = stored(sample.where("NOT apart").select("doc_id", "toxic", "text").mapInArrow(_bags, "doc_id long, toxic int, bag string"), "bags")
    single = bags.select("toxic", "bag").distinct()
    held = single.mapInArrow(_bag_windows, "toxic int, window string")
    counts = stored(held.groupBy("window").agg(F.sum("toxic").alias("t"), F.sum(1 - F.col("toxic")).alias("c")), "windows")
    dirty, sound = single.agg(F.coalesce(F.sum("toxic"), F.lit(0)), F.coalesce(F.sum(1 - F.col("toxic")), F.lit(0))).first()
    lift = (F.col("t") + 0.5) / (F.col("c") + 0.5)
    suspect = (F.col("t") > 0) & ((F.col("c") == 0) | (lift * (sound + 1) > LIFT * (dirty + 1)))
    n, part = F.col("t") + F.col("c"), dirty / max(dirty + sound, 1)
    against = F.when(F.col("c") > 0, F.col("c") * F.log(F.col("c") / (n * (1 - part)))).otherwise(0.0)
    evidence = F.col("t") * F.log(F.col("t") / (n * part)) + against
    suspects = counts.where(suspect).select("window", evidence.alias("evidence")).orderBy(F.desc("evidence"), F.xxhash64("window"), "window").limit(SUSPECTS)
    plain = counts.where((F.col("c") > 0) & ~suspect)
    common, others = plain.orderBy(F.desc("c"), "window").limit(WINDOWS // 2), plain.orderBy(F.xxhash64("window"), "window").limit(WINDOWS // 2)
    clean = sorted({r.window for r in common.unionByName(others).collect()})
    clean_bags = [r.bag for r in single.where("toxic = 0").orderBy(F.xxhash64("bag"), "bag").limit(SENTENCES).collect()]
    rows = bags.where("toxic = 1").select("doc_id", "bag").mapInArrow(_bag_windows, "doc_id long, window string").join(F.broadcast(suspects), "window").distinct()
    rows = rows.orderBy(F.desc("evidence"), F.xxhash64("window"), "doc_id").limit(SUSPECTS).collect()
    share = known.agg(F.avg("toxic")).first()[0] or 0.0
    flat = ToxicModel(np.zeros(DIM, np.float32), 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))) if share else -30.0)
    if not clean or not rows:
        return flat
    weights, bias = train_windows(clean, clean_bags, sorted((r.doc_id, r.window, float(r.evidence)) for r in rows))
    model = ToxicModel(weights, bias, 1.0, 0.0)
    held = _valued(sample.where("apart"), model, ["toxic"]).select("value", "toxic").collect()
    value, label = np.array([r.value for r in held]), np.array([r.toxic for r in held], float)
    if len(np.unique(label)) < 2:
        return flat
    model.slope, model.shift = fit_logistic(value, label)
    return model


def _valued(docs: DataFrame, model: ToxicModel, keep: list[str]) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(model.weights), model.weights[model.weights != 0], model.bias))
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in fields] + ["value double", "n_hits long"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, bias = sent.value
        weights = np.zeros(DIM, np.float32)
        weights[places] = values
        for batch in batches:
            found = [text_value(t.as_py(), weights, bias) for t in batch.column(len(keep))]
            arrays = [*batch.columns[: len(keep)], pa.array([v for v, _ in found], pa.float64()), pa.array([n for _, n in found], pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, [*keep, "value", "n_hits"])

    return docs.select(*keep, "text").mapInArrow(work, schema)


def score_toxicity(docs: DataFrame, model: ToxicModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with ``score``, ``predicted`` and ``n_hits``, the words and pairs above zero."""
    slope, shift = F.lit(model.slope), F.lit(model.shift)
    score = 1 / (1 + F.exp(-F.greatest(F.lit(-30.0), F.least(F.lit(30.0), slope * F.col("value") + shift))))
    return _valued(docs, model, keep).select(*keep, score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"), "n_hits")


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the documents that the model rejects; the columns stay.

    Rows go one by one, by their own text.
    """
    model = train_toxicity(docs, labels)
    names = [c for c in docs.columns if c != "text"]
    return _kept(docs, model, names)


def _kept(docs: DataFrame, model: ToxicModel, names: list[str]) -> DataFrame:
    bad = float(np.log(THRESHOLD / (1 - THRESHOLD)))
    cut = model.slope, model.shift
    sent = docs.sparkSession.sparkContext.broadcast((np.flatnonzero(model.weights), model.weights[model.weights != 0], model.bias))
    columns = docs.columns
    at = columns.index("text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, values, bias = sent.value
        weights = np.zeros(DIM, np.float32)
        weights[places] = values
        for batch in batches:
            stay = [cut[0] * text_value(t.as_py(), weights, bias)[0] + cut[1] < bad for t in batch.column(at)]
            yield batch.filter(pa.array(stay, pa.bool_())).rename_columns(columns)

    return numbered_columns(docs).mapInArrow(work, docs.schema)
