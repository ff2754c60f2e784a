"""Language by hierarchy: the family first, then pairs of related languages.

Texts become square roots of hashed letter-pair and letter-triple counts, scaled to length
one, with words set off by single spaces and digits and signs left out.  One linear SVM per
family tells it from the others; inside the chosen family one linear SVM per pair of
languages votes, ties going to the larger sum of margins.  Languages outside the table of
families are families of their own.

Training takes about ``PER_LANGUAGE`` texts of each language, those with the smallest
hashes, and ``FIT_ROWS`` in all at most; only fixed-length vectors reach the driver.

Null texts and texts without a letter are ``und`` with score 0.  Repeated rows are judged
alike.  Rows with a null language are not learned from.  Without training rows everything
is ``und``; with a single language every text with letters gets it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusflow.llm.common import sent_whole
from corpusflow.scratch import stored

PER_LANGUAGE = 400
FIT_ROWS = 3_000
PAIR_BITS, TRIPLE_BITS = 11, 12
DIM = (1 << PAIR_BITS) + (1 << TRIPLE_BITS)
COST = 10.0
UNKNOWN = "und"
BLOCK = 128

#: Families of common languages, by ISO 639-1 code.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt rm ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indic": "bn gu hi mr ne pa si ur",
    "iranian": "fa ku ps tg",
    "dravidian": "kn ml ta te",
    "semitic": "am ar he mt",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become spaces.
ONLY_LETTERS = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))


def vector(text: str) -> np.ndarray:
    """The hashed, scaled counts of one whole text."""
    plain = b" " + b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(ONLY_LETTERS).split()) + b" "
    a = np.frombuffer(plain, np.uint8).astype(np.uint32)
    out = np.zeros(DIM, np.float32)
    pairs = (a[:-1] << 8) | a[1:]
    out[: 1 << PAIR_BITS] = np.bincount((pairs * np.uint32(2654435761)) >> np.uint32(32 - PAIR_BITS), minlength=1 << PAIR_BITS)
    triples = (pairs[:-1] << 8) | a[2:]
    out[1 << PAIR_BITS :] = np.bincount((triples * np.uint32(2654435761)) >> np.uint32(32 - TRIPLE_BITS), minlength=1 << TRIPLE_BITS)
    np.sqrt(out, out=out)
    return out / max(float(np.sqrt((out * out).sum())), 1e-9)


@dataclass
class LanguageModel:
    """One weight vector and bias per family, and per pair of languages of one family."""

    families: list[str]
    members: list[list[str]]
    family_weights: np.ndarray
    pairs: list[tuple[str, str]]
    pair_weights: np.ndarray

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of every row of vectors."""
        x = np.c_[x, np.ones(len(x), np.float32)]
        margins = x @ self.family_weights.T if len(self.families) > 1 else np.ones((len(x), 1))
        chosen = margins.argmax(axis=1)
        sure = 1 / (1 + np.exp(-2 * np.clip(margins, -15, 15)))
        sure = sure[np.arange(len(x)), chosen] / sure.sum(axis=1)
        duel = x @ self.pair_weights.T if self.pairs else np.zeros((len(x), 0))
        names, scores = [], np.zeros(len(x))
        for i, family in enumerate(chosen):
            votes = {m: [0, 0.0, 1.0] for m in self.members[family]}
            for margin, (a, b) in zip(duel[i], self.pairs, strict=True):
                if a in votes and b in votes:
                    winner = a if margin >= 0 else b
                    votes[winner][0] += 1
                    for name, value in ((a, margin), (b, -margin)):
                        votes[name][1] += value
                        votes[name][2] = min(votes[name][2], 1 / (1 + np.exp(-2 * np.clip(value, -15, 15))))
            best = max(votes, key=lambda m: (votes[m][0], votes[m][1], m))
            names.append(best)
            scores[i] = sure[i] * votes[best][2]
        return names, scores


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = COST) -> np.ndarray:
    """Squared-hinge SVM over rows of ``x``, solved on the rows inside the margin."""
    gram = (x @ x.T + 1).astype(np.float64)  # the bias counts as a column of ones
    active, alpha = np.ones(len(y), bool), np.zeros(len(y))
    for _ in range(20):
        alpha = np.zeros(len(y))
        inner = gram[np.ix_(active, active)] + np.eye(int(active.sum())) / cost
        alpha[active] = np.linalg.solve(inner, y[active])
        now = y * (gram @ alpha) < 1
        if np.array_equal(now, active) or not now.any():
            break
        active = now
    return np.append(x.T @ alpha.astype(np.float32), alpha.sum()).astype(np.float32)


def fit_languages(x: np.ndarray, lang: list[str]) -> LanguageModel:
    """A model from vectors and their languages."""
    names = np.array(lang, dtype=object)
    known = sorted(set(lang))
    family = np.array([FAMILY_OF.get(name, name) for name in lang], dtype=object)
    families = sorted(set(family))
    members = [[k for k in known if FAMILY_OF.get(k, k) == f] for f in families]
    tops = [linear_svm(x, np.where(family == f, 1.0, -1.0)) for f in families] if len(families) > 1 else []
    pairs = [pair for group in members for pair in combinations(group, 2)]
    duels = []
    for a, b in pairs:
        of = (names == a) | (names == b)
        duels.append(linear_svm(x[of], np.where(names[of] == a, 1.0, -1.0)))
    stacked = lambda w: np.array(w, np.float32).reshape(len(w), DIM + 1)
    return LanguageModel(families, members, stacked(tops), pairs, stacked(duels))


def train_languages(docs: DataFrame, per_language: int = PER_LANGUAGE, rows: int = FIT_ROWS) -> LanguageModel:
    """A model from ``docs(text, lang)``, all rows of which may be learned from."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL").select("lang", "text", (F.pmod(F.xxhash64("text", "lang"), F.lit(1 << 40)) / F.lit(float(1 << 40))).alias("u"))
    counts = stored(known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")), "counts")
    near = known.join(sent_whole(counts), "lang").where(F.col("u") * F.col("n") < per_language)
    chosen = stored(near.orderBy(F.col("u") * F.col("n"), "lang", "text").limit(rows).select("lang", "text"), "chosen")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [vector(t.as_py()).astype(np.float16).tobytes() if LETTER.search(t.as_py()) else None for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["lang", "x"])

    found = chosen.mapInArrow(work, "lang string, x binary").where("x IS NOT NULL").orderBy("lang", "x").collect()
    x = np.frombuffer(b"".join(bytes(r.x) for r in found), np.float16).astype(np.float32).reshape(-1, DIM)
    return fit_languages(x, [r.lang for r in found])


def identify(docs: DataFrame, model: LanguageModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of every row, with ``lang_pred`` and ``score``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep] + ["lang_pred string", "score double"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = [], []
            for at in range(0, batch.num_rows, BLOCK):
                texts = batch.column(len(keep)).slice(at, BLOCK).to_pylist()
                real = [i for i, t in enumerate(texts) if t and LETTER.search(t)] if sent.value.families else []
                block = [UNKNOWN] * len(texts)
                score = np.zeros(len(texts))
                if real:
                    found, score[real] = sent.value.predict(np.stack([vector(texts[i]) for i in real]))
                    for i, name in zip(real, found, strict=True):
                        block[i] = name
                names += block
                scores.append(score)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(names, pa.string()), pa.array(np.concatenate([np.zeros(0), *scores]))], [*keep, "lang_pred", "score"]
            )

    return docs.select(*keep, "text").mapInArrow(work, schema)
