from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from corpusflow.llm.periodic_runs import LEAST, maximal_runs, periodic_runs, run_digests
from corpusflow.llm.queries import QUERIES
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, docs_frame, space_words


def plain_runs(words):
    """Every lag compared over the whole sequence; smaller periods come first."""
    w = np.unique(np.array(words, object), return_inverse=True)[1] if len(words) else np.zeros(0, int)
    found = {}
    for q in range(1, len(w) // 2 + 1):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (w[q:] == w[:-q]).astype(int), [0]))))
        for a, b in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if b - a >= q:
                found.setdefault((a, b + q), q)
    return sorted((a, b, q) for (a, b), q in found.items())


def plain_digest(doc, words):
    runs = sorted((a, b - a, q) for a, b, q in plain_runs(words) if b - a >= max(LEAST, 2 * q))
    runs.sort(key=lambda r: (r[0], r[2]))
    dropped = {i for a, n, q in runs for i in range(a + q, a + n)}
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    four = (None,) * 4 if best is None else (best[0], best[1], best[2], 1000 * best[1] // best[2])
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (doc, len(runs), *four, sha("".join(f"{a},{n},{q}\n" for a, n, q in runs)), sha(kept), len(words))


def plant(doc, words):
    if doc is None:
        return words
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]


def nested(rng):
    """Words made by repeating, mirroring and joining shorter ones: many runs within runs."""

    def made(depth):
        r = rng.random()
        if not depth or r < 0.25:
            return [rng.randrange(letters) for _ in range(rng.randint(1, 12))]
        if r < 0.6:
            return (made(depth - 1) * rng.randint(2, 5))[: rng.randint(1, 600)]
        if r < 0.7:
            half = made(depth - 1)
            return half + half[::-1]
        return made(depth - 1) + made(depth - 1)

    letters = rng.choice([1, 2, 2, 3, 5, 50])
    return made(rng.randint(1, 6))[:600]


@pytest.mark.parametrize("seed", range(4))
def test_all_runs_of_nested_repeats(seed):
    rng = random.Random(seed)
    for _ in range(150):
        words = nested(rng)
        got = sorted(tuple(r) for r in maximal_runs(np.array(words, np.int64)).tolist())
        assert got == plain_runs(words)


def test_fibonacci_word_and_long_uniform_texts():
    a, b = [0], [0, 1]
    while len(b) < 3_000:
        a, b = b, b + a
    assert sorted(tuple(r) for r in maximal_runs(np.array(b)).tolist()) == plain_runs(b)
    assert maximal_runs(np.zeros(300_000, np.int64)).tolist() == [[0, 300_000, 1]]
    assert maximal_runs(np.arange(300_000) % 20_011).tolist() == [[0, 300_000, 20_011]]
    for n in range(3):
        assert maximal_runs(np.zeros(n, np.int64)).tolist() == ([[0, 2, 1]] if n == 2 else [])


def test_awkward_documents(spark):
    ship_package(spark)
    rng = random.Random(9)
    rows = awkward_rows()
    rows += [(100 + i, " ".join(map(str, nested(rng))), "en", "a") for i in range(60)]
    rows += [(200, "a " * 40_000, None, None), (201, "x\x1cy " * 30, None, None), (202, "\x85 " * 30, None, None)]
    got = [tuple(r) for r in run_digests(periodic_runs(docs_frame(spark, rows))).collect()]
    want = [(i, t) for i, t, _, _ in rows]
    long = {t for _, t in want if t and len(t) > 50_000}
    short = [plain_digest(i, space_words(t)) for i, t in want if t not in long]
    assert sorted((r for r in got if r[8] < 9_000), key=str) == sorted(short, key=str)
    assert {r[0]: r[1:6] for r in got}[200] == (1, 0, 40_000, 1, 40_000_000)
    assert periodic_runs(docs_frame(spark, [])).count() == 0


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    want = [plain_digest(r.doc_id, plant(r.doc_id, space_words(r.text))) for r in docs if len(r.text) < 40_000]
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, folder).collect()]
    assert len(got) == len(docs) and set(want) <= set(got) and len(want) > 150
    assert sum(r[1] > 0 for r in got) >= 10


def test_query_on_null_and_empty_texts(spark, tmp_path):
    rows = [(i, t) for i in range(40) for t in (None, "", " ", "one", "a b a b")] + [(None, "a b " * 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()]
    assert sorted(got, key=str) == sorted((plain_digest(i, plant(i, space_words(t))) for i, t in rows), key=str)
