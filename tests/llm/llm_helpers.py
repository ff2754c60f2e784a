"""Plain Python versions of the operators' contracts, and documents with awkward rows."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import xxhash

DOCS = "doc_id long, text string, lang string, source string, n_chars long, path string, n long, h long, words string, copies string"


def docs_frame(spark, rows, schema=DOCS):
    """Documents from ``(doc_id, text, lang, source)``, with columns whose names the operators use inside."""
    filled = [(i, t, lang, source, None if t is None else len(t), "p", 1, 2, "w", "c") for i, t, lang, source in rows]
    return spark.createDataFrame(filled, schema)


def prose(seed: int, n: int, vocabulary: int = 400) -> str:
    rng = np.random.default_rng(seed)
    letters = np.array(list("abcdefghiklmnoprstuvw"))
    words = ["".join(np.random.default_rng(10_000 + int(k)).choice(letters, 3 + int(k) % 6)) for k in rng.integers(0, vocabulary, n)]
    out = []
    for at in range(0, n, 9):
        out.append(" ".join(words[at : at + 9]).capitalize() + ".")
    return " ".join(out)


def awkward_rows():
    """Nulls, empty and very long texts, repeated rows and ids, ties."""
    long = prose(1, 30_000)
    same = prose(2, 80)
    return [
        (1, same, "en", "a"), (2, same, "en", "a"), (2, same, "en", "a"), (3, None, None, None), (None, prose(3, 60), "en", None),
        (None, None, None, "b"), (4, "", "fr", "b"), (5, " \n\t ", "fr", "b"), (6, long, "en", "a"), (7, long + " end", "en", "c"),
        (8, "ÉÀ ñ 漢字 \U0001f600", None, "c"), (9, "one", "en", "c"), (9, "two words", "en", "c"), (10, prose(4, 70), "en", "a"), (11, "...!?", "de", "a"),
    ]


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def space_words(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def plain_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def fingerprint(text, k=3):
    w = space_words(lower(text))
    runs = [" ".join(w[i : i + k]) for i in range(max(1, len(w) - k + 1))] if w else []
    counts = [0] * 64
    for run in runs:
        h = xxhash.xxh64_intdigest(run.encode(), 42)
        for bit in range(64):
            counts[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(runs))


def roots(n, links):
    """Smallest index reachable, for every index."""
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    return [find(i) for i in range(n)]


def near_pairs(values, radius=3):
    v = np.array(values, np.uint64)
    for i in range(len(v)):
        for j in np.flatnonzero(np.bitwise_count(v[i] ^ v[i + 1 :]) <= radius):
            yield i, i + 1 + int(j)


def benchmark_hits(docs, items, window=10):
    windows = {}
    for item, text in items:
        w = plain_words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = []
    for doc, text in docs:
        w, hit, found = plain_words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    found |= windows[tuple(w[i : i + n])]
                    hit |= set(range(i, i + n))
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def statistics(text):
    w = space_words(text)
    at = {}
    for i in range(len(w) - 2):
        at.setdefault(tuple(w[i : i + 3]), []).append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if space_words(x)]
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered), n < 50 or 100 * len(covered) > 50 * n)
