"""Quality trees, language SVM and toxicity: parts against plain versions, and held-out accuracy."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.llm import queries
from corpusflow.llm.language_svm import DIM, LanguageModel, fit_languages, identify, linear_svm, train_languages, vector
from corpusflow.llm.quality_trees import DEPTH, FEATURES, fit_forest, score_quality, statistics, train_quality
from corpusflow.llm.toxicity import (
    BITS, DECAY, FACTORS, ORDER, SPAN, coded, drop_toxic, kernel, score_toxicity, sentences, squared_hinge_svm, text_value, train_toxicity,
    train_windows, window_values, windows, worst_windows,
)
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, docs_frame, prose

DATA = "/root/testdata/sf0.1"


def test_trees_walk_like_a_row_by_row_descent():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(900, len(FEATURES))).astype(np.float32)
    x[:, 3] = np.round(x[:, 3])  # ties on the cuts
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 3] > 1)).astype(float)
    forest = fit_forest(x[:600], y[:600], 40)
    got = forest.score(x)
    for i in range(0, 900, 90):
        total = forest.start
        for t in range(40):
            node = 0
            for _ in range(DEPTH):
                node = 2 * node + 1 + (x[i, forest.feature[t, node]] > forest.limit[t, node])
            total += forest.value[t, node - 2**DEPTH + 1]
        assert got[i] == pytest.approx(1 / (1 + np.exp(-total)))
    assert ((got[600:] > 0.5) == y[600:]).mean() > 0.85
    assert fit_forest(x[:0], y[:0]).score(x[:2]).tolist() == [0.5, 0.5]
    assert fit_forest(x, np.ones(900)).score(x).min() > 0.99


def test_statistics_of_odd_texts():
    for text in (None, b"", b" \n", b"|", "é".encode(), b"a" * 100_000, b"\xff\xfe"):
        values = statistics(text)
        assert values.shape == (len(FEATURES),) and np.isfinite(values).all()


def test_quality_held_out(spark):
    found = queries.QUERIES["op6_quality_trees"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "quality").toPandas()
    assert (rows.predicted == rows.quality).mean() > 0.98
    assert rows.predicted[rows.quality == 1].mean() > 0.98


def test_quality_of_awkward_rows(spark):
    ship_package(spark)
    docs = docs_frame(spark, awkward_rows())
    labels = spark.createDataFrame([(1, 1), (3, 0), (4, None), (None, 1), (2, 0), (2, 0)], "doc_id long, quality int")
    rows = score_quality(docs, train_quality(docs, labels), ["doc_id"]).collect()
    assert len(rows) == len(awkward_rows()) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    none = train_quality(docs.where("false"), labels)
    assert score_quality(docs.where("false"), none, ["doc_id"]).count() == 0
    assert {r.score for r in score_quality(docs, none, ["doc_id"]).collect()} == {0.5}


def test_vectors_count_whole_texts():
    assert np.linalg.norm(vector("Ein Satz.")) == pytest.approx(1)
    assert np.array_equal(vector("AB  cd, 12 ef"), vector("ab cd ef"))
    assert not np.array_equal(vector("ab" * 50_000 + " xyz"), vector("ab" * 50_000 + " xyw"))


def test_pairs_and_families_decide():
    rng = np.random.default_rng(2)
    centre = {name: rng.random(DIM).astype(np.float32) ** 8 for name in ("de", "en", "es", "fr", "zz")}
    x = np.stack([centre[n] + 0.05 * rng.random(DIM).astype(np.float32) for n in centre for _ in range(30)])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lang = [n for n in centre for _ in range(30)]
    model = fit_languages(x, lang)
    assert model.families == ["germanic", "romance", "zz"] and model.pairs == [("de", "en"), ("es", "fr")]
    names, score = model.predict(x)
    assert names == lang and ((score > 0) & (score <= 1)).all()
    w = linear_svm(x[:60], np.r_[np.ones(30), -np.ones(30)])
    assert ((np.c_[x[:60], np.ones(60)] @ w > 0) == (np.arange(60) < 30)).all()
    one = fit_languages(x[:5], ["de"] * 5)
    assert isinstance(one, LanguageModel) and set(one.predict(x)[0]) == {"de"}


def test_language_held_out(spark):
    found = queries.QUERIES["op7_language_svm"](spark, DATA)
    docs = spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang")
    rows = found.where("held_out").join(docs, "doc_id").select("lang", "lang_pred").toPandas()
    assert (rows.lang == rows.lang_pred).mean() > 0.99


def test_language_of_awkward_rows(spark):
    ship_package(spark)
    docs = docs_frame(spark, awkward_rows())
    rows = identify(docs, train_languages(docs.select("text", "lang")), ["doc_id"]).collect()
    assert len(rows) == len(awkward_rows())
    assert {r.lang_pred for r in rows if r.doc_id in (3, 4, 5, 11)} == {"und"} and {r.score for r in rows if r.doc_id == 3} == {0.0}
    assert all(r.lang_pred in ("en", "fr", "de") for r in rows if r.doc_id in (1, 6, 8, 9))
    none = train_languages(docs.where("lang = 'none'").select("text", "lang"))
    assert {r.lang_pred for r in identify(docs, none, ["doc_id"]).collect()} == {"und"}
    assert identify(docs.where("false"), none, ["doc_id"]).count() == 0


def plain_runs(window: str) -> list[tuple[int, float]]:
    """Hash and weight of every run of a window of one or two coded words, one by one."""
    from itertools import combinations

    text, out = f" {window} ", []
    for places in combinations(range(len(text)), ORDER):
        span = places[-1] - places[0]
        if span < SPAN:
            mixed = sum(ord(text[p]) * f for p, f in zip(places, FACTORS, strict=True)) % (1 << 32)
            out.append((mixed >> (32 - BITS), DECAY**span))
    return out


def plain_value(window: str, weights: np.ndarray) -> float:
    runs = plain_runs(window)
    return sum(weights[h] * v for h, v in runs) / np.sqrt(sum(v * v for _, v in runs)) if runs else -np.inf


def plain_windows(text: str) -> list[str]:
    found = []
    for sentence in sentences(text):
        words = sentence.split(" ")
        found += words + [f"{words[i]} {words[i + 1]}" for i in range(len(words) - 1)]
    return found


def test_kernel_equals_a_listing_of_runs():
    parts = ["idiot", "idxiot", "banana", "to", "strase", "a", "go away", "идиот", "go"]

    def plain(a, b):
        table = {}
        for h, v in plain_runs(b):
            table[h] = table.get(h, 0.0) + v
        norm = np.sqrt(sum(v * v for _, v in plain_runs(a)) * sum(v * v for _, v in plain_runs(b)))
        return sum(v * table.get(h, 0.0) for h, v in plain_runs(a)) / norm

    got = kernel(parts, parts)
    assert np.allclose(got, [[plain(a, b) for b in parts] for a in parts], atol=1e-5)
    assert got[0, 1] > 3 * got[0, 2]


def test_codes_pass_over_signs_and_close_spaced_letters():
    plain = coded("x idiot y").tobytes()
    for text in ("x i-d-i-o-t y", "x 1d10t y", "x ÍDIÓT! y".replace("!", ","), "x i.d.i.o.t, y", "x  idiot - y", "x \U0001d55a\U0001d555\U0001d55a\U0001d560\U0001d565 y"):
        assert coded(text).tobytes() == plain
    assert coded("word i d i o t end").tobytes() == coded("word idiot end").tobytes()
    assert coded("word a b end").tobytes() != coded("word ab end").tobytes()
    assert coded("").tolist() == coded(" .\n ").tolist() == [10]
    assert sentences("One two. Three\nfour! \U0001f600 Пять。шесть...") == ["one two", "three", "four", "пять", "шесть"]
    assert sentences(None) == sentences("") == sentences("?! 9") == []
    assert windows("go far away") == ["away", "far", "far away", "go far"]


def test_text_values_equal_a_listing_of_windows():
    rng = np.random.default_rng(5)
    weights = rng.normal(size=1 << BITS).astype(np.float32)
    texts = [prose(1, 50), "a", "a b", "One. Two three, four\nfive i d i o t. Ж ш", "x" * 300, "word " * 40 + "\u00df \U0001d41a end."]
    for text in texts:
        want = [plain_value(w, weights) + 0.25 for w in plain_windows(text)]
        worst, count = text_value(text, weights, 0.25)
        assert worst == pytest.approx(max([-1.0, *want]), abs=1e-3) and count == sum(v > 0 for v in want)
        bags = sentences(text)
        for bag, (value, window) in zip(bags, worst_windows(bags, weights), strict=True):
            assert value == pytest.approx(max(plain_value(w, weights) for w in plain_windows(bag)), abs=1e-3)
            assert value == pytest.approx(plain_value(window, weights), abs=1e-3)


def test_pieces_of_long_texts_share_a_word(monkeypatch):
    rng = np.random.default_rng(6)
    weights = rng.normal(size=1 << BITS).astype(np.float32)
    for seed in range(8):
        text = prose(seed, 60)
        whole = text_value(text, weights, -1.0)
        for piece in (20, 64, 200):  # longer than any word
            monkeypatch.setattr("corpusflow.llm.toxicity.PIECE", piece)
            worst, count = text_value(text, weights, -1.0)
            assert worst == pytest.approx(whole[0], abs=1e-4) and count == whole[1]
        monkeypatch.undo()


def test_svm_reaches_the_least_loss():
    rng = np.random.default_rng(7)
    x = np.c_[rng.normal(size=(400, 3)), np.ones(400)].astype(np.float32)
    y = np.where(x[:, 0] + 0.5 * x[:, 1] + 0.3 * rng.normal(size=400) > 0.4, 1.0, -1.0)
    got = squared_hinge_svm([(x[y < 0], -1.0), (x[y > 0], 1.0)], 2.0, steps=50)
    ridge = np.array([1, 1, 1, 1e-3])
    w = np.zeros(4)
    for _ in range(20_000):  # plain gradient descent
        short = np.maximum(1 - y * (x @ w), 0)
        w -= 2e-4 * (ridge * w - 2.0 * x.T @ (y * short))
    assert np.allclose(got, w, atol=1e-2)


def test_weights_from_windows_and_sentences():
    rng = np.random.default_rng(4)
    word = lambda: "".join(chr(97 + c) for c in rng.integers(0, 26, int(rng.integers(4, 9))))
    clean = sorted({word() for _ in range(300)} | {"take", "hike"})
    bags = [" ".join(rng.choice(clean, 6)) for _ in range(200)]
    clean = sorted({*clean, *(f"take {w}" for w in clean[:40]), *(f"{w} hike" for w in clean[:40])})  # words of clean sentences
    insults = ["idiot", "trottel", "cretin", "take hike", "дурак"]
    suspects = [(i, insults[i % 5], 100.0) for i in range(50)] + [(i, word()[::-1] + "q", 2.0) for i in range(50)]
    weights, bias = train_windows(clean, bags, suspects)
    value = lambda text: text_value(text, weights, bias)[0]
    assert min(map(value, ("idiot", "you idiots", "i d i o t", "id1ot", "idixot", "tr-ottel", "cretin!", "please take hike now", "ты дурак"))) > 0
    assert max(map(value, ("take", "hike", "take. Hike"))) < 0  # only together, in one sentence
    assert np.mean([value(w) > 0 for w in clean]) < 0.02 and np.mean([value(b) > 0 for b in bags]) < 0.05
    long = "word " * 300_000 + "idiot"
    assert text_value(long, weights, bias)[0] == pytest.approx(value("word idiot"), abs=1e-4)
    assert text_value(None, weights, bias) == text_value("", weights, bias) == (-1.0, 0)


def test_toxicity_held_out(spark):
    found = queries.QUERIES["op10_toxicity"](spark, DATA)
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = found.where("held_out").join(labels, "doc_id").select("score", "predicted", "toxic").toPandas()
    # some 250 toxic documents to fit here, a few dozen for each language; with 1,500 all are found
    assert rows.predicted[rows.toxic == 1].mean() > 0.85
    assert rows.predicted[rows.toxic == 0].mean() < 0.03


def test_toxicity_of_awkward_rows(spark):
    ship_package(spark)
    rows = [*awkward_rows(), *[(400 + i, prose(400 + i, 60) + " you idiot " + prose(500 + i, 20), "en", "a") for i in range(40)]]
    rows += [(600 + i, prose(600 + i, 80), "en", "a") for i in range(60)]
    docs = docs_frame(spark, rows)
    labels = [(400 + i, 1) for i in range(36)] + [(600 + i, 0) for i in range(50)] + [(3, 0), (None, 1), (1, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    found = score_toxicity(docs, train_toxicity(docs, labels), ["doc_id"]).collect()
    assert len(found) == len(rows)
    assert {r.doc_id for r in found if r.predicted} == {400 + i for i in range(40)}
    kept = drop_toxic(docs, labels)
    assert kept.columns == docs.columns and kept.count() == len(rows) - 40
    flat = train_toxicity(docs, labels.where("toxic = 0"))
    assert score_toxicity(docs, flat, ["doc_id"]).agg(F.max("score")).first()[0] < 0.01
    assert score_toxicity(docs.where("false"), flat, ["doc_id"]).count() == 0
