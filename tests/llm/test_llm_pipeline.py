"""The corpus pipeline, stage by stage, against plain versions."""

from __future__ import annotations

import re
from collections import Counter

import corpus_pipeline
import numpy as np
import pytest
from test_llm_entropy_mix import targets

from corpusflow.llm.queries import fold
from corpusflow.llm.toxicity import THRESHOLD, text_value, train_toxicity
from corpusflow.ship import ship_package
from llm_helpers import awkward_rows, benchmark_hits, docs_frame, fingerprint, near_pairs, prose, roots, space_words

ITEM = prose(70, 40)
BASE = [
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    (re.compile("AKIA[A-Z0-9]+"), 0, 16),
    (re.compile("[0-9a-f]+"), 0, 32),
]


def corpus():
    rows = [*awkward_rows()]
    rows += [(400 + i, prose(400 + i, 60) + " you idiot " + prose(500 + i, 20), "en", "a") for i in range(60)]
    rows += [(600 + i, prose(600 + i, 80), "en", "abc"[i % 3] if i % 2 else "a") for i in range(120)]
    near = prose(80, 400)
    rows += [(800 + k, near + " tail" * (k % 2), "en", "b") for k in range(8)]
    rows += [(820, prose(81, 50) + " " + ITEM + " " + prose(82, 50), "en", "a"), (821, " ".join(ITEM.split()[5:14]) + " end", "en", "a")]
    secret = "password = 'hunter2hunter2' and AKIA" + "Q7" * 8 + " and " + "0123456789abcdef" * 3
    rows += [(830, prose(83, 30) + " " + secret + " " + prose(84, 30), "en", "c"), (831, "token: short, AKIA12", "en", "c")]
    return rows


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables"))
    docs_frame(spark, corpus()).write.parquet(f"{path}/documents.parquet")
    labels = [(400 + i, 1, 0) for i in range(50)] + [(600 + i, 0, 1) for i in range(110)] + [(3, 0, None), (None, 1, 1), (1, None, 0)]
    spark.createDataFrame(labels, "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def plain_near(rows):
    """One of each group of linked fingerprints: the smallest id, null last."""
    root = roots(len(rows), near_pairs([fingerprint(r[1]) for r in rows]))
    best = {}
    for row, at in zip(rows, root, strict=True):
        best[at] = min(best.get(at, row), row, key=lambda r: (r[0] is None, r[0] or 0))
    return list(best.values())


def plain_redacted(text):
    covered = set()
    for pattern, group, least in BASE:
        for m in pattern.finditer(text):
            if len(m[group]) >= least:
                covered |= set(range(*m.span()))
    return "".join("[SECRET]" if i in covered and i - 1 not in covered else "" if i in covered else c for i, c in enumerate(text))


def taken_rows(df):
    return [(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()]


def same(got, want):
    assert Counter(got) == Counter(want)


def test_every_stage_equals_its_plain_version(spark, folder, tmp_path):
    ship_package(spark)
    whole = spark.read.parquet(f"{folder}/documents.parquet")
    stages, docs, kept = dict(corpus_pipeline.STAGES), whole, {}
    for name in stages:
        out = stages[name](spark, docs, folder)
        if name != "mixing":
            assert out.columns == whole.columns
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = docs
    rows = taken_rows(whole)

    labels = spark.read.parquet(f"{folder}/labels.parquet").where(fold(4) != 2)
    model = train_toxicity(whole, labels)
    score = lambda t: model.probability(np.array([text_value(t, model.weights, model.bias)[0]]))[0]
    rows = [r for r in rows if score(r[1]) < THRESHOLD]
    ids = {r[0] for r in rows}
    assert not ids & set(range(400, 460)) and set(range(600, 720)) <= ids
    same(taken_rows(kept["toxicity"]), rows)

    rows = plain_near(rows)
    assert {r[0] for r in rows} & set(range(800, 808)) == {800}
    same(taken_rows(kept["near_copies"]), rows)

    bad = {d for d, *_, hit in benchmark_hits([(r[0], r[1]) for r in rows], [(1, ITEM)]) if hit}
    assert bad == {820}
    rows = [r for r in rows if r[0] not in bad]
    same(taken_rows(kept["decontamination"]), rows)

    rows = [(i, t if t is None else plain_redacted(t), lang, source, n if t is None else len(plain_redacted(t))) for i, t, lang, source, n in rows]
    assert next(r[1] for r in rows if r[0] == 830).count("[SECRET]") == 3
    same(taken_rows(kept["secret_scans"]), rows)

    mix = docs.collect()
    assert {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in mix} <= set(rows) and len(mix) == len({(r.doc_id, r.text) for r in mix})
    sizes, taken = Counter(), Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(space_words(text))
    for r in mix:
        assert 1 <= r.copies <= 3
        taken[r.source] += r.copies * len(space_words(r.text))
    goal = targets(sizes)
    for source in goal:  # a document comes whole or not at all
        largest = max(len(space_words(r[1])) for r in rows if r[3] == source)
        assert abs(taken[source] - goal[source]) <= max(10, largest / 2)

    again = corpus_pipeline.run(spark, folder)
    same([tuple(r) for r in again.select(mix[0].__fields__).collect()], [tuple(r) for r in mix])


def test_empty_tables_give_no_rows(spark, tmp_path):
    docs_frame(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
