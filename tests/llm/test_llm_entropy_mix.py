from __future__ import annotations

import numpy as np

from corpusflow.llm.entropy_mix import mix_documents, mixed, source_targets
from llm_helpers import awkward_rows, docs_frame, space_words


def corpus():
    rng = np.random.default_rng(3)
    rows = [*awkward_rows()]
    for i in range(400):
        source = ["a", "b", "c", "d", "é", "Z", None][int(rng.integers(0, 7)) if i % 3 else 0]
        rows.append((1_000 + i, "w " * int(rng.lognormal(4, 1)), "en", source))
    return rows


def targets(sizes, limit=3):
    """Shares by weight with a ceiling, by bisection on the level."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = dict(zip(names, np.resize([5.0, 2.0, 1.0], len(names)), strict=True))
    low, high = 0.0, 1e12
    for _ in range(300):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(limit * sizes[s], level * weight[s]) for s in names) < sum(sizes.values()) else (low, level)
    return {s: min(limit * sizes[s], high * weight[s]) for s in names}


def test_targets_are_shared_and_capped(spark):
    for sizes in ({"a": 10, "b": 1_000, "c": 5, "d": 0, None: 50}, {"a": 0, "b": 0}, {"x": 7}, {"a": 1, "b": 1, "c": 100_000}):
        frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r.source: r.target for r in source_targets(frame).collect()}
        want = targets(sizes)
        assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_the_mix_meets_its_targets_and_repeats(spark):
    rows = corpus()
    docs = docs_frame(spark, rows)
    found = mixed(docs).collect()
    assert len(found) == len(rows)
    sizes, taken, goal = {}, {}, {}
    for r in found:
        assert 0 <= r.copies <= 3 and r.taken == r.copies * r["size"]
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        goal[r.source] = r.target
    assert all(r.source_size == sizes[r.source] for r in found)
    want = targets(sizes)
    assert all(abs(goal[s] - want[s]) < 1e-6 for s in want)
    # nearly all of "c" is one document, which comes whole or not at all
    assert all(abs(taken[s] - goal[s]) <= (15_000 if s == "c" else max(10, 0.005 * goal[s])) for s in goal)
    order = lambda rs: sorted((tuple(r) for r in rs), key=str)
    assert order(found) == order(mixed(docs.repartition(5)).collect())
    by_id = {i: len(space_words(t)) for i, t, _, _ in rows if i is not None and i != 9}
    assert all(by_id[r.doc_id] == r["size"] for r in found if r.doc_id in by_id)


def test_rates_are_exponential_in_size(spark):
    rows = [(i, "w " * (10 + i % 50), "en", "a") for i in range(3_000)] + [(9_000 + i, "w " * 40, "en", "b") for i in range(500)]
    found = mixed(docs_frame(spark, rows)).where("source = 'a'").groupBy("size").agg({"copies": "avg"}).collect()
    rates = {r["size"]: r["avg(copies)"] for r in found if 0.1 < r["avg(copies)"] < 2.9}
    size = np.array(sorted(rates))
    slope, shift = np.polyfit(size, np.log([rates[s] for s in size]), 1)
    assert abs(shift) < 0.1 and np.abs(np.log([rates[s] for s in size]) - slope * size - shift).max() < 0.1


def test_mixed_documents_carry_their_copies(spark):
    rows = [r for r in corpus()]
    docs = docs_frame(spark, rows).drop("copies")
    out = mix_documents(docs)
    assert set(out.columns) == {*docs.columns, "copies"}
    assert out.agg({"copies": "sum"}).first()[0] == mixed(docs).agg({"copies": "sum"}).first()[0]
    assert mix_documents(docs.where("false")).count() == 0 and mixed(docs.where("false")).count() == 0
