from __future__ import annotations

import numpy as np
import pytest

from corpusflow.llm.outliers import P, chi_square_cdf, chi_square_quantile, consistency, outliers, robust_estimates, text_statistics
from llm_helpers import awkward_rows, docs_frame, prose, statistics


def test_chi_square():
    assert chi_square_cdf(chi_square_quantile(0.75, 5), 5) == pytest.approx(0.75)
    assert chi_square_quantile(0.95, 5) == pytest.approx(11.0705, abs=1e-3)
    assert chi_square_quantile(0.95, 1) == pytest.approx(3.8415, abs=1e-3)
    assert consistency(0.999999, 5) == pytest.approx(1, abs=1e-3) and consistency(0.5, 5) > 1.5


def test_statistics_equal_brute_force(spark):
    texts = [t for _, t, _, _ in awkward_rows()] + ["a a a a a a", "a b c a b c x a b c", "x\nx\n\n \nx\ny", "a b", "a b c", "#|| <x>\x1c\x1cw\x0bz"]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)]
    got = text_statistics(docs_frame(spark, rows), ["doc_id"]).collect()
    assert {tuple(r) for r in got} == {(i, *statistics(t)) for i, t in enumerate(texts)}


def brute_estimates(x, share, steps, floors, bins=64):
    """Concentration steps in numpy for one group, from the same two starts."""
    n = len(x)
    q25, q50, q75 = np.percentile(x, [25, 50, 75], axis=0)
    starts = [(q50, np.diag(((q75 - q25) / 1.349) ** 2)), (x.mean(0), np.cov(x.T, bias=True))]
    best = None
    for mean, cov in starts:
        for _ in range(steps):
            off = x - mean
            d = np.einsum("ij,jk,ik->i", off, np.linalg.inv(cov + floors), off)
            b = np.floor(np.log1p(d) * bins)
            core = x[b <= np.sort(b)[int(np.ceil(n * share)) - 1]]
            mean, cov = core.mean(0), np.cov(core.T, bias=True) * consistency(share, P)
        det = np.linalg.slogdet(cov + floors)[1]
        if best is None or det < best[0] - 1e-9:
            best = det, mean, np.linalg.inv(cov + floors)
    return best[1], best[2]


def test_estimates_equal_numpy_and_resist_a_quarter_of_outliers(spark):
    from corpusflow.llm.outliers import FLOORS, GRID

    rng = np.random.default_rng(1)
    mix = rng.normal(size=(P, P)) * 400
    clean = rng.normal(size=(600, P)) @ mix
    wild = rng.normal(size=(150, P)) * 50 + 20_000
    x = np.round(np.r_[clean, wild]).astype(int)
    frame = spark.createDataFrame([("g", *map(int, r)) for r in x], "g string, " + ", ".join(f"q{i} long" for i in range(P)))
    row = robust_estimates(frame.repartition(7), 0.75, 4).first()
    mean, inverse = brute_estimates(x.astype(float), 0.75, 4, np.diag([(f * GRID) ** 2 for f in FLOORS.values()]))
    assert row.n == len(x)
    assert np.allclose([row[f"m{i}"] for i in range(P)], mean)
    assert np.allclose([row[f"i{i}_{j}"] for i in range(P) for j in range(i + 1)], [inverse[i, j] for i in range(P) for j in range(i + 1)])
    assert np.abs(mean - clean.mean(0)).max() < 200  # far from the outliers at 20,000


def test_verdicts(spark):
    rows = [*awkward_rows()]
    rows += [(100 + i, prose(100 + i, 120 + i % 90), "en", "s" if i % 3 else "t") for i in range(240)]
    rows += [(900 + i, " ".join(w + "###" for w in prose(900 + i, 150).split()), "en", "s") for i in range(10)]
    rows += [(950, prose(950, 100), "xx", None)]  # a group of its own takes the corpus estimate
    found = outliers(docs_frame(spark, rows)).collect()
    assert len(found) == len(rows)
    by_id = {r.doc_id: r for r in found}
    assert all(by_id[100 + i].kept for i in range(240)) and by_id[950].kept and by_id[950].distance is not None
    assert not any(by_id[900 + i].kept or by_id[900 + i].base_failed for i in range(10))
    assert all(not r.kept for r in found if r.base_failed) and by_id[3].base_failed


def test_small_and_empty_tables_reject_nobody_by_distance(spark):
    few = outliers(docs_frame(spark, [(1, prose(1, 90), "en", "a"), (2, "#| " * 90 + prose(2, 200), None, None)])).collect()
    assert [r.distance for r in few] == [None, None] and {r.kept for r in few} == {True}
    assert outliers(docs_frame(spark, [])).count() == 0
