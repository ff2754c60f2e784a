"""NULL keys, NaN values, missing array elements, repeated keys and short pages."""

from __future__ import annotations

import math
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusflow.functions.lists import array_histogram, array_mean, array_total
from corpusflow.functions.nested import flatten_maps
from corpusflow.operators.ngram import fit_ngram
from corpusflow.operators.runlog import adjust_log_interval, average_metrics, ema, ema_segment, histogram, metrics_long, timer_totals
from corpusflow.operators.scan import number_rows
from corpusflow.operators.splits import split_contiguous
from corpusflow.ship import ship_package


def test_numbering_keeps_rows_of_null_groups(spark):
    rows = [("a", 3), (None, 1), ("a", 1), (None, 2), (None, None)]
    got = number_rows(spark.createDataFrame(rows, "run string, at int"), ["run"], ["at"]).collect()
    assert sorted(((r.run, r.at, r.iter) for r in got), key=str) == sorted([("a", 1, 0), ("a", 3, 1), (None, None, 0), (None, 1, 1), (None, 2, 2)], key=str)


def test_numbering_rejects_repeated_keys(spark):
    with pytest.raises(Exception, match="not unique"):
        number_rows(spark.createDataFrame([("a", 1), ("a", 1)], "run string, at int"), ["run"], ["at"]).collect()


def test_intervals_and_histograms_keep_null_groups(spark):
    frame = spark.createDataFrame([(None, 0, 1.0), (None, 1, 2.0), ("a", 0, 5.0)], "run_id string, iter int, v double")
    assert adjust_log_interval(frame, 100).count() == 3
    assert sum(r.cnt for r in histogram(frame, "v", 4, ["run_id"]).collect()) == 3


def test_split_rejects_null_keys(spark):
    frame = spark.createDataFrame([(1, "aa"), (None, "ccc"), (2, "bb")], "doc_id long, text string")
    with pytest.raises(ValueError, match="null"):
        split_contiguous(frame, 0.5)


def test_missing_elements_are_skipped(spark):
    frame = spark.createDataFrame([("r", [1.0, None, 3.0]), ("r", [5.0]), ("r", None), ("r", [None])], "run_id string, dt array<double>")
    assert [(r.t, r.m) for r in frame.select(array_total("dt").alias("t"), array_mean("dt").alias("m")).collect()] == [(4.0, 2.0), (5.0, 5.0), (None, None), (0.0, None)]
    row = timer_totals(frame, ["run_id"], ["dt"]).first()
    assert (row.dt_tot, row.dt_avg) == (9.0, 3.0)
    assert [r.value for r in average_metrics(frame, ["run_id"]).collect()] == [3.0]


def recurrence(values, alpha, start=None):
    out, now = [], start
    for v in values:
        if v is None:
            out.append(None)
            continue
        now = v if now is None else (1 - alpha) * now + alpha * v
        out.append(now)
    return out


def check_ema(spark, values, alpha):
    frame = spark.createDataFrame([("r", i, v) for i, v in enumerate(values)], "run_id string, iter long, loss double")
    got = [r.ema for r in ema(frame, alpha=alpha).orderBy("iter").collect()]
    for g, w in zip(got, recurrence(values, alpha), strict=True):
        assert (g is None) == (w is None) and (w is None or (math.isnan(w) and math.isnan(g)) or g == pytest.approx(w, rel=1e-9)), (g, w)


@pytest.mark.parametrize("alpha", [0.9, 0.999999, 1 - 1e-15, 0.1])
@pytest.mark.parametrize("odd", [float("nan"), float("inf"), float("-inf")])
def test_average_never_forgets_what_is_not_finite(spark, alpha, odd):
    values = [odd, *np.random.default_rng(1).normal(size=700).tolist()]
    values[50] = None
    check_ema(spark, values, alpha)
    check_ema(spark, [1.0, 2.0, *values[:90]], alpha)


@pytest.mark.parametrize("alpha", [1e-5, 0.003, 0.5])
def test_average_over_many_segments(spark, alpha):
    values = (np.random.default_rng(2).normal(size=20_000) + 5).tolist()
    check_ema(spark, values, alpha)
    assert 1 <= ema_segment(math.log1p(-alpha)) <= 4096


def test_histograms_take_linear_time(spark):
    ship_package(spark)
    seconds = []
    for n in (20_000, 200_000):
        frame = spark.range(8).selectExpr(f"transform(sequence(1, {n}), i -> double(hash(i, id) % 1000)) AS v")
        frame.select(array_histogram("v").alias("h")).collect()
        begin = time.time()
        rows = frame.select(array_histogram("v").alias("h")).collect()
        seconds.append(time.time() - begin)
        assert all(sum(r.h.counts) == n for r in rows)
    assert seconds[1] < 20 * max(seconds[0], 0.2)
    frame = spark.createDataFrame([([1.0, None, 2.0, float("nan")],), ([],), (None,), ([None],)], "v array<double>")
    got = [r.h for r in frame.select(array_histogram("v", 2).alias("h")).collect()]
    assert got[0].counts == [1, 1] and (got[0].low, got[0].high) == (1.0, 2.0) and got[1:] == [None] * 3


def test_ngrams_reject_pages_too_short_for_their_context(spark):
    ship_package(spark)
    pages = spark.createDataFrame([("train", i, [i]) for i in range(5)], "split string, page long, ids array<int>")
    with pytest.raises(Exception, match="pages of 2 ids"):
        fit_ngram(pages, 3).collect()
    assert fit_ngram(pages, 2).count() == 4
    last = spark.createDataFrame([("train", 0, [1, 2]), ("train", 1, [3])], "split string, page long, ids array<int>")
    assert [tuple(r) for r in fit_ngram(last, 3).collect()] == [(1 * 65536 + 2, 3, 1)]


def test_dataset_folders(spark, tmp_path):
    from corpusflow.sources.dataset import read_dataset

    rows = spark.createDataFrame([(i, "train" if i % 3 else "test") for i in range(30)], "n int, split string")
    for split in ("train", "test"):
        rows.where(F.col("split") == split).select("n").write.parquet(f"{tmp_path}/folders/{split}")
    rows.select("n").repartition(3).write.parquet(f"{tmp_path}/plain")
    rows.write.partitionBy("split").parquet(f"{tmp_path}/keyed")
    found = lambda name: {(r.n, r.split) for r in read_dataset(spark, name, str(tmp_path)).collect()}
    want = {(r.n, r.split) for r in rows.collect()}
    assert found("folders") == want and found("keyed") == want
    assert found("plain") == {(n, "train") for n, _ in want}


def test_scratch_is_cleared(spark):
    from corpusflow.scratch import clear_scratch, path_exists, stored

    kept = stored(spark.range(3), "few").inputFiles()[0].rsplit("/", 1)[0]
    assert path_exists(spark, kept) and clear_scratch(spark) > 0
    assert not path_exists(spark, kept) and clear_scratch(spark) == 0


def test_maps_become_columns(spark):
    rows = [(1, {"a": 1, "b c": None}, {"k": {"z": 2.0}}), (2, None, {}), (3, {}, {"k": None, "l/m": {"z": 5.0}})]
    frame = spark.createDataFrame(rows, "id int, m map<string,int>, n map<string,map<string,double>>")
    flat = flatten_maps(frame.select("id", F.struct("m").alias("s"), "n"))
    assert flat.columns == ["id", "s/m/a", "s/m/b c", "n/k/z", "n/l/m/z"]
    assert sorted(map(tuple, flat.collect())) == [(1, 1, None, 2.0, None), (2, None, None, None, None), (3, None, None, None, 5.0)]
    numbered = spark.createDataFrame([(1, {7: "x", 8: "y"})], "id int, m map<int,string>")
    assert flatten_maps(numbered).first().asDict() == {"id": 1, "m/7": "x", "m/8": "y"}
    with pytest.raises(ValueError, match="more than 1 keys"):
        flatten_maps(numbered, most=1)
    with pytest.raises(ValueError, match="twice"):
        flatten_maps(numbered.withColumn("m/7", F.lit(1)))
    assert flatten_maps(frame.where("false")).columns == ["id"]


def test_array_metrics_are_histograms(spark):
    frame = spark.createDataFrame([(1, 0, [0.0, 1.0, 4.0, None]), (1, 1, []), (1, 2, None), (1, 3, [2.0])], "run_id int, iter int, dt array<double>")
    long = {(r.iter, r.key): r.value for r in metrics_long(frame, {"Timing": ["dt"]}, bins=2).collect()}
    assert len(long) == 16
    assert [long[0, k] for k in ("dt/low", "dt/high", "dt/0", "dt/1")] == [0.0, 4.0, 2.0, 1.0]
    assert [long[3, k] for k in ("dt/low", "dt/high", "dt/0", "dt/1")] == [1.5, 2.5, 0.0, 1.0]
    assert {long[i, k] for i in (1, 2) for k in ("dt/low", "dt/high", "dt/0", "dt/1")} == {None}
