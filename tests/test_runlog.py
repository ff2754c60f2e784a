from __future__ import annotations

import datetime as dt
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusflow.functions import metrics, nested
from corpusflow.functions.completions import split_completion
from corpusflow.functions.lists import array_histogram
from corpusflow.operators import runlog
from corpusflow.operators.runlog import step_dt
from corpusflow.sinks.tables import append_registry, write_run_metrics


def log_of(spark, values, run=1):
    start = dt.datetime(2024, 1, 1)
    rows = [(run, i, start + dt.timedelta(seconds=i * i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "run_id bigint, iter bigint, ts timestamp, loss double")


@pytest.mark.parametrize("alpha", [0.1, 0.5, 0.9])
def test_ema_over_several_segments_and_levels(spark, alpha):
    draw = random.Random(7)
    long, short = [draw.uniform(-5, 1e6) for _ in range(3000)], [1.5]
    log = log_of(spark, long).unionByName(log_of(spark, short, run=2)).repartition(5)
    got = {(r.run_id, r.iter): r.ema for r in runlog.ema(log, alpha=alpha, bits=7).collect()}
    for run, values in ((1, long), (2, short)):
        want = pd.Series(values).ewm(alpha=alpha, adjust=False).mean()
        assert [got[run, i] for i in range(len(values))] == pytest.approx(want.tolist(), rel=1e-12)


def test_ema_skips_missing_values_and_gaps_between_iterations(spark):
    values = [None, 4.0, None, 8.0, 2.0]
    log = log_of(spark, values).withColumn("iter", F.col("iter") * 10)
    got = [r.ema for r in runlog.ema(log).orderBy("iter").collect()]
    assert got == pytest.approx([None, 4.0, None, 4.4, 4.16])


def test_ema_from_an_initial_value(spark):
    log = log_of(spark, [10.0, 20.0]).withColumn("start", F.lit(0.0))
    assert [r.ema for r in runlog.ema(log, initial="start").orderBy("iter").collect()] == pytest.approx([1.0, 2.9])
    assert runlog.ema(log, initial="start").columns == log.columns + ["ema"]


def test_step_dt(spark):
    log = log_of(spark, [0.0] * 40).unionByName(log_of(spark, [0.0], run=2))
    got = {(r.run_id, r.iter): r.dt for r in runlog.step_dt(log, bits=3).collect()}
    assert got[1, 0] is None and got[2, 0] is None
    assert all(got[1, i] == 2 * i - 1 for i in range(1, 40))


def test_best_so_far(spark):
    values = [3.0, 5.0, 2.0, 2.0, None, 1.0]
    evals = log_of(spark, values).withColumnRenamed("loss", "val")
    got = [(r.best, r.save) for r in runlog.best_so_far(evals, bits=1).orderBy("iter").collect()]
    assert got == [(1e9, False), (3.0, False), (3.0, True), (2.0, False), (2.0, False), (2.0, True)]
    always = [r.save for r in runlog.best_so_far(evals, always=True).orderBy("iter").collect()]
    assert always == [False] + [True] * 5


def test_log_intervals(spark):
    log = log_of(spark, [0.0] * 50).unionByName(log_of(spark, [0.0] * 200, run=2)).unionByName(log_of(spark, [0.0] * 5, run=3))
    rows = runlog.logged_steps(log, 100).collect()
    assert {(r.run_id, r.log_interval) for r in rows} == {(1, 2), (2, 100), (3, 1)}
    assert {r.iter for r in rows if r.run_id == 2} == {0, 100}
    assert runlog.first_iters(log, 3).count() == 9
    assert runlog.every_n(log.where("run_id = 1"), 25).count() == 2


def test_learning_rate(spark):
    def reference(it, lr, low, warm, decay):
        if it < warm:
            return lr * it / warm
        if it > decay:
            return low
        return low + 0.5 * (1 + math.cos(math.pi * (it - warm) / (decay - warm))) * (lr - low)

    df = spark.range(30)
    for warm, decay in ((5, 20), (0, 10)):
        got = [r[0] for r in df.select(metrics.lr_at("id", 6e-4, 6e-5, warm, decay)).collect()]
        assert got == pytest.approx([reference(i, 6e-4, 6e-5, warm, decay) for i in range(30)], rel=1e-12)


def test_throughput_and_utilisation(spark):
    shape = metrics.BatchShape(gas=5, world=8, batch=12, block=1024)
    assert (shape.tokens_per_iter, shape.samples_per_iter) == (491_520, 40)
    df = spark.createDataFrame([(2.0,), (0.0,), (None,)], "dt double")
    rows = df.select(*[c.alias(n) for n, c in metrics.throughput("dt", shape).items()]).collect()
    assert rows[0].asDict() == {
        "tokens_per_sec": 245_760.0,
        "samples_per_sec": 20.0,
        "tokens_per_sec_per_gpu": 30_720.0,
        "samples_per_sec_per_gpu": 2.5,
    }
    assert set(rows[1].asDict().values()) == set(rows[2].asDict().values()) == {None}
    model = metrics.ModelShape(vocab_size=50257, bias=True)
    assert model.parameters() == 123_653_376
    per_token = 6 * 123_653_376 + 12 * 12 * 12 * 64 * 1024
    assert df.select(metrics.mfu("dt", model, 60)).first()[0] == pytest.approx(per_token * 1024 * 60 / 2 / 312e12)


def test_timers(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], [0.5]), (1, [3.0], []), (2, [4.0], [1.0])], "run_id int, dt array<double>, dtf array<double>")
    rows = [(r.dt_tot, r.dt_avg, r.dtf_tot, r.dtf_avg) for r in runlog.timer_summary(df, ["dt", "dtf"]).collect()]
    assert rows == [(3.0, 1.5, 0.5, 0.5), (3.0, 3.0, 0.0, None), (4.0, 4.0, 1.0, 1.0)]
    total = runlog.timer_totals(df, timers=["dt", "dtf"]).where("run_id = 1").first()
    assert (total.dt_tot, total.dt_avg, total.dtf_tot, total.dtf_avg) == (6.0, 2.0, 0.5, 0.5)


def test_average_metrics(spark):
    rows = [(1, 1.0, (10, None), [1.0, 3.0]), (1, None, (20, None), [5.0]), (2, 3.0, (None, None), [])]
    df = spark.createDataFrame(rows, "run int, loss double, t struct<dt: int, none: double>, arr array<double>")
    assert {r.key: r.value for r in runlog.average_metrics(df.drop("run")).collect()} == {"loss": 2.0, "t/dt": 15.0, "arr": 3.0}
    per_run = {(r.run, r.key): r.value for r in runlog.average_metrics(df, by=["run"]).collect()}
    assert per_run == {(1, "loss"): 1.0, (1, "t/dt"): 15.0, (1, "arr"): 3.0, (2, "loss"): 3.0}


@pytest.mark.parametrize("values", [[1.0], [2.0, 2.0], np.arange(0, 1.01, 0.1).tolist(), [0.1 * i for i in range(64)], [-3.5, 7.25, 0.0, 7.25]])
def test_histograms_match_numpy(spark, values):
    for bins in (4, 10, 64):
        counts, edges = np.histogram(values, bins=bins)
        one = spark.createDataFrame([(values,)], "v array<double>").select(array_histogram("v", bins).alias("h")).first().h
        assert one.counts == counts.tolist()
        assert (one.low, one.high) == (edges[0], edges[-1])
        flat = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
        for by in ((), ("g",)):
            got = {r.bin: r.cnt for r in runlog.histogram(flat, "v", bins, by).collect()}
            assert got == {i: c for i, c in enumerate(counts.tolist()) if c}


def test_epochs_and_mean_loss(spark):
    totals = spark.createDataFrame([("train", 301_966)], "split string, tokens bigint")
    assert runlog.epoch_iters(totals, 32_768).first().iters == pytest.approx(9.2, abs=0.02)
    losses = spark.createDataFrame([("val", 1.0), ("val", 2.0), ("train", 5.0)], "split string, loss double")
    assert {r.split: r.loss for r in runlog.mean_loss(losses).collect()} == {"val": 1.5, "train": 5.0}


def test_metrics_long_written_and_read(spark, tmp_path):
    wide = log_of(spark, [1.0, None]).withColumn("dt", F.lit(0.5))
    long = runlog.metrics_long(wide, {"Training": ["loss"], "Timing": ["dt"]})
    path = str(tmp_path / "metrics")
    write_run_metrics(long, path)
    write_run_metrics(long, path)
    rows = [(r.iter, r.grp, r.key, r.value) for r in spark.read.parquet(path).collect()]
    once = [(0, "Training", "loss", 1.0), (1, "Training", "loss", None), (0, "Timing", "dt", 0.5), (1, "Timing", "dt", 0.5)]
    assert sorted(rows, key=str) == sorted(once * 2, key=str)
    append_registry(spark.createDataFrame([("a",)], "path string"), str(tmp_path / "reg"))
    append_registry(spark.createDataFrame([("b",)], "path string"), str(tmp_path / "reg"))
    assert {r.path for r in spark.read.parquet(str(tmp_path / "reg")).collect()} == {"a", "b"}


def test_flatten_struct(spark):
    df = spark.createDataFrame([(1, ((2, "x"), 3))], "a int, b struct<c: struct<d: int, `e.f`: string>, g: int>")
    flat = nested.flatten_struct(df)
    assert flat.columns == ["a", "b/c/d", "b/c/e.f", "b/g"]
    assert tuple(flat.first()) == (1, 2, "x", 3)
    assert nested.flatten_struct(df, ".").columns[1] == "b.c.d"
    empty = df.withColumn("none", F.struct())
    assert nested.flatten_struct(empty).columns == flat.columns


def test_json_round_trip(spark):
    rows = [(1, dt.datetime(2024, 1, 1, 2, 3, 4, 567891), None, [1.5], {"k": 2}, ("/tmp/x", True))]
    schema = "i int, t timestamp, n string, a array<double>, m map<string,int>, s struct<path: string, b: boolean>"
    df = spark.createDataFrame(rows, schema)
    assert '"n":null' in nested.rows_to_json(df).first().json
    assert nested.json_to_rows(nested.rows_to_json(df), df.schema).collect() == df.collect()


def test_split_completion(spark):
    df = spark.createDataFrame([("one",), ("p\nl1\nl2",), ("",), ("p\n",)], "text string")
    got = [(r.prompt, r.formatted) for r in split_completion(df).collect()]
    assert got == [("one", "> "), ("p", "> l1\n> l2"), ("", "> "), ("p", "> ")]


@pytest.mark.parametrize("bits", [1, 3, 16])
def test_times_of_dense_steps_take_one_exchange(spark, bits):
    rows = [(run, i, float(3 * i * i + k)) for k, run in enumerate(["a", "b", None]) for i in range(20 if k else 33)]
    log = spark.createDataFrame(rows, "run_id string, iter bigint, s double").withColumn("ts", F.timestamp_seconds("s"))
    timed = step_dt(log.repartition(4), bits=bits, dense=True)
    got = {(r.run_id, r.iter): r.dt for r in timed.collect()}
    assert got == {(run, i): None if i == 0 else float(3 * (2 * i - 1)) for run, i, _ in rows}
    plan = step_dt(log, bits=bits, dense=True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Join" not in plan
    with pytest.raises(Exception, match="no single row before"):
        step_dt(log.where("iter <> 7"), bits=bits, dense=True).collect()
