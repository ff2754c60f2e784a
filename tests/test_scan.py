from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from corpusflow.operators.scan import exclusive_scan, find_position, number_rows


def rows_for(keys, groups=("a", "b")):
    draw = random.Random(1)
    return [(g, k, draw.randint(-50, 50)) for g in groups for k in keys]


def expected(rows, how):
    out, state = {}, {}
    for g, k, v in sorted(rows):
        before = state.get(g)
        out[g, k] = before if before is not None or how != "sum" else 0
        state[g] = v if before is None else {"sum": before + v, "min": min(before, v), "max": max(before, v)}[how]
    return out


@pytest.mark.parametrize("how", ["sum", "min", "max"])
@pytest.mark.parametrize(
    "keys",
    [range(100), range(-70, 70, 3), [-(2**63), -(2**40), -1, 0, 5, 2**33, 2**62, 2**63 - 1]],
    ids=["dense", "negative", "sparse"],
)
def test_exclusive_scan_over_several_levels(spark, how, keys):
    rows = rows_for(keys)
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint").repartition(3)
    got = exclusive_scan(df, "v", "k", by=["g"], how=how, bits=3).collect()
    assert {(r.g, r.k): r.before for r in got} == expected(rows, how)
    assert len(got) == len(rows)


def test_exclusive_scan_without_groups_and_with_one_level(spark):
    rows = [("a", k, 2) for k in range(10)]
    df = spark.createDataFrame(rows, "g string, k bigint, v bigint")
    assert {r.k: r.before for r in exclusive_scan(df, "v", "k").collect()} == {k: 2 * k for k in range(10)}


def test_exclusive_scan_of_nothing(spark):
    df = spark.createDataFrame([], "g string, k bigint, v bigint")
    assert exclusive_scan(df, "v", "k", by=["g"]).count() == 0


@pytest.mark.parametrize("bits", [2, 16])
@pytest.mark.parametrize("bad", [("a", 3, 1), ("a", None, 1), (None, 3, 1)])
def test_exclusive_scan_refuses_repeated_and_missing_keys(spark, bits, bad):
    df = spark.createDataFrame([("a", k, 1) for k in range(20)] + [bad], "g string, k bigint, v bigint")
    with pytest.raises(Exception, match="ordered scan"):
        exclusive_scan(df, "v", "k", by=["g"], bits=bits).collect()


def test_scan_reads_its_input_once(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    scanned = exclusive_scan(df, "v", "k", bits=6)
    scanned.select("k", "before").write.format("noop").mode("overwrite").save()
    frame = scanned.select("k", "before")
    frame.collect()
    assert "ReusedExchange" in frame._jdf.queryExecution().executedPlan().toString()


def test_number_rows_with_a_large_group_and_equal_keys(spark):
    draw = random.Random(2)
    rows = [("big" if i % 3 else f"s{i % 5}", draw.randint(0, 3), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "run string, ts int, id int").repartition(5)
    got = {(r.run, r.id): r.iter for r in number_rows(df, ["run"], ["ts", "id"]).collect()}
    want = {}
    for run in {r[0] for r in rows}:
        for i, (_, _, key) in enumerate(sorted(r for r in rows if r[0] == run)):
            want[run, key] = i
    assert got == want


def test_find_position_agrees_with_counting(spark):
    draw = random.Random(3)
    keys = sorted(draw.sample(range(-(10**12), 10**12), 60))
    lengths = [draw.choice([0, 1, 5, 9]) for _ in keys]
    df = spark.createDataFrame(list(zip(keys, lengths)), "k bigint, len bigint").repartition(4)
    flat = [(k, i) for k, n in zip(keys, lengths) for i in range(n)]
    for target in (0, 1, len(flat) // 2, len(flat) - 1):
        assert find_position(df, "len", "k", target, bits=5) == flat[target]
    assert find_position(df, "len", "k", len(flat)) is None
    assert find_position(df.where("k is null"), "len", "k", 0) is None
