from __future__ import annotations

import pytest

import __spark_entry__ as entry
from compare import differences, sql_result
from corpusflow.plans import catalog

DATA = "/root/testdata/sf0.001"


def test_entry(spark):
    rows = {r.split: r.tokens for r in entry.entry(spark).collect()}
    total = sum(rows.values())
    assert rows["train"] == int(total * 0.9)


def test_every_query_has_its_sql():
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_agrees_with_sql(spark, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    assert len(got)
    assert differences(got, sql_result(DATA, entry.oracle_sql()[name])) is None
