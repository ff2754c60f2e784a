"""Joins on keys that may be NULL."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, functions as F


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys meet NULL keys; the columns are those of ``using`` joins."""
    names = {k: f"_right_{k}" for k in keys}
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(n)) for k, n in names.items()])
    return left.join(right.withColumnsRenamed(names), same, how).drop(*names.values())
