"""Repeatable pseudo-random numbers from keys, the same under any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: 15 hexadecimal digits hold 60 bits, which fit a signed BIGINT.
HASH_SPAN = 16**15


def hash60(*parts: Column) -> Column:
    """First 15 hex digits of md5 over the parts joined by ':', as BIGINT."""
    text = F.concat_ws(":", *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def hash_uniform(*parts: Column) -> Column:
    """Value in [0, 1) derived from the parts."""
    return hash60(*parts).cast("double") / F.lit(float(HASH_SPAN))
