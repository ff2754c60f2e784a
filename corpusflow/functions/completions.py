"""Splitting a completion into prompt and quoted answer."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def prompt_line(text: str | Column) -> Column:
    """First line of a completion."""
    return F.element_at(F.split(text, "\n"), 1)


def quoted_answer(text: str | Column) -> Column:
    """The lines after the first as a block quote; a single line gives ``'> '``."""
    lines = F.split(text, "\n")
    rest = F.slice(lines, F.lit(2), F.greatest(F.size(lines) - 1, F.lit(0)))
    return F.concat(F.lit("> "), F.array_join(rest, "\n> "))


def split_completion(df, text: str = "text"):
    """Add ``prompt`` and ``formatted`` to a table of completions."""
    return df.withColumns({"prompt": prompt_line(text), "formatted": quoted_answer(text)})
