"""Flattening nested columns and rows as JSON."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Keep the microseconds that the default formats cut off.
JSON_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def _quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _leaves(schema: T.StructType, path: tuple[str, ...]) -> Iterator[tuple[str, ...]]:
    for field in schema.fields:
        here = (*path, field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, here)
        else:
            yield here


def flatten_struct(df: DataFrame, sep: str = "/") -> DataFrame:
    """Nested structs to plain columns named ``a/b``; a struct without fields vanishes."""
    columns: list[Column] = []
    for path in _leaves(df.schema, ()):
        columns.append(F.col(".".join(_quote(p) for p in path)).alias(sep.join(path)))
    return df.select(*columns)


def map_keys(df: DataFrame, column: str, most: int = 1000) -> list[str]:
    """The keys of a MAP column, sorted: an aggregate of the different ones, ``most`` of them at most."""
    each = df.select(F.explode(F.map_keys(F.col(_quote(column)))).alias("key"))
    found = each.select(F.col("key").cast("string").alias("key")).distinct().limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} keys: not a set of columns")
    return sorted(row["key"] for row in found)


def flatten_maps(df: DataFrame, sep: str = "/", most: int = 1000) -> DataFrame:
    """Structs and MAP columns to plain columns: every key of a map becomes ``a/key``.

    Keys are looked up in the data, so this runs a job per map column.  A row whose map is
    null or lacks a key gets NULL.  Maps inside maps are flattened in turn.  Keys that give
    a name twice fail.
    """
    flat = flatten_struct(df, sep)
    maps = [f.name for f in flat.schema.fields if isinstance(f.dataType, T.MapType)]
    if not maps:
        return flat
    columns: list[Column] = []
    for field in flat.schema.fields:
        whole = F.col(_quote(field.name))
        if field.name in maps:
            kind = field.dataType.keyType
            columns += [F.try_element_at(whole, F.lit(key).cast(kind)).alias(f"{field.name}{sep}{key}") for key in map_keys(flat, field.name, most)]
        else:
            columns.append(whole)
    out = flat.select(*columns)
    if len(set(out.columns)) < len(out.columns):
        raise ValueError(f"names occur twice: {sorted(c for c in out.columns if out.columns.count(c) > 1)}")
    return flatten_maps(out, sep, most)


def rows_to_json(df: DataFrame, out: str = "json") -> DataFrame:
    """Every row as one JSON string (null fields kept)."""
    return df.select(F.to_json(F.struct("*"), {**JSON_FORMATS, "ignoreNullFields": "false"}).alias(out))


def json_to_rows(df: DataFrame, schema: T.StructType, json: str = "json") -> DataFrame:
    """Inverse of :func:`rows_to_json`; a string that does not parse fails the job."""
    parsed = F.from_json(json, schema, {**JSON_FORMATS, "mode": "FAILFAST"})
    return df.select(parsed.alias("row")).select("row.*")
