"""Named datasets with splits, and stored vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from corpusflow.functions.subword import Ranks
from corpusflow.operators.encode import Encoder, pick_encoder
from corpusflow.scratch import folder_names, path_exists

# Files may be numbered as NAME-00000-of-00010; Spark's own are part-00000-….
_NUMBERED = r"^(.*?)(-\d+-of-\d+)?(\.[A-Za-z0-9]+)*$"
_SPARK_PART = r"^part-\d{5}"


def read_dataset(
    spark: SparkSession,
    name: str,
    root: str,
    fmt: str = "parquet",
    schema: T.StructType | str | None = None,
) -> DataFrame:
    """``(split, …)`` of the dataset ``{root}/{name}``.

    The split comes from a partition folder ``split=…`` if there is one, else from a
    subfolder (``{name}/train/…``), else from the file name without numbering.  The single
    file ``{name}.{fmt}`` and a folder of Spark's own part files are all training data.
    """
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    path = f"{root.rstrip('/')}/{name}"
    single = path_exists(spark, f"{path}.{fmt}")
    inner = [] if single else [n for n in folder_names(spark, path) if n[0] not in "_." and "=" not in n]
    if inner:
        data = reader.load([f"{path}/{n}" for n in inner])
        parts = F.split("_metadata.file_path", "/")
        split = F.col("split") if "split" in data.columns else F.url_decode(F.element_at(parts, -2))
    else:
        data = reader.load(f"{path}.{fmt}" if single else path)
        file = F.col("_metadata.file_name")
        named = F.when(file.rlike(_SPARK_PART), F.lit("train")).otherwise(F.regexp_extract(file, _NUMBERED, 1))
        split = F.lit("train") if single else F.col("split") if "split" in data.columns else named
    return data.select(split.alias("split"), *[c for c in data.columns if c != "split"])


def read_vocab(spark: SparkSession, path: str) -> DataFrame | None:
    """Stored vocabulary ``(id, ch)``, or None where there is none."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def read_encoder(spark: SparkSession, path: str, ranks: Ranks | None = None) -> Encoder:
    """The character encoder of a stored vocabulary, else the subword encoder of ``ranks``."""
    return pick_encoder(read_vocab(spark, path), ranks)
