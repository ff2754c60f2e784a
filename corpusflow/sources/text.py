"""Plain text sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_text_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``(path, text)``: one row per file, line ends as ``\\n``.

    A file is one string, so it must stay under Spark's limit of 2 GiB per value; larger ones
    are read by :func:`read_text_lines`.
    """
    files = spark.read.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("path"),
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
    )


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(path, place, text)``: the lines of files of any size, each with its line end as ``\\n``.

    Files are read in ranges by many tasks.  In order of ``place`` the texts of a file are
    the text that :func:`read_text_corpus` gives: whether the last line has an end is told by
    the size of the file.  An empty file has no line.
    """
    size = F.col("_metadata.file_size")
    lines = spark.read.text(path, lineSep="\n").select(
        F.col("_metadata.file_path").alias("path"),
        F.struct(F.col("_metadata.file_block_start").alias("range"), F.monotonically_increasing_id().alias("row")).alias("place"),
        size.alias("size"),
        "value",
    )
    # without an end of its last line a file is a byte shorter than its lines with theirs
    cut = F.sum(F.octet_length("value").cast("bigint") + 1) > F.max("size")
    files = lines.groupBy("path").agg(F.max("place").alias("_last"), cut.alias("_open"))
    end = F.when(F.col("_open") & (F.col("place") == F.col("_last")), "").otherwise("\n")
    text = F.regexp_replace(F.concat("value", end), "\r\n?", "\n")
    return lines.join(files, "path").select("path", "place", text.alias("text"))


def sum_first_field(spark: SparkSession, path: str) -> DataFrame:
    """``(file, total)``: sum of the first white-space separated field of every line, per file."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    # leading white space does not open a field, and blank lines hold none
    field = F.nullif(F.split(F.trim(F.regexp_replace("value", r"\s+", " ")), " ")[0], F.lit(""))
    return lines.groupBy("file").agg(F.coalesce(F.sum(field.cast("double")), F.lit(0.0)).alias("total"))
