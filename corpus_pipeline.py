"""A training corpus from raw documents: five stages, each over all that the one before kept.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last
return the columns of ``documents``.  The last adds ``copies``: how often the mix takes the
row.  Toxic documents go, one document of each near-copy group stays, documents with
benchmark passages go, secrets are replaced in the text, and what is left is mixed to the
target weights.
"""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from corpusflow.llm.decontaminate import drop_contaminated
from corpusflow.llm.entropy_mix import mix_documents
from corpusflow.llm.queries import fold
from corpusflow.llm.secret_scan import redact_secrets
from corpusflow.llm.simhash import drop_near_copies
from corpusflow.llm.toxicity import drop_toxic
from corpusflow.scratch import stored_alone
from corpusflow.ship import ship_package
from corpusflow.sources.tables import read_table

#: The learned filter and the solver of the mix have no SQL; tests hold run() against brute force.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "toxic").where(fold(4) != 2)
    return drop_toxic(docs, labels)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return drop_near_copies(docs, shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return redact_secrets(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix_documents(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_copies", near_copies),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("mixing", mixing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``, each result stored and read again by the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_alone(spark, partial(stage, spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
