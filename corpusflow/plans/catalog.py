"""All named queries."""

from corpusflow.plans import corpus_queries, ngram_queries, runlog_queries, stream_queries  # noqa: F401
from corpusflow.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
