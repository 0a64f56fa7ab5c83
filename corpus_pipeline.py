"""From documents to a training mix: toxic documents, copies, near copies and benchmark leaks go, the rest is mixed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from croplake.llm import common, decontaminate, exact, jaccard, mixing, toxicity

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", toxicity.stage),
    ("exact_dedup", exact.stage),
    ("ngram_jaccard", jaccard.stage),
    ("decontamination", decontaminate.stage),
    ("mixing", mixing.stage),
]

#: A learned model and random draws have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each reads what the one before has written."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir), name)
    return docs
