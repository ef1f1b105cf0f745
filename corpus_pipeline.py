"""From raw documents to a training mix, as stages that each keep a table.

Every stage takes ``(spark, docs, folder)`` and returns what goes on. ``run``
applies them to the documents of a folder; each result is stored as Parquet in
the folder that the executors share and read again, so that a lost executor
repeats one stage at most.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from watchledger.llm import decontamination, mixing, quality, secret_scan, simhash
from watchledger.llm.common import table
from watchledger.scratch import Scratch

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the quality classifier does not reject.

    Labels are learned from the documents of the folder, whichever of them are
    still there.
    """
    labels = table(spark, folder, "labels")
    model = quality.train(table(spark, folder, "documents"), labels)
    return quality.keep_predicted(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return simhash.deduplicate(docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontamination.decontaminate(docs, table(spark, folder, "benchmark"))


def hide_secrets(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """All documents, with secrets replaced in their texts."""
    return secret_scan.redact_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents as often as the target weights of their sources say."""
    return mixing.mix_sources(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_good),
    ("simhash_near_dedup", keep_one_of_each),
    ("benchmark_decontamination", drop_benchmark_leaks),
    ("secret_scan", hide_secrets),
    ("mix_sources", mix),
]

#: A trained classifier cannot be said in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that all stages together make of a folder's documents."""
    scratch = Scratch(spark).drop_at_exit()
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = scratch.stage(stage(spark, docs, sf_dir), name)
    return docs
