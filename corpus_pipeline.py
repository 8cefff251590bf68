"""The corpus pipeline: language ID, near and substring duplicates, benchmark decontamination, source mix.

Each stage takes all that its predecessor kept and returns the columns of ``documents`` again; the last one
returns the mix: how often each document that is left is taken. Between stages documents are a Parquet table in the
shared folder, and what a stage stored for itself goes when the next one begins.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from epiweave.llm import automaton, language, mixing, near, substring
from epiweave.llm.labelled import fold
from epiweave.session import materialize, replacing

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: null, empty or letterless texts, and those in which the network finds no
    learned language with a score of at least ``language.LEAST``. Without labelled texts to learn from all are kept."""
    return language.language_filter(docs, language.learn(docs, fold("doc_id", 5) != 0))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-equal ones."""
    return near.without_near_duplicates(docs)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages that a document with a smaller id holds."""
    return substring.without_repeats(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of benchmark items and drops documents that are mostly such passages."""
    return automaton.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often each document is taken so that sources meet their word budgets."""
    return mixing.mix(docs)


def _scoped(stage: Stage) -> Stage:
    def scoped(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with replacing(spark, "pipeline-stage"):
            return stage(spark, docs, sf_dir)

    return scoped


STAGES: list[tuple[str, Stage]] = [
    ("language_id", _scoped(language_id)),
    ("near_dedup", _scoped(near_dedup)),
    ("substring_dedup", _scoped(substring_dedup)),
    ("decontaminate", _scoped(decontaminate)),
    ("source_mix", _scoped(source_mix)),
]

#: A trained network, signatures and knapsacks are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with replacing(spark, "pipeline-run"):
        for name, stage in STAGES[:-1]:
            docs = materialize(stage(spark, docs, sf_dir), f"after-{name}")
        return STAGES[-1][1](spark, docs, sf_dir)
