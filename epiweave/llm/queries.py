"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import numpy as np

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiweave.llm import automaton, hmm, language, mixing, near, periodic, phrases, quality, sharding, substring, tokens, warc
from epiweave.llm.labelled import fold


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "source", "repeats")


def op2_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), fold("doc_id", 7) == 2)


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.report(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = automaton.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.document_tokens(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "tree_score"
    )


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", fold("doc_id", 5) == 0)
    network = language.learn(docs, ~F.col("held_out"))
    return language.identify(docs, network, ["doc_id", "held_out"])


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op9_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = fold("doc_id", 4) == 2
    scored, _ = quality.rule_ensemble(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), held_out)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine(table(spark, sf_dir, "documents"))


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        F.col("record.doc_id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """Numbers of the words that a document reads instead of its own, for each tenth document."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i, p = np.arange(n), 1 + (n - a) // (3 + g % 8)
    return np.where(i < a, i, a + (i - a) % p)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.collapse_runs(table(spark, sf_dir, "documents"), rewrite=planted_period)
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start as before, -r.period as less, r.start, r.period)))")
    lines = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\n')), '')")
    found = found.withColumn("best", best)
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_hmm": op2_hmm,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_decontaminate": op4_decontaminate,
    "op5_token_counts": op5_token_counts,
    "op6_quality_rules": op6_quality_rules,
    "op7_language": op7_language,
    "op8_warc": op8_warc,
    "op9_rule_ensemble": op9_rule_ensemble,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_phrases": op11_phrases,
    "op12_sharding": op12_sharding,
    "op13_periodic_runs": op13_periodic_runs,
}
