"""Batch jobs over conversations (conv_id, turn, role, text)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiweave.fixed import (
    CONTEXT_TURNS,
    DISEASE_INTENTS,
    DISEASE_PREFIXES,
    FORECAST_KEYWORDS,
    GENERAL_INTENTS,
    TARGET_DISEASES,
)
from epiweave.functions.text import match_key


def _has_text() -> Column:
    return F.col("text").isNotNull() & (F.col("text") != "")


def last_user_turn(df: DataFrame) -> DataFrame:
    """Last non-empty user text of each conversation."""
    return (
        df.where((F.col("role") == "user") & _has_text())
        .groupBy("conv_id")
        .agg(F.max("turn").alias("turn"), F.max_by("text", "turn").alias("text"))
    )


def context_window(df: DataFrame, turns: int = CONTEXT_TURNS) -> DataFrame:
    """The last ``turns`` turns of each conversation, in order, as one array.

    Empty turns are dropped after the cut, so they use up room. Spark limits each group inside
    the map tasks before the shuffle, so a conversation of any length sends ``turns`` rows per
    task. Roles other than user and assistant count as user.
    """
    latest = Window.partitionBy("conv_id").orderBy(F.col("turn").desc())
    role = F.when(F.col("role") == "assistant", "assistant").otherwise("user")
    kept = df.withColumn("_rank", F.row_number().over(latest)).where(F.col("_rank") <= turns)
    return (
        kept.where(_has_text())
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", role.alias("role"), "text"))).alias("context"))
    )


def _mentions(key: Column, groups: list[list[str]]) -> Column:
    """Every group has a keyword in the text."""
    any_of = [reduce(lambda a, b: a | b, [key.contains(w) for w in group]) for group in groups]
    return reduce(lambda a, b: a & b, any_of)


def _first_match(rules: list[tuple[str, Column]]) -> Column:
    return F.coalesce(*[F.when(test, label) for label, test in rules])


def tag_intents(df: DataFrame, diseases: list[str] = TARGET_DISEASES) -> DataFrame:
    """Tag every non-empty user turn with the disease it names, what it asks, and whether it
    asks for a forecast: (conv_id, turn, disease, intent, wants_forecast)."""
    key = F.col("_key")
    named = [(d, key.contains(d)) for d in diseases]
    named += [(d, key.contains(prefix)) for prefix, d in DISEASE_PREFIXES.items() if d in diseases]
    has_disease = F.col("disease").isNotNull()
    rules = [("empty", key == "")]
    rules += [(name, has_disease & _mentions(key, groups)) for name, groups in DISEASE_INTENTS]
    rules += [(name, _mentions(key, groups)) for name, groups in GENERAL_INTENTS]
    rules += [("about_disease", has_disease), ("other", F.lit(True))]
    return (
        df.where((F.col("role") == "user") & _has_text())
        .select("conv_id", "turn", match_key("text").alias("_key"))
        .withColumn("disease", _first_match(named))
        .select(
            "conv_id", "turn", "disease",
            _first_match(rules).alias("intent"),
            _mentions(key, [FORECAST_KEYWORDS]).alias("wants_forecast"),
        )
    )
