"""Quality of documents: base rules, boosted trees as flat node arrays, and a sparse rule ensemble.

Both models learn on the driver from a bounded sample of labelled documents (``SAMPLE`` per class) and
are applied to every whole text. Labels, lang, source and doc_id are never inputs of a score.

Defined results: a null text is an empty text, which fails the base rules and still gets a score;
repeated document rows get equal results; documents without label are scored like all others; without
labels of two classes the trees or rules are left out, and every document has the same score; an empty table gives
an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.llm.labelled import fold, sample_per_class
from epiweave.llm.statistics import document_statistics, shares
from epiweave.llm.trees import Forest, boost
from epiweave.session import materialize

SAMPLE = 4000
#: A document's score never rises with these.
FALLING = ("repeats", "dup_lines", "symbols", "top_word_share", "repeat_pairs")


def features(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, the counts and the derived features of each document, stored once."""
    counted = document_statistics(docs, keep)
    return materialize(counted.select("*", *[c.cast("double").alias(f"f_{n}") for n, c in shares().items()]), "statistics")


def training_rows(stats: DataFrame, labels: DataFrame, allowed: Column, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and weights of a bounded sample of labelled rows; weights restore the classes' true shares."""
    names = [f"f_{n}" for n in shares()]
    known = labels.where("quality in (0, 1)").select("doc_id", "quality")
    rows = sample_per_class(stats.where(allowed).select("doc_id", *names).join(known, "doc_id"), "quality", limit)
    rows = sorted(rows.collect())
    x = np.array([r[1:-1] for r in rows], float).reshape(len(rows), len(names))
    y = np.array([r[-1] for r in rows], float)
    share = {r[0]: r[1] for r in known.join(stats.where(allowed).select("doc_id"), "doc_id").groupBy("quality").count().collect()}
    weight = np.array([share[int(v)] / max(1, int((y == v).sum())) for v in y])
    return x, y, weight / weight.mean() if len(y) else weight


def fit_trees(x: np.ndarray, y: np.ndarray, weight: np.ndarray, falling: tuple[str, ...] = FALLING) -> Forest | None:
    names = list(shares())
    if len(set(y.tolist())) < 2:
        return None
    return boost(x, y, monotone={names.index(n): -1 for n in falling}, weight=weight)


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def score_by_trees(stats: DataFrame, forest: Forest | None) -> DataFrame:
    """Adds ``tree_score``, the probability of label 1."""
    if forest is None:
        return stats.withColumn("tree_score", F.lit(0.5))
    names = [f"f_{n}" for n in shares()]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in stats.schema) + ", tree_score double"

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.stack([batch.column(n).to_numpy(zero_copy_only=False) for n in names], axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forest.probability(x))], names=[*batch.schema.names, "tree_score"])

    return stats.mapInArrow(score, schema)


def quality_rules(
    docs: DataFrame, labels: DataFrame, held_out: Column | None = None, limit: int = SAMPLE, least_score: float = 0.5
) -> DataFrame:
    """doc_id, the counts, base_failed, tree_score and kept: not failed by a base rule and a tree
    score of at least ``least_score``. Rows where ``held_out`` holds are not learnt from."""
    stats = features(docs, ["doc_id"])
    forest = fit_trees(*training_rows(stats, labels, F.lit(True) if held_out is None else ~held_out, limit))
    scored = score_by_trees(stats.withColumn("base_failed", base_failed()), forest)
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("tree_score") >= least_score))


Rule = tuple[tuple[int, float, float], ...]


def extract_rules(forest: Forest) -> list[Rule]:
    """The conjunctions of all paths from a root to a node, as (feature, above, at most)."""
    rules: dict[Rule, None] = {}

    def walk(node: int, box: dict[int, tuple[float, float]]) -> None:
        if box:
            rules[tuple((f, *box[f]) for f in sorted(box))] = None
        f = int(forest.feature[node])
        if f >= 0:
            low, high = box.get(f, (-np.inf, np.inf))
            cut = float(forest.threshold[node])
            walk(int(forest.left[node]), box | {f: (low, min(high, cut))})
            walk(int(forest.right[node]), box | {f: (max(low, cut), high)})

    for root in forest.roots:
        walk(int(root), {})
    return list(rules)


def holds(rules: list[Rule], x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for k, rule in enumerate(rules):
        for f, low, high in rule:
            out[:, k] *= (x[:, f] > low) & (x[:, f] <= high)
    return out


def lasso(z: np.ndarray, y: np.ndarray, weight: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights with an l1 penalty, by proximal gradient steps with momentum."""
    w, b = np.zeros(z.shape[1]), 0.0
    v, c, t = w.copy(), b, 1.0
    total = weight.sum()
    size = 4 / (1e-9 + np.linalg.norm(z * np.sqrt(weight / total)[:, None], 2) ** 2 + 1)
    for _ in range(steps):
        error = weight * (1 / (1 + np.exp(-np.clip(z @ v + c, -40, 40))) - y) / total
        w_next = v - size * (z.T @ error)
        w_next = np.sign(w_next) * np.maximum(np.abs(w_next) - size * penalty, 0)
        b_next = c - size * error.sum()
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = w_next + (t - 1) / t_next * (w_next - w), b_next + (t - 1) / t_next * (b_next - b)
        w, b, t = w_next, b_next, t_next
    return w, float(b)


def compile_rules(rules: list[Rule], weights: np.ndarray, intercept: float) -> Column:
    """The rule ensemble as one column: logistic function of the weighted rules that hold."""
    names = [f"f_{n}" for n in shares()]

    def term(rule: Rule, weight: float) -> Column:
        tests = []
        for f, low, high in rule:
            if low > -np.inf:
                tests.append(F.col(names[f]) > low)
            if high < np.inf:
                tests.append(F.col(names[f]) <= high)
        return F.when(reduce(lambda a, b: a & b, tests), F.lit(float(weight))).otherwise(F.lit(0.0))

    parts = [term(r, w) for r, w in zip(rules, weights) if w]
    margin = reduce(lambda a, b: a + b, parts, F.lit(float(intercept)))
    return 1 / (1 + F.exp(-margin))


def rule_ensemble(
    docs: DataFrame, labels: DataFrame, held_out: Column | None = None, limit: int = SAMPLE, trees: int = 40, penalty: float = 0.0005
) -> tuple[DataFrame, list[tuple[Rule, float]]]:
    """doc_id with counts, features and ``score``, and the rules with their weights."""
    stats = features(docs, ["doc_id"])
    x, y, weight = training_rows(stats, labels, F.lit(True) if held_out is None else ~held_out, limit)
    if len(set(y.tolist())) < 2:
        return stats.withColumn("score", F.lit(float(y.mean()) if len(y) else 0.5)), []
    rules = extract_rules(boost(x, y, trees=trees, depth=3, rate=0.3, weight=weight))
    w, b = lasso(holds(rules, x), y, weight, penalty)
    return stats.withColumn("score", compile_rules(rules, w, b)), [(r, float(v)) for r, v in zip(rules, w) if v]


__all__ = ["fold", "quality_rules", "rule_ensemble", "compile_rules", "extract_rules", "lasso", "holds", "features"]
