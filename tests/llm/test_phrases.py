"""Phrase mining against a count of all phrases."""

import collections
import random
import re

import pytest
from pyspark.sql import functions as F

from epiweave.llm import phrases
from epiweave.llm.queries import op11_phrases

CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, least, top):
    counts, totals = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(CAPITALS)):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            counts.update((lang, tuple(words[i : i + m])) for m in range(1, 6) for i in range(len(words) - m + 1))
    candidates = {key: f for key, f in counts.items() if f >= least and len(key[1]) > 1}
    dropped = set()
    for (lang, words), f in candidates.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                if f >= counts[lang, words[i : i + size]]:
                    dropped.add((lang, words[i : i + size]))
    scored = collections.defaultdict(list)
    for (lang, words), a in candidates.items():
        if (lang, words) not in dropped:
            n = totals[lang]
            score, k = min((1000 * a * n // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words)))
            scored[lang].append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], n))
    return sorted(
        (lang, rank, phrase.decode(), -a, left, right, n, -score)
        for lang, found in scored.items() for rank, (score, a, phrase, left, right, n) in enumerate(sorted(found)[:top], 1)
    )


def corpus(seed=4, n=260):
    rng = random.Random(seed)
    bound = ["Big Apple", "as soon as possible", "één twee drie vier vijf zes", "New York City", "ad hoc"]
    for i in range(n):
        lang = rng.choice(["en", "fr", None])
        words = []
        for _ in range(rng.randrange(0, 40)):
            words.append(rng.choice(bound) if rng.random() < 0.15 else f"{'abcdefgh'[min(7, int(rng.expovariate(0.5)))]}{(lang or '')[:1]}")
        yield "".join(w + rng.choice([" ", " ", " ", "\t", "  ", ", ", ".", "\n"]) for w in words), lang


ODD = [(None, "en"), ("", "fr"), ("x", ""), (" \t\n.,", None), ("the end.of it" * 3, "und"), ("ends with word", "en"), ("Same same " * 2000, "de"), ("same same " * 30, "de")]


@pytest.mark.parametrize("least,top,shares,bits", [(3, 2000, (0.25, 0.5, 1.0), 25), (2, 12, (0.1, 0.3, 0.6, 1.0), 25), (4, 40, (1.0,), 8)])
def test_against_all_counts(spark, least, top, shares, bits):
    rows = [*corpus(), *ODD]
    docs = spark.createDataFrame(rows, "text string, lang string").select("*", F.lit(1).alias("phrase"), F.lit(2).alias("n"), F.lit("x").alias("_text2")).repartition(4)
    got = sorted(map(tuple, phrases.mine(docs, least, top, shares, bits).collect()))
    want = brute(rows, least, top)
    assert [(r[0], r[1], r[2], *r[3:]) for r in got] == want and len(want) > 4


def test_bounds_leave_common_words_unexpanded(spark, monkeypatch):
    """With few places to fill, prefixes that can't reach the last score are not expanded."""
    rows = [*corpus()]
    docs = spark.createDataFrame(rows, "text string, lang string")
    expanded, plain = [], phrases.grow

    def grow(docs, frontier, *rest):
        expanded.append(int(sum(bin(int(x)).count("1") for x in frontier.value[0])))
        return plain(docs, frontier, *rest)

    monkeypatch.setattr(phrases, "grow", grow)
    assert sorted(map(tuple, phrases.mine(docs, 3, 1, (0.1, 0.3, 1.0)).collect())) == brute(rows, 3, 1)
    few = sum(expanded)
    expanded.clear()
    phrases.mine(docs, 3, 2000, (0.1, 0.3, 1.0))
    assert few < sum(expanded)


def test_products_beyond_64_bits(spark):
    row = spark.createDataFrame([(3 * 10**12, 10**15, 3 * 10**12, 4 * 10**12)], "a long, n long, l long, r long")
    assert row.select(phrases._quotient("a", "n", "l", "r").alias("q")).first().q == 1000 * 10**15 // (4 * 10**12)


def test_query_and_empty_table(spark, tmp_path):
    rows = [("new york is big. " * 60, "en"), ("new york " * 50, "en")]
    spark.createDataFrame(rows, "text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(map(tuple, op11_phrases(spark, str(tmp_path)).collect())) == brute(rows, 100, 2000)
    assert phrases.mine(spark.createDataFrame([], "text string, lang string")).count() == 0
    assert phrases.mine(spark.createDataFrame([("a b c", "en")], "text string, lang string")).count() == 0
