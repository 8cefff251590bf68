"""Periodic runs against a plain search for every period."""

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from epiweave.llm import periodic
from epiweave.llm.queries import op13_periodic_runs, planted_period

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, least=12):
    n, found = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i < n - p:
            j = i
            while j < n - p and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, 2 * p):
                found.setdefault((i, j + p), p)
            i = max(j, i + 1)
    return sorted((a, b - a, p) for (a, b), p in found.items())


def collapsed(words, runs):
    dropped = {i for start, length, p in runs for i in range(start + p, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def texts(seed=11, n=150):
    rng = random.Random(seed)
    for _ in range(n):
        kinds, size = rng.choice([1, 2, 2, 3, 5, 40]), rng.choice([0, 1, 5, 11, 12, 13, 24, 60, 150])
        words = [f"w{rng.randrange(kinds)}" for _ in range(size)]
        if rng.random() < 0.4:
            root = [f"é{rng.randrange(2)}" for _ in range(rng.randrange(1, 9))]
            words = (root * rng.randrange(1, 9) + ["x"]) * rng.randrange(1, 4) + words
        yield "".join(w + rng.choice([" ", "  ", "\n", "\t "]) for w in words)


ODD = [None, "", " \n\t ", "one", "Spam spam " * 9, "spam " * 3000, "a b c " * 5 + "a"]


@pytest.mark.parametrize("tile", [1 << 15, 64, 8])
def test_runs_and_collapsed_words(spark, tile):
    rows = [(i, t) for i, t in enumerate(texts())] + [(1000 + i, t) for i, t in enumerate(ODD)] + [(None, "x y " * 8), (3, "x y " * 8), (3, "x y " * 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").select("*", F.lit(1).alias("row"), F.lit("b").alias("body"), F.lit(2).alias("period")).repartition(3)
    got = sorted(((r.doc_id, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in periodic.collapse_runs(docs, tile=tile).collect()), key=str)
    want = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        runs = brute(words) if len(words) < 1000 else [(0, len(words), 1)]
        want.append((doc_id, tuple(runs), collapsed(words, runs)))
    assert got == sorted(want, key=str)


def test_tiles_of_a_thue_morse_text():
    """Hashes of runs must not fail on a sequence that polynomial hashes can't tell apart."""
    bits = "0"
    while len(bits) < 2048:
        bits += "".join("10"[int(b)] for b in bits)
    words = periodic.constants(2, 5)[[int(b) for b in bits]]
    short = periodic._solve_together([words], 12)
    whole = {(int(p), int(a), int(b)) for _, p, a, b in zip(*short) if b - a >= max(p, 12 - p)}
    pieces = []
    for s, place, first, last, tile in periodic.tiles(words, 12, 256):
        pieces += [(int(p), int(a) + place, int(b) + place) for p, a, b in zip(*periodic._solve_tile(s, first, last, tile, 12))]
    joined = set()
    for p, a, b in sorted(pieces):
        near = [x for x in joined if x[0] == p and a <= x[2]]
        joined -= set(near)
        joined.add((p, min([a, *(x[1] for x in near)]), max([b, *(x[2] for x in near)])))
    assert {x for x in joined if x[2] - x[1] >= max(x[0], 12 - x[0])} == whole and len(whole) > 100


def test_query_on_a_fixture(spark, tmp_path):
    rows = [(i, t) for i, t in enumerate(texts(5, 60))] + [(None, "a b " * 9), (7, "x " * 20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, op13_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    want, bent = [], 0
    for doc_id, text in rows:
        words = WORD.findall(text)
        h = zlib.crc32(str(doc_id).encode())
        if doc_id is not None and h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p, bent = 1 + (n - a) // (3 + g % 8), bent + 1
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{m},{p}\n" for s, m, p in runs)), sha(collapsed(words, runs))))
    assert got == sorted(want, key=str) and bent > 2
    assert planted_period(None, 5) is None and planted_period(3, 0) is None


def test_empty_table(spark):
    assert periodic.collapse_runs(spark.createDataFrame([], "doc_id long, text string")).count() == 0
