"""Each operator of the corpus subpackage against a brute-force version, on small and on odd input."""

import collections
import gzip
import hashlib
import itertools
import math
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from epiweave.llm import automaton, components, hmm, language, minhash, mixing, near, quality, statistics, substring, tokens, trees, warc
from epiweave.llm.labelled import fold
from epiweave.llm.oracles import OP8
from epiweave.session import work_path

WORD = re.compile(r"[^\x20\x09-\x0D]+")
CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF_DIR = "/root/testdata/sf0.001"


def random_docs(n: int = 120, seed: int = 3) -> list[tuple]:
    rng = random.Random(seed)
    vocab = {"en": "the of and over land water Stone bird cloud under river".split(), "fr": "le la été où garçon forêt rivière Pierre nuage sous".split()}
    rows = []
    for i in range(n):
        lang = rng.choice(["en", "fr"])
        words = [rng.choice(vocab[lang]) + rng.choice(["", "s", "x", ",", ".", "a1"]) + rng.choice(["", str(rng.randrange(60))]) for _ in range(rng.randrange(1, 90))]
        text = "".join(w + rng.choice([" ", " ", " ", "\n", "\t ", " "]) for w in words)
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    for i in range(n, n + 40):  # near copies
        base = rows[rng.randrange(n)][1].split(" ")
        for _ in range(rng.randrange(0, 4)):
            base[rng.randrange(len(base))] = rng.choice(["changed", "words", "here"])
        text = " ".join(base)
        rows.append((i, text, "en", "s0", len(text)))
    return rows


ODD = [
    (1000, None, "en", None, None), (1001, "", None, "", 0), (1002, " \n\t ", "fr", "s1", 4), (1003, "?! ... 123", "en", "s1", 10),
    (1004, "x", "en", "s2", 1), (1005, "One two three", "en", "s2", 13), (1006, "one TWO three", "en", None, 13), (1006, "one TWO three", "en", None, 13),
    (None, "words of no id at all in this text", "en", "s2", 3), (1007, "long " * 30000, "en", "s3", 150000), (1008, "é" * 50000, "fr", "s3", 50000),
]


@pytest.fixture(scope="module")
def rows():
    return random_docs() + ODD


@pytest.fixture(scope="module")
def docs(spark, rows):
    # columns whose names an operator might use itself
    return spark.createDataFrame(rows, SCHEMA).select("*", F.lit(1).alias("size"), F.lit("x").alias("key"), F.lit(2.0).alias("score"), F.lit(3).alias("n_words")).repartition(5)


def words_of(text):
    return WORD.findall(text or "")


# ---- words and hashes ----


def test_fit_is_optimal():
    rng = random.Random(1)
    for _ in range(100):
        lengths = rng.sample(range(1, 40), rng.randint(1, 5))
        counts = [rng.randint(1, 3) for _ in lengths]
        budget = rng.randint(0, sum(a * b for a, b in zip(lengths, counts)))
        got = mixing.fit(lengths, counts, budget)
        assert all(0 <= k <= c for k, c in zip(got, counts))
        best = min(abs(sum(k * n for k, n in zip(ks, lengths)) - budget) for ks in itertools.product(*[range(c + 1) for c in counts]))
        assert abs(sum(k * n for k, n in zip(got, lengths)) - budget) == best


def test_mix(docs, rows):
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    again = sorted(map(tuple, mixing.mix(docs.repartition(3)).collect()), key=str)
    assert again == sorted(map(tuple, got), key=str)
    sizes = collections.Counter()
    for _, text, _, source, _ in rows:
        sizes[source] += len(words_of(text))
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    want, left, open_ = {}, 1.5 * sum(sizes.values()), set(order)
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            want.update({s: level * weight[s] for s in open_})
            break
        want.update({s: 2.0 * sizes[s] for s in over})
        left -= sum(want[s] for s in over)
        open_ -= over
    taken = collections.Counter()
    for r in got:
        assert r.target == pytest.approx(want[r.source]) and r.source_size == sizes[r.source]
        assert r.taken == r.repeats * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for source in order:
        assert abs(taken[source] - want[source]) <= 30001
    assert abs(taken["s0"] - want["s0"]) < 1


# ---- hidden Markov model ----


def test_base_scores_and_known_words(docs, rows):
    got = {(r.doc_id, r.n_tokens): r for r in hmm.score(docs, fold("doc_id", 7) == 2, states=2, rounds=1).collect()}
    counts = collections.Counter()
    for doc_id, text, *_ in rows:
        if doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 != 2:
            counts.update([*words_of((text or "").translate(CAPITALS)), None])
    total, distinct = sum(counts.values()), len(counts)
    for doc_id, text, *_ in rows:
        tokens_ = [*words_of((text or "").translate(CAPITALS)), None]
        r = got[doc_id, len(tokens_)]
        base = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens_)
        assert r.train_tokens == total and r.n_known == sum(counts[t] > 0 for t in tokens_)
        assert r.base_score == pytest.approx(base, rel=1e-9, abs=1e-9) and r.score < 0


def test_forward_sums_over_all_paths():
    rng = np.random.default_rng(0)
    draw = lambda *shape: rng.uniform(0.1, 1, shape)
    start, move, emit = draw(3), draw(3, 3), draw(4, 3)
    model = hmm.Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))
    texts = [[0, 2, 1, 3], [3], [1, 1]]
    classes, bounds = np.array(sum(texts, []), np.uint16), np.array([0, 4, 5, 7])
    for numbers, first, size in hmm.padded(classes, bounds, None):
        found = hmm.forward(model, classes, first, size)[0]
        for number, value in zip(numbers, found):
            text, total = texts[number], 0.0
            for path in itertools.product(range(3), repeat=len(text)):
                p = model.start[path[0]] * model.emit[text[0], path[0]]
                for t in range(1, len(text)):
                    p *= model.move[path[t - 1], path[t]] * model.emit[text[t], path[t]]
                total += p
            assert value == pytest.approx(math.log(total))
    # Baum-Welch never lowers the likelihood
    last = -np.inf
    for _ in range(5):
        counts, found = hmm.expect(model, classes, bounds)
        assert found >= last - 1e-9 and counts.emit.sum() == pytest.approx(7) and counts.move.sum() == pytest.approx(4)
        last = found
        model = hmm.Model(counts.start / counts.start.sum(), counts.move / counts.move.sum(axis=1, keepdims=True), counts.emit / counts.emit.sum(axis=0))


def test_the_model_is_a_distribution(spark):
    train = spark.createDataFrame([(i, t) for i, t in enumerate(["a b a", "b c", "a", "c c b a"])], "doc_id long, text string")
    one = [("a",), ("b",), ("c",), ("unseen",), ("",)]
    both = train.select("doc_id", "text", F.lit(False).alias("h")).unionByName(
        spark.createDataFrame(one, "text string").select(F.lit(-1).cast("long").alias("doc_id"), "text", F.lit(True).alias("h")))
    scored = hmm.score(both, F.col("h"), states=2, rounds=1).where("held_out").collect()
    got = sum(10**r.score for r in scored)
    assert 0 < got < 1


# ---- near duplicates ----


def brute_components(rows, width, percent):
    sets = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            found = words_of((text or "").translate(CAPITALS))
            sets[doc_id] = {tuple(found[i : i + width]) for i in range(max(1, len(found) - width + 1))} if found else set()
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sets, 2):
        same = len(sets[a] & sets[b])
        if same and 100 * same >= percent * (len(sets[a]) + len(sets[b]) - same):
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    return {d: (len(sets[d]), root(d)) for d in sets}


def test_near_duplicates(docs, rows):
    want = brute_components(rows, 4, 80)
    got = near.near_duplicates(docs, shingle=4).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id] and r.kept == (r.doc_id == r.component_id)


def test_a_repeated_id_with_different_texts(spark):
    """Only the row whose own text is a copy goes; its namesake with an unlike text stays."""
    a, b = ([f"{c}{i}" for i in range(60)] for c in "ab")
    near_b = [*b[:40], "changed", *b[41:]]
    rows = [(1, " ".join(b)), (5, " ".join(a)), (5, " ".join(near_b)), (5, " ".join(near_b)), (7, None), (None, " ".join(b)), (8, " ".join(a))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id, r.component_id, r.kept) for r in near.near_duplicates(docs, percent=70).collect()), key=str)
    assert got == sorted([(1, 1, True), (5, 5, True), (5, 1, False), (5, 1, False), (7, 7, True), (None, None, True), (8, 5, False)], key=str)
    left = near.without_near_duplicates(docs, percent=70).collect()
    assert sorted(map(tuple, left), key=str) == sorted([rows[0], rows[1], rows[4], rows[5]], key=str)


def test_rounds_confirm_all_pairs_of_unlike_near_copies(spark, monkeypatch):
    """Copies of one text that are all a little under the threshold, and some over it: rounds go on until none is left."""
    rng, rows, asked = random.Random(6), [], []
    base = [f"w{i}" for i in range(120)]
    for i in range(90):
        words = list(base)
        for k in rng.sample(range(120), rng.choice([1, 2, 3, 3, 4])):
            words[k] = f"n{i}x{k}"
        rows.append((i, " ".join(words)))
    plain, settled = minhash.block_pairs, minhash.block_links
    monkeypatch.setattr(minhash, "BLOCK", 16)
    monkeypatch.setattr(minhash, "block_pairs", lambda *args: (asked.append(args[-1]), plain(*args))[1])
    monkeypatch.setattr(minhash, "block_links", lambda *args: (asked.append("sets"), settled(*args))[1])
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, percent=80).collect()}
    want = {d: c for d, (_, c) in brute_components(rows, 5, 80).items()}
    assert got == want and 5 < len(set(want.values())) < 85
    assert asked == [2, 8, "sets"]


def test_group_pairs_hold_no_more_than_the_likeliest(spark):
    """Six hundred by six hundred near copies in one block give a few pairs for each cluster."""
    rng = np.random.default_rng(3)
    base = rng.integers(0, 256, 640, dtype=np.uint8)
    sigs = np.where(rng.random((1200, 640)) < 0.05, rng.integers(0, 256, (1200, 640), dtype=np.uint8), base).astype(np.uint8)
    import pyarrow as pa

    rows = pa.table({
        "key": [1] * 1200, "asks": [False] * 600 + [True] * 600, "id": np.arange(1200), "n": [100] * 1200, "cluster": np.arange(1200),
        "leading": [True] * 600 + [False] * 600, "band": [0] * 1200, "sig": pa.array([s.tobytes() for s in sigs], pa.binary()),
    })
    a, b, cut = minhash._group_pairs(rows, 640, 5, 80, 5e-7, 3)
    assert cut and len(a) == 3 * 600 and set(np.bincount(b, minlength=1200)[600:]) == {3}
    equal = (sigs[a] == sigs[b]).sum(axis=1)
    for q in (600, 900, 1199):
        assert sorted(equal[b == q]) == sorted((sigs[:600] == sigs[q]).sum(axis=1))[-3:]
    a, b, cut = minhash._group_pairs(rows, 640, 5, 80, 5e-7, 600)
    assert not cut and len(a) == 600 * 600


def test_large_bucket_in_blocks(spark, monkeypatch):
    """A chain of copies in which far ends are not similar, cut into blocks of a few rows."""
    monkeypatch.setattr(minhash, "BLOCK", 4)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(40):
        rows.append((i, " ".join(words)))
        words = [*words[1:], f"n{i}"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near.near_duplicates(docs, shingle=4).collect()}
    assert got == {d: c for d, (_, c) in brute_components(rows, 4, 80).items()} and set(got.values()) == {0}


def test_posterior_bound():
    n, threshold, miss = 64, 0.8, 1e-3
    least = minhash.least_matches(n, threshold, miss)

    def tail(m):  # by integration of the Beta density
        x = (np.arange(200000) + 0.5) / 200000
        density = x**m * (1 - x) ** (n - m)
        return density[x >= threshold].sum() / density.sum()

    assert tail(least) >= miss > tail(least - 1)
    assert minhash.bands_for(0.8, 0.99, 4) == 9


def lost_over_looks(similarity, hashes, miss, threshold=0.8):
    """How likely the comparison of signatures drops a pair, over all looks; bytes are also equal by chance."""
    p = similarity + (1 - similarity) / 256
    alive = {0: 1.0}
    for i in range(0, hashes, minhash.STEP):
        size = min(minhash.STEP, hashes - i)
        after = collections.Counter()
        for m, weight in alive.items():
            for k in range(size + 1):
                after[m + k] += weight * math.comb(size, k) * p**k * (1 - p) ** (size - k)
        least = minhash.least_matches(i + size, threshold, miss)
        alive = {m: weight for m, weight in after.items() if m >= least}
    return 1 - sum(alive.values())


def test_near_pairs_reach_confirmation():
    assert lost_over_looks(0.8, near.HASHES, near.MISS) < 1e-5


def test_colliding_lines_reach_confirmation():
    assert lost_over_looks(0.8, substring.HASHES, substring.MISS) < 1e-4


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (3, 3), (20, 21), (21, 6)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 6: 6, 7: 6, 8: 6, 9: 6, 20: 6, 21: 6}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- substring duplicates ----


def test_substring_dedup(spark):
    rng = random.Random(8)
    sentence = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(9)) + "."
    passage = " ".join(sentence() for _ in range(7))
    changed = passage.split()
    changed[20] = "other"
    own = {i: " ".join(sentence() for _ in range(4)) for i in range(8)}
    rows = [
        (0, own[0] + "\n" + passage + "\n" + own[1]), (1, own[2] + " " + passage + " " + own[3]), (2, own[4] + "\n" + " ".join(changed)),
        (3, own[5]), (4, own[6] + "\n" + own[6]), (5, passage), (6, None), (7, ""), (None, passage), (8, own[7] + "\nshort line of words here now\n"),
        (9, "short line of words here now\n" + sentence()),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("spans", F.lit(1)).withColumn("n_chars", F.length("text"))
    got = {r.doc_id: r for r in substring.report(docs).collect()}
    assert len(got) == len(rows)
    assert {d for d, r in got.items() if r.repeated} == {1, 2, 5}
    assert got[1].removed_words == got[2].removed_words == got[5].removed_words == 63
    clean = {r.doc_id: r for r in substring.without_repeats(docs).collect()}
    assert set(clean) == {0, 1, 2, 3, 4, 6, 7, 8, 9, None} and clean[1].text.split() == (own[2] + " " + own[3]).split()
    assert clean[2].text == own[4] and clean[2].n_chars == len(own[4]) and clean[0].text == rows[0][1] and clean[None].text == passage
    assert substring.without_repeats(docs).columns == docs.columns


def test_repeated_ids_are_cut_by_their_own_text(spark):
    rng = random.Random(9)
    line = lambda: " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
    a, b, c, d = (line() for _ in range(4))
    near_b = b.split()
    near_b[12] = "other"
    rows = [(0, a), (0, b), (3, c + "\n" + " ".join(near_b)), (4, d), (4, c + "\n" + d + "\n" + b), (4, c + "\n" + d + "\n" + b)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.removed_words) for r in substring.report(docs).collect())
    assert got == [(0, 60, 0), (0, 60, 0), (3, 120, 60), (4, 60, 0), (4, 180, 120), (4, 180, 120)]
    clean = sorted(map(tuple, substring.without_repeats(docs).collect()))
    assert clean == sorted([(0, a), (0, b), (3, c), (4, d), (4, d), (4, d)])


def brute_repeats(rows):
    """Words that the operator's rules remove: lines and sentences compared with all others, no bands."""
    paragraphs = collections.defaultdict(list)  # words of a paragraph to (document, row, first, last, is a line)
    for k, (doc_id, text) in enumerate(rows):
        at = 0
        for raw in (text or "").split("\n"):
            words = words_of(raw.translate(CAPITALS))
            if not words:
                continue
            spans, low = [(0, len(words), True)], 0
            for i, w in enumerate(words):
                if w[-1] in ".!?" or i == len(words) - 1:
                    spans.append((low, i + 1, False))
                    low = i + 1
            for first, last, is_line in spans:
                if last - first >= substring.PIECE and (is_line or (first, last) != (0, len(words))):
                    paragraphs[tuple(words[first:last])].append((doc_id, k, at + first, at + last, is_line))
            at += len(words)
    keys = list(paragraphs)
    sets = [({p[i : i + 5] for i in range(max(1, len(p) - 4))} if len(p) >= substring.LEAST and any(x[4] for x in paragraphs[p]) else None) for p in keys]
    parent = list(range(len(keys)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(keys)), 2):
        if sets[i] and sets[j]:
            same = len(sets[i] & sets[j])
            if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    owner = collections.defaultdict(lambda: 10**9)
    for i, p in enumerate(keys):
        owner[root(i)] = min(owner[root(i)], *(x[0] for x in paragraphs[p]))
    found = collections.defaultdict(set)
    for i, p in enumerate(keys):
        for doc_id, k, first, last, _ in paragraphs[p]:
            if doc_id != owner[root(i)]:
                found[k].add((first, last))
    return [sum(b - a for a, b in substring.join_spans(list(found[k]), substring.GAP, substring.SPAN)) for k in range(len(rows))]


def test_substring_report_against_all_pairs(spark):
    rng = random.Random(21)
    sentence = lambda n: " ".join(f"w{rng.randrange(10**5)}" for _ in range(n)) + "."
    passages = [[" ".join(sentence(rng.randrange(4, 14)) for _ in range(rng.randrange(1, 5))) for _ in range(rng.randrange(1, 4))] for _ in range(12)]
    rows = []
    for i in range(60):
        lines = [sentence(rng.randrange(3, 30)) for _ in range(rng.randrange(1, 5))]
        for passage in rng.sample(passages, rng.randrange(0, 3)):
            own = [x.split() for x in passage]
            for words in own:
                if rng.random() < 0.5 and len(words) > 20:
                    words[rng.randrange(len(words))] = "Changed"
            place = rng.randrange(len(lines) + 1)
            lines[place:place] = [" ".join(w) for w in own] if rng.random() < 0.7 else [" ".join(" ".join(w) for w in own) + " " + sentence(12)]
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.removed_words for r in substring.report(docs).collect()}
    want = brute_repeats(rows)
    assert [got[i] for i in range(60)] == want and sum(w > 0 for w in want) > 15


# ---- benchmark decontamination ----


def brute_leaks(text, items, window=10):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(CAPITALS))
    found, hit, ids = cut(text), set(), set()
    for item_id, item in items:
        w = cut(item)
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            for j in range(len(found) - size + 1):
                if found[j : j + size] == w[i : i + size]:
                    hit.update(range(j, j + size))
                    ids.add(str(item_id))
    return len(found), len(hit), sorted(ids)


@pytest.mark.parametrize("block_words", [50_000, 15])
def test_leaks(spark, block_words):
    rng = random.Random(4)
    alphabet = "a b c d e".split()
    line = lambda n: " ".join(rng.choice(alphabet) for _ in range(n))
    items = [(1, line(25)), (2, line(14)), (3, None), (4, "?!"), (5, line(7)), (6, line(25)), (10, "Only TWO")]
    items.append((7, items[0][1]))
    items.append((8, line(4) + " " + items[1][1]))
    rows = [(i, line(60)) for i in range(60)]
    rows += [(100, line(3) + " " + items[0][1].upper().replace(" ", "-")), (101, None), (102, ""), (103, "only two only Two x"), (104, items[1][1] + " z " + items[1][1]), (104, items[5][1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_hit", F.lit(9)).withColumn("c0", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.n_words, r.n_hit, list(r["items"])) for r in automaton.find_leaks(docs, bench, block_words=block_words).collect())
    assert got == sorted((d, *brute_leaks(t, items)) for d, t in rows)
    clean = automaton.decontaminate(docs, bench)
    assert clean.columns == docs.columns
    texts = [(r.doc_id, r.text) for r in clean.collect()]
    assert (102, "") in texts and (101, None) in texts and 104 not in [d for d, _ in texts]


# ---- token counts ----


def test_token_counts(spark, docs, rows):
    vocabulary = tokens.tokenizer_path()
    if not os.path.exists(vocabulary):
        pytest.skip("no tokenizer")
    encoding = tokens.load(vocabulary)
    got = collections.Counter((r.doc_id, r.n_tokens) for r in tokens.document_tokens(docs, file_bytes=4000).collect())
    assert got == collections.Counter((d, len(encoding.encode_ordinary(t or ""))) for d, t, *_ in rows)


@pytest.mark.parametrize("block", [1, 2, 3, 7, 100])
def test_separator_scan_over_block_edges(spark, tmp_path, block):
    flat = np.array([5, 6, 9, 9, 1, 2, 3, 4, 5, 9, 7, 7], "<u2")
    flat.tofile(f"{tmp_path}/one.bin")
    np.array([9], "<u2").tofile(f"{tmp_path}/two.bin")
    files = spark.createDataFrame([("one.bin", 24), ("two.bin", 2)], "file string, bytes long")
    got = tokens.count_tokens(spark, str(tmp_path), files, end=9, block_tokens=block).collect()
    want = [("one.bin", 0, 2, True), ("one.bin", 1, 0, True), ("one.bin", 2, 5, True), ("one.bin", 3, 2, False), ("two.bin", 0, 0, True)]
    assert sorted(map(tuple, got)) == want


# ---- statistics, trees, rules ----


def brute_statistics(text):
    text = text or ""
    found = words_of(text)
    windows = collections.defaultdict(list)
    for i in range(len(found) - 7):
        windows[tuple(found[i : i + 8])].append(i)
    cover = {j for places in windows.values() if len(places) > 1 for i in places for j in range(i, i + 8)}
    lines = [ln for ln in text.split("\n") if words_of(ln)]
    return (len(found), sum(map(len, found)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(cover), len(text), len(set(found)))


def test_statistics(spark, rows):
    extra = [(2000, "# a|b <x>\n# a|b <x>\n\n\n# a|b <x> \n"), (2001, "a b c d e f g h " * 3 + "z"), (2002, "a " * 9)]
    docs = spark.createDataFrame([(*r, None, None, None) for r in extra] + rows, SCHEMA)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_distinct_words"]
    got = sorted((r.doc_id or -1, *[r[n] for n in names]) for r in statistics.document_statistics(docs).collect())
    assert got == sorted((r[0] or -1, *brute_statistics(r[1])) for r in extra + rows)


def test_trees_are_monotone_and_fit():
    rng = np.random.default_rng(2)
    x = rng.uniform(0, 1, (600, 3))
    y = (x[:, 0] + 0.3 * np.sin(9 * x[:, 1]) > 0.6).astype(float)
    forest = trees.boost(x, y, monotone={0: 1, 2: -1})
    assert ((forest.probability(x) > 0.5) == y).mean() > 0.95
    base = rng.uniform(0, 1, (50, 3))
    for f, sign in ((0, 1), (2, -1)):
        grid = np.repeat(base, 20, axis=0)
        grid[:, f] = np.tile(np.linspace(0, 1, 20), 50)
        assert (sign * np.diff(forest.margin(grid).reshape(50, 20)) >= -1e-12).all()

    def walk(row):  # one row, node by node
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                node = forest.left[node] if row[forest.feature[node]] <= forest.threshold[node] else forest.right[node]
            total += forest.value[node]
        return total

    assert np.allclose([walk(r) for r in x[:40]], forest.margin(x[:40]))


def labels_for(spark, rows):
    return spark.createDataFrame([(r[0], int(len(words_of(r[1])) > 30)) for r in rows if r[0] is not None and r[0] < 160], "doc_id long, quality int")


def test_quality_rules(spark, docs, rows):
    got = quality.quality_rules(docs, labels_for(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed)
    none = quality.quality_rules(docs, labels_for(spark, []).limit(0) if rows is None else spark.createDataFrame([], "doc_id long, quality int"))
    assert {r.tree_score for r in none.collect()} == {0.5}


def test_rule_ensemble(spark, docs, rows):
    scored, rules = quality.rule_ensemble(docs, labels_for(spark, rows), fold("doc_id", 4) == 2)
    assert rules and "Python" not in scored.select("score")._jdf.queryExecution().optimizedPlan().toString().split("Relation")[0]
    names, margins = [f"f_{n}" for n in statistics.shares()], []
    for r in scored.collect():
        x = np.array([[r[n] for n in names]])
        assert 0 <= r.score <= 1
        margins.append(math.log(r.score / (1 - r.score)) - sum(w * quality.holds([rule], x)[0, 0] for rule, w in rules))
    assert max(margins) - min(margins) < 1e-6  # the score is the weighted rules that hold, and the same intercept for all
    good = [r.score > 0.5 for r in scored.collect() if r.doc_id is not None and r.doc_id < 120 and r.n_words > 32]
    assert np.mean(good) > 0.9


def test_lasso_is_optimal():
    """At the optimum the slope of the loss is the penalty where a weight stands, and no more where none does."""
    rng = np.random.default_rng(4)
    z = (rng.random((400, 12)) < 0.4).astype(float)
    y = (rng.random(400) < 1 / (1 + np.exp(-(2 * z[:, 0] - 1.5 * z[:, 1] - 0.3)))).astype(float)
    weight = rng.uniform(0.5, 2, 400)
    w, b = quality.lasso(z, y, weight, 0.02, steps=4000)
    error = weight * (1 / (1 + np.exp(-(z @ w + b))) - y) / weight.sum()
    slope = z.T @ error
    assert abs(error.sum()) < 1e-4 and (np.abs(slope) <= 0.02 + 1e-4).all()
    stands = w != 0
    assert 1 < stands.sum() < 12 and np.allclose(slope[stands], -0.02 * np.sign(w[stands]), atol=1e-4)


# ---- language ----


def test_language(docs, rows):
    held = docs.withColumn("held_out", fold("doc_id", 5) == 0)
    network = language.learn(held, ~F.col("held_out"))
    got = language.identify(held, network, ["doc_id", "held_out", "score"])
    assert got.columns[:3] == ["doc_id", "held_out", "score"]
    found = {r.doc_id: r for r in language.identify(held, network, ["doc_id", "held_out"]).collect()}
    truth = {r[0]: r[2] for r in rows if r[0] is not None and r[0] < 120 and len(r[1]) > 40}
    assert np.mean([found[d].lang_pred == v for d, v in truth.items()]) > 0.95
    for d in (1000, 1001, 1002, 1003):
        assert found[d].lang_pred == "und" and found[d].score == 0
    assert found[1008].lang_pred in ("en", "fr") and all(0 <= r.score <= 1 for r in found.values())
    assert language.learn(held.limit(0), F.lit(True)) is None


def test_language_stage_rejects_by_score(spark, docs):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("the of and over land water stone bird cloud under river".split()) for _ in range(60)),
             " ".join(rng.choice("le la été où garçon forêt rivière pierre nuage sous".split()) for _ in range(60)),
             ""]
    texts[2] = texts[0][:200] + " " + texts[1][:200]  # as much of one language as of the other
    network = language.learn(docs.where("doc_id < 120"), F.lit(True))
    asked = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = {r.doc_id: r.score for r in language.identify(asked, network, ["doc_id"]).collect()}
    kept = {r.doc_id for r in language.language_filter(asked, network).collect()}
    assert kept == {0, 1}, scores
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language_id(spark, unlabelled, "").count() == docs.count()


def plain_states(p, side, x, mask):
    """The recurrence of one direction, a run and a byte at a time."""
    squash = lambda v: v / (1 + np.abs(v))
    out = np.zeros((*x.shape, len(p[f"uc{side}"])))
    for run in range(x.shape[1]):
        h = np.zeros(out.shape[2])
        for t in range(x.shape[0]):
            byte = x[t, run]
            z = 1 + squash(h @ p[f"uz{side}"] + p[f"ez{side}"][byte])
            r = 1 + squash(h @ p[f"ur{side}"] + p[f"er{side}"][byte])
            c = squash((r * h) @ p[f"uc{side}"] + p[f"ec{side}"][byte])
            h = (h + z * (c - h) / 2) * mask[t, run]
            out[t, run] = h
    return out


def test_network_forward_pass():
    rng = np.random.default_rng(1)
    net = language.start_weights(["a", "b", "c"], hidden=4)
    net.p = {k: rng.normal(0, 0.8, v.shape).astype(np.float32) for k, v in net.p.items()}
    x = rng.integers(0, 256, (9, 5)).astype(np.uint8)
    mask = np.arange(9)[:, None] < np.array([9, 4, 1, 9, 6])[None, :]
    parts, total, hf, hb = language.positions(net, x, mask)
    exact = {k: v.astype(float) for k, v in net.p.items()}
    f, b = plain_states(exact, "f", x, mask), plain_states(exact, "b", x[::-1], mask[::-1])[::-1]
    assert np.allclose(hf, f, atol=1e-5) and np.allclose(hb, b, atol=1e-5)
    logits = f @ exact["wf"] + b @ exact["wb"] + exact["bias"]
    want = np.exp(logits) / np.exp(logits).sum(axis=2, keepdims=True)
    assert np.allclose(parts / total[:, :, None], want, atol=1e-5)


def test_network_gradients():
    """Against differences of the plain recurrence."""
    rng = np.random.default_rng(2)
    net = language.start_weights(["a", "b"], hidden=3)
    p = {k: rng.normal(0, 0.7, v.shape).astype(np.float32) for k, v in net.p.items()}
    x = rng.integers(97, 103, (7, 4)).astype(np.uint8)
    mask = (np.arange(7)[:, None] < np.array([7, 3, 7, 5])[None, :]).astype(np.float32)
    tape, grads = [], {k: np.zeros_like(v) for k, v in p.items()}
    language._states(p, "f", x, mask, tape)
    slope = rng.normal(size=(7, 4, 3)).astype(np.float32)
    language._backprop(p, grads, "f", x, mask, tape, slope)
    exact = {k: v.astype(float) for k, v in p.items()}
    for name in ("uzf", "urf", "ucf", "ezf", "erf", "ecf"):
        places = [(i, j) for i in (range(97, 103) if name[0] == "e" else range(3)) for j in range(3)]
        for place in places:
            ends = []
            for step in (1e-5, -1e-5):
                moved = dict(exact)
                moved[name] = exact[name].copy()
                moved[name][place] += step
                ends.append((plain_states(moved, "f", x, mask) * slope).sum())
            assert grads[name][place] == pytest.approx((ends[0] - ends[1]) / 2e-5, abs=1e-3), (name, place)


# ---- web archives ----


def test_warc(spark, tmp_path):
    rows = [(i, f"http://x/{i}", "<p>" + "ab" * (i % 7) + "</p>" if i % 3 else None) for i in range(50)] + [(60, None, ""), (None, "u", "<p></p>"), (7, "again", "<p></p>"), (7, "again", "<p></p>")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("shard", F.lit("clash")).repartition(4)
    folder = work_path(spark, "warc-test")
    manifest = warc.write_warc(pages, folder, shard_bytes=60, file_bytes=500).collect()
    assert sum(r.records for r in manifest) == len(rows) and len(manifest) > 3
    other = work_path(spark, "warc-test")
    again = warc.write_warc(pages.repartition(2), other, shard_bytes=60, file_bytes=500).collect()
    assert sorted(map(tuple, manifest)) == sorted(map(tuple, again))
    first = {}
    for page_id, _, html in rows:
        if page_id is not None:
            first[html or ""] = min(first.get(html or "", page_id), page_id)
    got = warc.read_warc(spark, folder).collect()
    assert len(got) == len(rows) and all(r.digest_ok for r in got)
    text = {r[0]: r[2] or "" for r in rows}
    for r in got:
        payload = text[r.page_id]
        want = first.get(payload)
        assert (r.record_type, r.refers_to) == (("response", None) if r.page_id == want else ("revisit", want))
        assert r.payload_bytes == len(payload.encode()) and r.payload_digest == warc.base32(hashlib.sha1(payload.encode()).digest())
        assert r.payload is None if r.record_type == "revisit" else bytes(r.payload) == payload.encode()
    assert warc.archive(pages.limit(0)).count() == 0


def test_warc_repeated_ids_with_different_payloads(spark):
    rows = [(1, "a", "A"), (2, "c", "C"), (5, "a", "A"), (5, "b", "B"), (5, "c", "C"), (None, "n", "A"), (None, "n", "own"), (None, "n", None)]
    folder = work_path(spark, "warc-test")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3), folder)
    got = collections.Counter((r.page_id, r.payload_digest, r.record_type, r.refers_to, r.payload and bytes(r.payload)) for r in warc.read_warc(spark, folder).collect())
    first = {"A": 1, "B": 5, "C": 2}
    want = collections.Counter()
    for page_id, _, html in rows:
        to, data = first.get(html), (html or "").encode()
        digest = warc.base32(hashlib.sha1(data).digest())
        want[(page_id, digest, "response", None, data) if to in (None, page_id) else (page_id, digest, "revisit", to, None)] += 1
    assert got == want


# ---- all on nothing; the pipeline ----


def test_empty_tables(spark, docs):
    none, labels = docs.limit(0), spark.createDataFrame([], "doc_id long, quality int")
    bench = spark.createDataFrame([], "item_id long, text string")
    for result in (
        mixing.mix(none), hmm.score(none, fold("doc_id", 7) == 2), substring.report(none), automaton.find_leaks(none, bench), tokens.document_tokens(none),
        quality.quality_rules(none, labels), language.identify(none, None, ["doc_id"]), quality.rule_ensemble(none, labels)[0], near.near_duplicates(none),
    ):
        assert result.count() == 0
    assert automaton.find_leaks(docs, bench).where("n_hit > 0").count() == 0


def test_a_damaged_archive_is_an_error(spark):
    pages = spark.createDataFrame([(i, f"http://x/{i}", "<p>" + "text %d " % i * 20 + "</p>") for i in range(5)], "page_id long, url string, html string")
    folder = work_path(spark, "warc-test")
    (name,) = [r.file for r in warc.write_warc(pages, folder).collect()]
    assert warc.read_warc(spark, folder, strict=True).count() == 5
    path = f"{folder}/{name}".removeprefix("file:")
    with open(path, "rb") as f:
        members = [gzip.decompress(part) for part in (b"\x1f\x8b" + x for x in f.read().split(b"\x1f\x8b")[1:])]
    members[2] = members[2].replace(b"text 2", b"text 9", 1)
    with open(path, "wb") as f:
        f.write(b"".join(gzip.compress(m) for m in members))
    assert sorted(r.page_id for r in warc.read_warc(spark, folder).where("not digest_ok").collect()) == [2]
    with pytest.raises(Exception, match="the record of page 2 is damaged"):
        warc.read_warc(spark, folder, strict=True).collect()


def test_sql_of_web_archives_on_null_ids():
    rows = [(None, "only here"), (1, "a"), (5, "a"), (None, "a"), (7, None), (8, "")]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?)", rows)
    got = sorted(con.execute(f"SELECT page_id, payload_bytes, record_type, refers_to FROM ({OP8})").fetchall(), key=str)
    want = [(None, 9, "response", None), (1, 1, "response", None), (5, 1, "revisit", 1), (None, 1, "revisit", 1), (7, 0, "response", None), (8, 0, "revisit", 7)]
    assert got == sorted(want, key=str)


def test_pipeline_against_brute_force(spark, tmp_path):
    """Each stage on its own input: exact ids and texts with planted copies, a repeated passage and benchmark passages."""
    rng = random.Random(31)
    fresh = lambda n: " ".join(f"{rng.choice(['the', 'of', 'land', 'water', 'river'])}{rng.randrange(10**6)}" for _ in range(n))
    plain = [(i, fresh(70) + "\n" + fresh(30), "en", f"s{i % 3}") for i in range(40)]
    near_copy = plain[3][1].split(" ")
    near_copy[50] = "altered"
    item, passage = fresh(15), fresh(60)
    planted = [
        (40, plain[5][1], "en", "s0"), (41, " ".join(near_copy), "en", "s1"), (42, fresh(60) + "\n" + passage, "en", "s2"), (43, passage + "\n" + fresh(50), "en", "s0"),
        (44, fresh(40) + " " + item + " " + fresh(30), "en", "s1"), (45, fresh(4) + " " + item, "en", "s2"), (46, None, "en", "s0"), (47, "12 34 ?!", "en", "s1"),
    ]
    rows = [(i, t, lang, source, None if t is None else len(t)) for i, t, lang, source in plain + planted]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, "nobody has these ten words in any text here at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages, left, seen = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for name in list(stages)[:-1]:
        stages[name](spark, left, str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        left = spark.read.parquet(f"{tmp_path}/{name}")
        assert left.columns == [c.split()[0] for c in SCHEMA.split(", ")]
        seen[name] = {r.doc_id: r for r in left.collect()}
        assert len(seen[name]) == left.count() and all(r.n_chars == len(r.text) for r in seen[name].values())
    text = {r[0]: r[1] for r in rows}
    assert set(seen["language_id"]) == set(range(46)) and all(r.text == text[d] for d, r in seen["language_id"].items())
    want = {c for _, c in brute_components([r for r in rows if r[0] < 46], 5, 80).values()}
    assert set(seen["near_dedup"]) == want == set(range(46)) - {40, 41}
    removed = dict(zip(sorted(want), brute_repeats([(d, text[d]) for d in sorted(want)])))
    assert {d for d, n in removed.items() if n} == {43}
    assert {d: r.text for d, r in seen["substring_dedup"].items()} == {d: text[d].split("\n")[1] if d == 43 else text[d] for d in want}
    leaks = {d: brute_leaks(r.text, [(1, item)]) for d, r in seen["substring_dedup"].items()}
    assert {d for d, (_, hit, _) in leaks.items() if hit} == {44, 45}
    kept = {d for d, (n, hit, _) in leaks.items() if 2 * hit <= n}
    clean = {d: r.text for d, r in seen["decontaminate"].items()}
    assert set(clean) == kept == want - {45} and item not in clean[44]
    assert words_of(clean[44]) == words_of(text[44].replace(item, "")) and all(clean[d] == seen["substring_dedup"][d].text for d in kept - {44})
    mixed = {r.doc_id: r for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert set(mixed) == kept
    sizes, taken = collections.Counter(), collections.Counter()
    for d, r in mixed.items():
        assert r.size == len(words_of(clean[d])) and r.taken == r.repeats * r.size <= 2 * r.size
        sizes[rows[d][3]] += r.size
        taken[rows[d][3]] += r.taken
    left_over, open_, target = 1.5 * sum(sizes.values()), {"s0": 3, "s1": 1, "s2": 2}, {}
    while open_:
        level = left_over / sum(open_.values())
        over = {s for s, w in open_.items() if level * w > 2 * sizes[s]} or set(open_)
        full = {s for s in over if level * open_[s] > 2 * sizes[s]}
        target |= {s: 2.0 * sizes[s] if s in full else level * open_[s] for s in over}
        left_over -= sum(target[s] for s in over)
        open_ = {s: w for s, w in open_.items() if s not in over}
    assert all(abs(taken[s] - target[s]) <= 60 for s in target)


def test_pipeline_on_an_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_stages(spark, tmp_path, docs, rows):
    spark.createDataFrame([(1, "a test item that nobody has in any text at all here")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    left = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        out = stage(spark, left, str(tmp_path))
        assert out.columns == docs.columns, name
        out.write.parquet(f"{tmp_path}/{k}")
        left = spark.read.parquet(f"{tmp_path}/{k}")
        if name == "language_id":
            assert {1000, 1001, 1002, 1003}.isdisjoint(r.doc_id for r in left.select("doc_id").collect())
    kept = {r.doc_id for r in left.collect()}
    want = {c for d, (_, c) in brute_components([r for r in rows if r[0] not in (1000, 1001, 1002, 1003)], 5, 80).items()}
    assert kept - {None} <= want and len(kept) > 0.8 * len(want)
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in mixed.collect()} == kept
