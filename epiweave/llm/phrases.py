"""Phrases whose words attract each other, by best-first growth with branch and bound.

A phrase grows from its first word to the right. A prefix of f(prefix) < ``least`` occurrences has no candidate behind it. The score of
whatever grows from a first word w is at most floor(1000 n / f(w)): cutting after w gives 1000 a n / (f(w) r) with r >= a. So rare first
words come first. Each expansion is one pass over the corpus, in which the frontier (the next first words, and all longer prefixes found in the
pass before) grows by a word; counts are summed in tasks before they are shuffled. Then the candidates so far are settled: one pass counts the
rests behind their cuts and tells whether all occurrences have the same neighbour on one side. If so, the phrase and that neighbour are
a longer candidate that is as frequent, and the phrase is dropped. The score of a language's ``top``-th survivor is a bound from below: what can't reach it is never
expanded, what can tie with it is. Growth ends when no language has such prefixes left.

Tasks know the frontier, and the prefixes on the way to it, as tables of bits of a fixed size at the places of their hashes. A false hit only
makes a task count a phrase in vain: joins on the phrases themselves decide.

Defined results: a null text is empty; a null lang is the language ``und``; repeated rows count as often as they occur; a language without
candidates has no rows; an empty table gives an empty result; only text and lang are read, so that other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from epiweave.llm.tables import if_small
from epiweave.llm.words import LOWER, SAME, byte_set, constants, find_words, hash_spans, mix, slices
from epiweave.session import materialize

WORDS, LEAST, TOP = 5, 100, 2000
#: Shares of all occurrences of frequent words at which a round of first words ends, the rarest words first.
SHARES = (0.25, 0.5, 1.0)
SLICE = 1 << 21
BITS = 25
BREAK = byte_set((0x0A, 0x0D), *[(ord(c), ord(c)) for c in ".,;:!?"])
WORD = ~(BREAK | byte_set((0x20, 0x20), (0x09, 0x09)))
_STEP = constants(WORDS + 1, 95)
_LOW, _HIGH = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Products of counts may pass 64 bits.
EXACT = "decimal(38,0)"


class Slice:
    """Words of some texts: hashes, pieces, and phrases as text."""

    def __init__(self, part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray):
        self.data = LOWER[data]
        self.start, self.end, bounds = find_words(self.data, offsets, WORD)
        self.langs = part.column("_lang")
        self.text = np.repeat(np.arange(part.num_rows), np.diff(bounds))
        self.n = len(self.start)
        #: whether a word and the one before it stand in the same piece
        self.goes_on = np.ones(self.n + 1, bool)
        self.goes_on[bounds] = False
        self.goes_on[np.searchsorted(self.start, np.flatnonzero(BREAK[self.data]))] = False
        last = np.flatnonzero(~self.goes_on[1:])
        #: words from each one to the end of its piece
        self.left = np.repeat(last, np.diff(last, prepend=-1)) - np.arange(self.n) + 1
        self.words = hash_spans(self.data, self.start, self.end, SAME)
        names = self.langs.to_pylist()
        seeds = {name: lang_hash(name) for name in set(names)}
        self.first_hash = mix(self.words + np.array([seeds[x] for x in names], np.uint64)[self.text]) if self.n else np.zeros(0, np.uint64)

    def longer(self, at: np.ndarray, hashes: np.ndarray, size: int) -> np.ndarray:
        """Hashes of the phrases of ``size`` words at some places, from those of one word less."""
        return mix(hashes * _STEP[size] + self.words[at + size - 1])

    def phrases(self, at: np.ndarray, size: int) -> tuple[pa.Array, pa.Array]:
        """(languages, phrases) of ``size`` words that start at the given words."""
        word = (at[:, None] + np.arange(size)).ravel()
        sizes = self.end[word] - self.start[word] + 1  # with the space behind it
        ends = np.cumsum(sizes)
        index = np.repeat(self.start[word] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        text = self.data[np.minimum(index, len(self.data) - 1)]
        text[ends - 1] = 0x20
        phrase_ends = ends[size - 1 :: size] - np.arange(1, len(at) + 1)  # without the last word's space
        keep = np.ones(len(text), bool)
        keep[ends[size - 1 :: size] - 1] = False
        offsets = np.concatenate([[0], phrase_ends]).astype(np.int64)
        found = pa.LargeStringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(text[keep]))
        return self.langs.take(pa.array(self.text[at])).cast(pa.string()), found.cast(pa.string())


def lang_hash(lang: str) -> np.uint64:
    data = np.frombuffer(f"{lang} ".encode(), np.uint8)
    return hash_spans(data, np.array([0]), np.array([len(data)]), SAME)[0]


def phrase_hashes(langs: list[str], phrases: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(size, which, hashes) of phrases as tasks hash them: for each number of words the prefixes of that size of the phrases that have it."""
    part = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), phrases], names=["_lang", "_text"])
    for rows, data, offsets in slices(iter([part]), "_text", 1 << 62):
        found = Slice(rows, data, offsets)
        bounds = np.searchsorted(found.text, np.arange(len(langs) + 1))
        at, sizes = bounds[:-1], np.diff(bounds)
        which = np.flatnonzero(sizes)
        hashes = found.first_hash[at[which]]
        for size in range(1, WORDS + 1):
            yield size, which, hashes
            more = sizes[which] > size
            which = which[more]
            hashes = found.longer(at[which], hashes[more], size + 1) if len(which) else hashes[more]


def bit_table(phrases: DataFrame, bits: int) -> Broadcast:
    """Two broadcast tables of 2^bits bits: one has the bits of the hashes of (lang, phrase) set, the other those of their shorter prefixes.
    Their size does not depend on the data."""

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            words = np.array([p.count(" ") + 1 for p in batch.column("phrase").to_pylist()])
            for size, which, hashes in phrase_hashes(batch.column("lang").to_pylist(), batch.column("phrase")):
                for kind, own in (("whole", words[which] == size), ("path", words[which] > size)):
                    spots = hashes[own] >> np.uint64(64 - bits)
                    cell, inverse = np.unique(spots >> np.uint64(6), return_inverse=True)
                    held = np.zeros(len(cell), np.uint64)
                    np.bitwise_or.at(held, inverse, np.uint64(1) << (spots & np.uint64(63)))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([kind] * len(cell), pa.string()), pa.array(cell.astype(np.int64)), pa.array(held.view(np.int64))], names=["kind", "cell", "held"]
                    )

    found = phrases.select("lang", "phrase").mapInArrow(cells, "kind string, cell long, held long")
    found = found.groupBy("kind", "cell").agg(F.bit_or("held").alias("held")).toArrow()
    kinds = found.column("kind").to_numpy()
    tables = np.zeros((2, 1 << (bits - 6)), np.uint64)
    for k, kind in enumerate(("whole", "path")):
        own = kinds == kind
        tables[k, found.column("cell").to_numpy()[own]] = found.column("held").to_numpy()[own].view(np.uint64)
    return phrases.sparkSession.sparkContext.broadcast(tables)


def marked(table: np.ndarray, hashes: np.ndarray, bits: int) -> np.ndarray:
    spots = hashes >> np.uint64(64 - bits)
    return (table[spots >> np.uint64(6)] >> (spots & np.uint64(63))) & np.uint64(1) != 0


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("_lang"), F.col("text").alias("_text"))


def _counted(found: Slice, size: int, at: np.ndarray, hashes: np.ndarray) -> pa.RecordBatch:
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    langs, phrases = found.phrases(at[first], size)
    return pa.RecordBatch.from_arrays([langs, phrases, pa.array(np.full(len(first), size, np.int32)), pa.array(counts.astype(np.int64))], names=["lang", "phrase", "size", "n"])


def count_words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all single words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text", SLICE):
            found = Slice(part, data, offsets)
            if found.n:
                yield _counted(found, 1, np.arange(found.n), found.first_hash)

    return _texts(docs).mapInArrow(run, "lang string, phrase string, size int, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def grow(docs: DataFrame, frontier: Broadcast, frequent: Broadcast, bits: int, least: int) -> DataFrame:
    """(lang, phrase, size, a) of the phrases of ``least`` occurrences or more that are a prefix of the frontier and one frequent word more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text", SLICE):
            found = Slice(part, data, offsets)
            common = marked(frequent.value[0], found.first_hash, bits)
            at = np.flatnonzero(common)
            hashes = found.first_hash[at]
            for size in range(2, WORDS + 1):
                open_ = found.left[at] >= size
                open_[open_] = common[at[open_] + size - 1]
                at, hashes = at[open_], hashes[open_]
                grows, leads = marked(frontier.value[0], hashes, bits), marked(frontier.value[1], hashes, bits)
                stay = grows | leads
                at, grows = at[stay], grows[stay]
                hashes = found.longer(at, hashes[stay], size)
                if grows.any():
                    yield _counted(found, size, at[grows], hashes[grows])

    counted = _texts(docs).mapInArrow(run, "lang string, phrase string, size int, n long")
    return counted.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def look_around(docs: DataFrame, wanted: Broadcast, bits: int) -> DataFrame:
    """(lang, phrase, size, f, alone) of phrases of two words or more that are wanted. A phrase is not ``alone`` if all its occurrences
    have the same word before them in their piece, or the same word behind them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text", SLICE):
            found = Slice(part, data, offsets)
            words = found.words.view(np.int64)
            at, hashes = np.arange(found.n), found.first_hash
            for size in range(2, WORDS + 1):
                stay = (found.left[at] >= size) & marked(wanted.value[1], hashes, bits)
                at = at[stay]
                hashes = found.longer(at, hashes[stay], size)
                hit = np.flatnonzero(marked(wanted.value[0], hashes, bits))
                if not len(hit):
                    continue
                hit = hit[np.argsort(hashes[hit], kind="stable")]
                own, place = hashes[hit], at[hit]
                first = np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]]))
                langs, phrases = found.phrases(place[first], size)
                sides = []
                for has, next_ in ((found.goes_on[place], place - 1), (found.goes_on[place + size], place + size)):
                    word = words[np.clip(next_, 0, found.n - 1)]
                    sides += [np.minimum.reduceat(np.where(has, word, _LOW), first), np.maximum.reduceat(np.where(has, word, _HIGH), first)]
                yield pa.RecordBatch.from_arrays(
                    [langs, phrases, pa.array(np.full(len(first), size, np.int32)), pa.array(np.diff(np.append(first, len(place)))), *map(pa.array, sides)],
                    names=["lang", "phrase", "size", "n", "before_low", "before_high", "behind_low", "behind_high"],
                )

    seen = _texts(docs).mapInArrow(run, "lang string, phrase string, size int, n long, before_low long, before_high long, behind_low long, behind_high long")
    ends = [f(c).alias(c) for f, c in ((F.min, "before_low"), (F.max, "before_high"), (F.min, "behind_low"), (F.max, "behind_high"))]
    whole = seen.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f"), *ends)
    return whole.select("lang", "phrase", "size", "f", F.expr("before_low <> before_high and behind_low <> behind_high").alias("alone"))


def _quotient(a: str, n: str, l: str, r: str) -> Column:  # noqa: E741
    return F.expr(f"cast((cast(1000 as {EXACT}) * cast({a} as decimal(19,0)) * cast({n} as decimal(19,0))) div (cast({l} as decimal(19,0)) * cast({r} as decimal(19,0))) as long)")


def settle(docs: DataFrame, candidates: DataFrame, words: DataFrame, bits: int, longest: int = WORDS) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of the candidates (lang, phrase, size, a, n, prefixes) that are not dropped."""
    parts = F.split("phrase", " ")
    cuts = candidates.select("lang", "phrase", "size", "a", "n", "prefixes", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    cuts = materialize(cuts.select(
        "lang", "phrase", "size", "a", "n", "k", F.element_at("prefixes", F.col("k")).alias("l"),
        F.array_join(F.slice(parts, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("rest"),
    ), "phrase-cuts")
    wanted = cuts.where("size - k > 1").select("lang", F.col("rest").alias("phrase")).unionByName(candidates.select("lang", "phrase")).distinct()
    seen = materialize(look_around(docs, bit_table(wanted, bits), bits).join(wanted, ["lang", "phrase"], "left_semi"), "phrases-seen")
    counts = words.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")).unionByName(seen.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")))
    scored = cuts.join(counts, ["lang", "rest"]).withColumn("score", _quotient("a", "n", "l", "r"))
    least = scored.groupBy("lang", "phrase", "size").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
    kept = least.join(seen.select("lang", "phrase", "alone"), ["lang", "phrase"]).where(F.col("alone") | (F.col("size") == longest))
    return kept.select("lang", "phrase", "cut.a", "cut.l", "cut.r", "cut.n", "cut.score")


def _first_rows(rows: DataFrame, top: int, *order: Column) -> DataFrame:
    """The first ``top`` rows of each language with their rank: first of hashed parts, then of what these hand on."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    some = rows.withColumn("_part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = some.withColumn("_rank", F.row_number().over(Window.partitionBy("lang", "_part").orderBy(*order))).where(F.col("_rank") <= top).drop("_rank", "_part")
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)


def _rounds(words: DataFrame, shares: tuple[float, ...]) -> DataFrame:
    """(lang, level, round): the round in which first words of about 2^(level / 4) occurrences are expanded."""
    levels = words.groupBy("lang", "level").agg(F.sum("f").alias("f"))
    share = F.sum("f").over(Window.partitionBy("lang").orderBy("level")) / F.sum("f").over(Window.partitionBy("lang"))
    number = sum((share > limit).cast("int") for limit in shares[:-1]) if len(shares) > 1 else F.lit(0)
    return levels.select("lang", "level", number.alias("round"))


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, shares: tuple[float, ...] = SHARES, bits: int = BITS) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) of each language's first ``top`` phrases by score, a (both descending) and phrase.

    Candidates have two to five words and ``least`` occurrences or more inside pieces of text. Their score is the smallest
    floor(1000 a n / (l r)) of their cuts, of equal ones that of the first. Those inside a longer candidate that is as frequent are dropped.
    """
    counted = materialize(count_words(docs), "word-counts")
    totals = counted.groupBy("lang").agg(F.sum("n").alias("n"))
    words = counted.where(F.col("n") >= least).select("lang", "phrase", F.col("n").alias("f")).withColumn("level", F.floor(4 * F.log2("f")))
    words = words.join(if_small(materialize(totals, "word-totals")), "lang")
    words = words.join(if_small(materialize(_rounds(words, shares), "rounds")), ["lang", "level"])
    words = materialize(words.select("lang", "phrase", F.lit(1).alias("size"), "f", "n", "round", F.expr("1000 * cast(n as decimal(38,0)) div f").alias("bound"), F.array().cast("array<long>").alias("prefixes")), "frequent-words")
    frequent = bit_table(words, bits)
    node = ["lang", "phrase", "size", "f", "n", "bound", "prefixes"]
    nothing = words.limit(0).select(node)
    kept, limits, deep, waiting = None, None, nothing, []

    def hopeful(nodes: DataFrame) -> DataFrame:
        if limits is None:
            return nodes
        return nodes.join(limits, "lang", "left").where(F.coalesce(F.col("bound") >= F.col("limit"), F.lit(True))).select(nodes.columns)

    step, done = 0, False
    while not done:
        roots = words.where(F.col("round") == step).select(node) if step < len(shares) else nothing
        frontier = materialize(hopeful(roots.unionByName(deep)), "frontier")
        if frontier.isEmpty():
            deep = nothing
        else:
            parent = F.expr("substring_index(phrase, ' ', size - 1)")
            found = grow(docs, bit_table(frontier, bits), frequent, bits, least).withColumn("parent", parent)
            above = frontier.select("lang", F.col("phrase").alias("parent"), "n", "bound", F.concat("prefixes", F.array("f")).alias("prefixes"))
            found = materialize(found.join(above, ["lang", "parent"]).select("lang", "phrase", "size", F.col("a").alias("f"), "n", "bound", "prefixes"), "grown")
            deep = found.where(F.col("size") < WORDS)
            waiting.append(found)
        step += 1
        done = step >= len(shares) and deep.isEmpty()
        if waiting and (done or step < len(shares)):
            candidates = hopeful(reduce(DataFrame.unionByName, waiting)).withColumn("a", F.col("f"))
            settled = settle(docs, materialize(candidates, "candidates"), words, bits)
            kept = materialize(settled if kept is None else settled.unionByName(kept), "settled")
            ranked = _first_rows(kept, top, F.col("score").desc(), F.col("phrase"))
            limits = if_small(materialize(ranked.where(F.col("rank") == top).select("lang", F.col("score").alias("limit")), "limits"))
            waiting = []
    if kept is None:  # no phrase at all
        kept = settle(docs, nothing.withColumn("a", F.col("f")), words, bits)
    ranked = _first_rows(kept, top, F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
