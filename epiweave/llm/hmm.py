"""Hidden Markov language model of whole texts: Baum-Welch counts summed over partitions, exact likelihoods.

A text is its words, lower-cased in A-Z, and one end token. States emit classes of words. The commonest ``OWN``
words and the end token are classes of their own; all other words share ``BUCKETS`` classes by their
last letters. A word of a shared class has, within it, the probability (c + 1) / (tokens + words + 1) of that
class, where c is its count in training; the 1 left is one unknown word. So probabilities
of all texts of known and unknown words sum to one, for a vocabulary of any size.

Counts of words are tables that are joined by the hash of the word; only the ``HEAD`` commonest are sent to
tasks. An expectation step runs over all training texts, each task sums its expected counts, and one row per
state and class comes to the driver. Long texts are cut into runs of ``TRAIN_RUN`` tokens for training, where
every token counts; scores run the scaled forward recursion over the whole text.

Defined results: a null text is empty and has one token, the end; a null doc_id is not learnt from; rows that repeat
are scored each, with equal results; without training texts every word is unknown and N is 0; an
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.llm.words import LOWER, binary, constants, find_words, hash_spans, slices
from epiweave.session import materialize

STATES, OWN, BUCKETS, HEAD = 8, 4096, 1024, 1 << 15
ROUNDS, FIRST_ROUNDS, FIRST_TEXTS = 3, 12, 400
TRAIN_RUN = 1024
#: Tokens of texts that are advanced side by side.
TOGETHER = 1 << 18
END = np.uint64(constants(1, 123)[0])
COUNT_ROWS = 1 << 20


def endings(data: np.ndarray, end: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Bucket of each word by its last three bytes."""
    code = np.zeros(len(end), np.int64)
    for back in (1, 2, 3):
        at = end - back
        code = code * 257 + np.where(at >= start, LOWER[data[np.maximum(at, 0)]], 256) if len(end) else code
    return (code * 2654435761 % (1 << 32)) * BUCKETS >> 32


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, buckets, bounds) of the words of each text."""
    start, end, bounds = find_words(data, offsets)
    return hash_spans(data, start, end, LOWER), endings(data, end, start), bounds


def count_words(docs: DataFrame) -> DataFrame:
    """(word, bucket, c) over all rows of (text); tasks add up what they have read before anything is shuffled."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        texts = 0

        def added() -> tuple[np.ndarray, ...]:
            words, buckets, counts = (np.concatenate(part) for part in zip(*held))
            order = np.argsort(words)
            words, buckets = words[order], buckets[order]
            first = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]]))
            return words[first], buckets[first], np.add.reduceat(counts[order], first)

        def rows(part: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            words, buckets, counts = part
            return pa.RecordBatch.from_arrays(
                [pa.array(words.view(np.int64)), pa.array(buckets.astype(np.int32)), pa.array(counts.astype(np.int64))], names=["word", "bucket", "c"]
            )

        for part, data, offsets in slices(batches, "_text"):
            hashes, buckets, _ = tokens(data, offsets)
            texts += part.num_rows
            if len(hashes):
                words, first, counts = np.unique(hashes, return_index=True, return_counts=True)
                held.append((words, buckets[first], counts))
                if sum(len(h[0]) for h in held) > COUNT_ROWS:
                    held = [added()]
                    if len(held[0][0]) > COUNT_ROWS // 2:
                        yield rows(held.pop())
        if held:
            yield rows(added())
        if texts:
            yield rows((np.array([END]), np.array([-1]), np.array([texts])))

    found = docs.select(F.col("text").alias("_text")).mapInArrow(count, "word long, bucket int, c long")
    return found.groupBy("word").agg(F.first("bucket").alias("bucket"), F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """The commonest words, sorted by hash, with their counts and classes, and what is known of all words."""

    words: np.ndarray
    counts: np.ndarray
    classes: np.ndarray
    tokens: int
    distinct: int
    shared: np.ndarray  # log10 of the denominator of each class; 0 for words of their own

    def read(self, hashes: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(class, count) of tokens; the count is -1 where it isn't known here."""
        slot = np.minimum(np.searchsorted(self.words, hashes), len(self.words) - 1)
        found = self.words[slot] == hashes
        return np.where(found, self.classes[slot], OWN + 1 + buckets).astype(np.uint16), np.where(found, self.counts[slot], -1)


def vocabulary(counts: DataFrame) -> Vocabulary:
    words = counts.where("bucket >= 0")
    total = counts.agg(F.sum("c"), F.count("*")).first()
    head = words.orderBy(F.col("c").desc(), "word").limit(HEAD).collect()
    ends = counts.where("bucket < 0").agg(F.sum("c")).first()[0] or 0
    hashes = np.array([r.word for r in head], np.int64).view(np.uint64)
    number = np.array([r.c for r in head], np.int64)
    buckets = np.array([r.bucket for r in head], np.int64)
    classes = np.where(np.arange(len(head)) < OWN, np.arange(len(head)), OWN + 1 + buckets)
    per_bucket = words.groupBy("bucket").agg(F.sum("c").alias("n"), F.count("*").alias("v")).collect()
    room = np.ones(OWN + 1 + BUCKETS)
    for r in per_bucket:
        room[OWN + 1 + r.bucket] += r.n + r.v
    for b, c in zip(buckets[:OWN], number[:OWN]):
        room[OWN + 1 + b] -= c + 1
    shared = np.log10(room)
    shared[: OWN + 1] = 0
    # the end token, the last of the words with a class of their own
    hashes, number, classes = np.append(hashes, END), np.append(number, ends if ends else -1), np.append(classes, OWN)
    order = np.argsort(hashes)
    return Vocabulary(hashes[order], number[order], classes[order].astype(np.int64), int(total[0] or 0), int(total[1] or 0), shared)


def sequences(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """key, doc_id, held_out, n_tokens, the class of every token and, over tokens whose count is known here, how many
    occur in training and the sums of log10(count + 1) over all and over those of shared classes."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for part, data, offsets in slices(batches, "_text"):
            hashes, buckets, bounds = tokens(data, offsets)
            n, ends = part.num_rows, bounds[1:] + np.arange(part.num_rows)
            at = np.ones(len(hashes) + n, bool)
            at[ends] = False
            all_hashes, all_buckets = np.full(len(at), END), np.zeros(len(at), np.int64)
            all_hashes[at], all_buckets[at] = hashes, buckets
            classes, counts = vocab.read(all_hashes, all_buckets)
            text = np.repeat(np.arange(n), np.diff(bounds) + 1)
            logs = np.log10(np.maximum(counts, 0) + 1)
            outer = np.concatenate([[0], ends + 1])
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in ("key", "doc_id", "held_out")] + [
                    pa.array(np.diff(outer), pa.int64()), binary([classes[a:b].tobytes() for a, b in zip(outer[:-1], outer[1:])]),
                    pa.array(np.bincount(text, counts > 0, n).astype(np.int64)), pa.array(np.bincount(text, logs, n)),
                    pa.array(np.bincount(text, logs * (classes > OWN), n)), pa.array(np.bincount(text, vocab.shared[classes], n)),
                ],
                names=["key", "doc_id", "held_out", "n_tokens", "classes", "known", "logs", "shared_logs", "rooms"],
            )

    schema = "key long, doc_id long, held_out boolean, n_tokens long, classes binary, known long, logs double, shared_logs double, rooms double"
    return docs.select("key", F.col("doc_id").cast("long").alias("doc_id"), "held_out", F.col("text").alias("_text")).mapInArrow(read, schema)


def rare_words(docs: DataFrame, vocab: Vocabulary) -> DataFrame:
    """(key, word) of every token whose count is not known from the vocabulary's head."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def rare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for part, data, offsets in slices(batches, "_text"):
            hashes, buckets, bounds = tokens(data, offsets)
            _, counts = vocab.read(hashes, buckets)
            text = np.repeat(np.arange(part.num_rows), np.diff(bounds))[counts < 0]
            yield pa.RecordBatch.from_arrays(
                [part.column("key").take(pa.array(text)), pa.array(hashes[counts < 0].view(np.int64))], names=["key", "word"]
            )

    return docs.select("key", F.col("text").alias("_text")).mapInArrow(rare, "key long, word long")


@dataclass
class Model:
    start: np.ndarray
    move: np.ndarray
    emit: np.ndarray  # (classes, states)


def padded(classes: np.ndarray, bounds: np.ndarray, run: int | None):
    """Groups of texts (or runs of at most ``run`` tokens) with about ``TOGETHER`` tokens, longest first:
    (numbers, start, size), to be advanced side by side."""
    start, size = bounds[:-1], np.diff(bounds)
    text = np.arange(len(size))
    if run:
        pieces = -(-size // run)
        text = np.repeat(text, pieces)
        offset = (np.arange(len(text)) - (np.cumsum(pieces) - pieces)[text]) * run
        start, size = start[text] + offset, np.minimum(run, size[text] - offset)
    order = np.argsort(-size, kind="stable")
    sums = np.cumsum(size[order])
    i = 0
    while i < len(order):
        j = max(i + 1, int(np.searchsorted(sums, (sums[i - 1] if i else 0) + TOGETHER, "right")))
        part = order[i:j]
        yield text[part], start[part], size[part]
        i = j


def forward(model: Model, classes: np.ndarray, start: np.ndarray, size: np.ndarray, keep: bool = False):
    """Natural log-likelihood of each text (longest first) by the scaled forward recursion; with ``keep``
    also the scaled states, their scales, and where each step's rows are."""
    steps = int(size[0]) if len(size) else 0
    active = np.searchsorted(-size, -np.arange(steps), "left")
    out = np.zeros(len(size))
    rows = np.concatenate([[0], np.cumsum(active)])
    kept = np.empty((rows[-1], len(model.start))) if keep else None
    scales = np.empty(rows[-1]) if keep else None
    state = np.broadcast_to(model.start, (len(size), len(model.start)))
    for t in range(steps):
        m = active[t]
        now = state[:m] if t == 0 else state[:m] @ model.move
        now = now * model.emit[classes[start[:m] + t]]
        scale = now.sum(axis=1)
        now /= scale[:, None]
        out[:m] += np.log(scale)
        if keep:
            kept[rows[t] : rows[t + 1]] = now
            scales[rows[t] : rows[t + 1]] = scale
        state = now
    return out, kept, scales, rows


def expect(model: Model, classes: np.ndarray, bounds: np.ndarray) -> tuple[Model, float]:
    """Expected counts of starts, moves and emissions over some texts, and their log-likelihood."""
    n = len(model.start)
    sums = Model(np.zeros(n), np.zeros((n, n)), np.zeros_like(model.emit))
    total = 0.0
    for _, start, size in padded(classes, bounds, TRAIN_RUN):
        found, alpha, scales, rows = forward(model, classes, start, size, keep=True)
        total += float(found.sum())
        at = np.concatenate([start[: rows[t + 1] - rows[t]] + t for t in range(len(rows) - 1)]) if len(rows) > 1 else np.zeros(0, np.int64)
        beta = np.ones((len(size), n))
        ahead = 0
        for t in range(len(rows) - 2, -1, -1):
            m = rows[t + 1] - rows[t]
            if ahead:
                weigh = model.emit[classes[start[:ahead] + t + 1]] * beta[:ahead] / scales[rows[t + 1] : rows[t + 1] + ahead, None]
                sums.move += alpha[rows[t] : rows[t] + ahead].T @ weigh
                beta[:ahead] = weigh @ model.move.T
            alpha_t = alpha[rows[t] : rows[t + 1]]
            alpha_t *= beta[:m]
            ahead = m
        sums.start += alpha[: rows[1]].sum(axis=0) if len(rows) > 1 else 0
        seen = classes[at]
        for k in range(n):
            sums.emit[:, k] += np.bincount(seen, alpha[:, k], len(sums.emit))
    sums.move *= model.move
    return sums, total


def maximise(counts: Model, prior: np.ndarray) -> Model:
    """Model of expected counts; ``prior`` adds a little of the classes' overall shares to every state."""
    emit = counts.emit + prior[:, None]
    move = counts.move + 1.0
    start = counts.start + 1.0
    return Model(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=0))


def flat(rows: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = [len(r) // 2 for r in rows]
    return np.frombuffer(b"".join(rows), np.uint16), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def expected_counts(seqs: DataFrame, model: Model) -> tuple[Model, float]:
    """The expectation step over all rows of (classes), summed over tasks in Spark."""
    spark = seqs.sparkSession
    shared = spark.sparkContext.broadcast(model)
    n = len(model.start)

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, sums, total = shared.value, None, 0.0
        for batch in batches:
            counts, found = expect(model, *flat([v.as_py() for v in batch.column("classes")]))
            total += found
            if sums is None:
                sums = counts
            else:
                for a, b in ((sums.start, counts.start), (sums.move, counts.move), (sums.emit, counts.emit)):
                    a += b
        if sums is not None:
            values = np.concatenate([[total], sums.start, sums.move.ravel(), sums.emit.ravel()])
            some = np.flatnonzero(values)
            yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(values[some])], names=["at", "value"])

    rows = seqs.select("classes").mapInArrow(part, "at long, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()
    values = np.zeros(1 + n + n * n + model.emit.size)
    for r in rows:
        values[r.at] = r.value
    emit = values[1 + n + n * n :].reshape(model.emit.shape)
    return Model(values[1 : 1 + n], values[1 + n : 1 + n + n * n].reshape(n, n), emit), float(values[0])


def fit(seqs: DataFrame, vocab: Vocabulary, states: int = STATES, rounds: int = ROUNDS, seed: int = 11) -> Model:
    """Baum-Welch over all training sequences. It starts from a model fitted to a few of them (at most
    ``FIRST_TEXTS`` of up to ``TRAIN_RUN`` tokens), which only decides where the first full round begins."""
    size = OWN + 1 + BUCKETS
    unigram = np.full(size, 1e-3)
    few = seqs.where(f"n_tokens <= {TRAIN_RUN}").orderBy(F.xxhash64("key"), "key").limit(FIRST_TEXTS).select("classes").collect()
    classes, bounds = flat([bytes(r.classes) for r in few])
    unigram += np.bincount(classes, minlength=size)
    unigram /= unigram.sum()
    rng = np.random.default_rng(seed)
    tilt = np.zeros((size, states))
    # texts are dealt to states by their most telling buckets, so that the first model isn't symmetric
    for text, (a, b) in enumerate(zip(bounds[:-1], bounds[1:])):
        tilt[:, rng.integers(states)] += np.bincount(classes[a:b], minlength=size)
    emit = tilt / np.maximum(tilt.sum(axis=0), 1) + unigram[:, None] * rng.uniform(0.5, 1.5, (size, states))
    stay = 0.9
    model = Model(np.full(states, 1 / states), np.full((states, states), (1 - stay) / states) + np.eye(states) * stay, emit / emit.sum(axis=0))
    for _ in range(FIRST_ROUNDS if len(few) else 0):
        counts, _ = expect(model, classes, bounds)
        model = maximise(counts, unigram * 20)
    for _ in range(rounds):
        counts, _ = expected_counts(seqs, model)
        overall = counts.emit.sum(axis=1) + 1e-2
        model = maximise(counts, overall / overall.sum() * 50)
    return model


def likelihoods(seqs: DataFrame, model: Model) -> DataFrame:
    """``seqs`` without classes, with ``class_score``, the log10-likelihood of the whole class sequence."""
    shared = seqs.sparkSession.sparkContext.broadcast(model)
    kept = [f for f in seqs.schema if f.name != "classes"]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, bounds = flat([v.as_py() for v in batch.column("classes")])
            out = np.zeros(batch.num_rows)
            for text, start, size in padded(classes, bounds, None):
                out[text] = forward(shared.value, classes, start, size)[0]
            yield pa.RecordBatch.from_arrays([batch.column(f.name) for f in kept] + [pa.array(out / np.log(10))], names=[*(f.name for f in kept), "class_score"])

    return seqs.mapInArrow(score, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", class_score double")


def score(docs: DataFrame, held_out: Column, states: int = STATES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    ``base_score`` is the add-one unigram score of the same tokens. Rows where ``held_out`` is not false are not learnt from.
    """
    plain = docs.select("doc_id", held_out.alias("held_out"), "text", F.xxhash64("doc_id", "text").alias("key"))
    training = plain.where("not held_out")
    counts = materialize(count_words(training), "word-counts")
    vocab = vocabulary(counts)
    seqs = materialize(sequences(plain, vocab), "sequences")
    model = fit(seqs.where("not held_out"), vocab, states, rounds)
    scored = likelihoods(seqs, model)
    # rows that repeat share a key, and so the words of all of them
    n = max(200, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    c = F.coalesce("c", F.lit(0))
    rare = rare_words(plain, vocab).repartition(n, "word").join(counts.select("word", "c").repartition(n, "word"), "word", "left")
    rare = rare.groupBy("key").agg(F.sum(F.log10(c + 1.0)).alias("rare_logs"), F.count_if(c > 0).alias("rare_known"))
    rare = rare.join(seqs.groupBy("key").agg(F.count("*").alias("rows")), "key")
    logs = F.coalesce(F.col("rare_logs") / F.col("rows"), F.lit(0.0))
    known = F.coalesce((F.col("rare_known") / F.col("rows")).cast("long"), F.lit(0))
    room = float(np.log10(vocab.tokens + vocab.distinct + 1))
    return scored.join(rare, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("known") + known).alias("n_known"), F.lit(vocab.tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + logs - F.col("n_tokens") * room).alias("base_score"),
        (F.col("class_score") + F.col("shared_logs") + logs - F.col("rooms")).alias("score"),
    )
