"""Periodic runs of words: documents in overlapping tiles per octave of periods, tiles solved on their own, fragments stitched.

A run of period p is a stretch in which words p apart are equal; the places i with word[i] == word[i + p] form an interval. An
octave holds the periods from s to 2 s - 1. Its boundaries lie so close together that every interval long enough for a run contains
a whole step of ``h`` words behind some boundary. For each boundary b and each p of the octave a tile gives the length of the common
beginning of the words from b and from b + p (the boundary's Z-function) and that of the common ending before them, each
up to ``h`` words further than the step. Lengths are found by hashes of 1, 2, 4, ... words, for all boundaries at once, not word by
word. Fragments whose first p words are themselves a repetition belong to a smaller period and are left out. What is left is
shuffled by document and period, and fragments that touch become one interval.

Short documents fill a tile together; those of more than ``tile`` words are exploded into tiles that are dealt over all tasks.

Defined results: a null or empty text has no words and no run; a null doc_id is kept and takes part like any other; repeated rows
give repeated results; an empty table gives an empty one; only doc_id and text are read, so that other columns can't clash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from epiweave.llm.words import NOT_SPACE, SAME, constants, find_words, hash_spans, mix, slices
from epiweave.session import materialize

LEAST = 12
TILE = 1 << 15
GRID = 1 << 20
_LEFT, _RIGHT = constants(2, 91)

Rewrite = Callable[[int | None, int], np.ndarray | None]


class Grams:
    """Hashes of the runs of 1, 2, 4, ... words that start at each place."""

    def __init__(self, words: np.ndarray):
        self.levels = [words]

    def __getitem__(self, level: int) -> np.ndarray:
        while len(self.levels) <= level:
            last, step = self.levels[-1], 1 << (len(self.levels) - 1)
            both = last * _LEFT
            both[:-step] += last[step:] * _RIGHT
            self.levels.append(mix(both))
        return self.levels[level]


def reach(s: int, least: int = LEAST) -> int:
    """Words of a step: a power of two so small that each interval of a run with a period of s or more, which has
    max(p, least - p) places or more, holds a whole step behind a boundary."""
    shortest = min(max(p, least - p) for p in range(s, 2 * s)) if s < least else s
    return 1 << (((shortest + 1) // 2).bit_length() - 1) if shortest > 1 else 1


@lru_cache(maxsize=4)
def _prime_factors(size: int) -> np.ndarray:
    """Smallest prime factor of each number below ``size``."""
    factor = np.arange(size)
    for f in range(2, int(size**0.5) + 1):
        if factor[f] == f:
            multiples = factor[f * f :: f]
            multiples[multiples == np.arange(f * f, size, f)] = f
    return factor


def _primitive(grams: Grams, b: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Whether the p words from b are no repetition of fewer words."""
    factors = _prime_factors(1 << int(p.max()).bit_length()) if len(p) else None
    good, left = np.ones(len(p), bool), p.copy()
    while (at := np.flatnonzero(good & (left > 1))).size:
        f = factors[left[at]]
        q, x = p[at] // f, b[at]
        size = p[at] - q
        level = np.frexp(size.astype(float))[1] - 1  # the largest power of two within the size
        for j in np.unique(level):
            some = level == j
            g, u, v, rest = grams[int(j)], x[some], x[some] + q[some], size[some] - (1 << int(j))
            good[at[some]] = ~((g[u] == g[v]) & (g[u + rest] == g[v + rest]))
        left[at] //= f
    return good


def solve(grams: Grams, s: int, first: int, last: int, least: int = LEAST, text: np.ndarray | None = None):
    """(period, from, to) of the fragments of match intervals at the boundaries of a tile, for periods from s to 2 s - 1.

    Boundaries are the places ``first``, ``first`` + h, ... below ``last``. The words must go on for h places before the first one
    and for 2 h + 4 s behind the last. ``text`` numbers the text of each place: both sides of a match lie in the same text.
    """
    h = reach(s, least)
    low = h.bit_length() - 1
    whole = grams[low]
    ahead = np.lib.stride_tricks.sliding_window_view(whole, s)
    found = []
    step = max(1, GRID // s) * h
    for at in range(first, last, step):
        until = min(at + step, last)
        row, col = np.nonzero(ahead[at + s : until + s : h] == whole[at:until:h, None])
        b, p = at + row * h, s + col
        if text is not None:
            same = text[b] == text[b + p]
            b, p = b[same], p[same]
        if len(b):
            found.append((b, p))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    b, p = (np.concatenate(x) for x in zip(*found))
    after = np.where(whole[b + h] == whole[b + h + p], h, 0)
    before = np.where(whole[b - h] == whole[b - h + p], h, 0)
    some_after, some_before = np.flatnonzero(after == 0), np.flatnonzero(before == 0)
    for level in range(low - 1, -1, -1):
        g, size = grams[level], 1 << level
        x = b[some_after] + h + after[some_after]
        after[some_after] += size * (g[x] == g[x + p[some_after]])
        x = b[some_before] - before[some_before] - size
        before[some_before] += size * (g[x] == g[x + p[some_before]])
    open_end = (after == h) | (before == h)
    keep = np.flatnonzero(open_end | (before + h + after >= np.maximum(p, least - p)))
    keep = keep[_primitive(grams, b[keep], p[keep])]
    return p[keep], b[keep] - before[keep], b[keep] + h + after[keep]


def joined(owner: np.ndarray, p: np.ndarray, low: np.ndarray, high: np.ndarray):
    """Fragments of the same owner and period that touch, as one."""
    order = np.lexsort((low, p, owner))
    owner, p, low, high = owner[order], p[order], low[order], high[order]
    new = np.ones(len(p), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (p[1:] != p[:-1]) | (low[1:] > high[:-1])
    at = np.flatnonzero(new)
    return owner[at], p[at], low[at], np.maximum.reduceat(high, at) if len(at) else high


def octaves(n: int) -> Iterator[int]:
    s = 1
    while 2 * s <= n:
        yield s
        s *= 2


def _edged(words: np.ndarray, before: int, behind: int) -> np.ndarray:
    """Words between values that occur nowhere else."""
    edge = constants(before + behind, 92)
    return np.concatenate([edge[:before], words, edge[before:]])


def _solve_together(words: list[np.ndarray], least: int):
    """(text, period, from, to) of the fragments in some short texts, which lie one behind another, the longest first."""
    sizes = np.array([len(w) for w in words])
    order = np.argsort(-sizes, kind="stable")
    order = order[sizes[order] >= least]
    if not len(order):
        return (np.zeros(0, np.int64),) * 4
    longest = int(sizes[order[0]])
    front, back = max(longest, least), 4 * longest + 2 * least
    marks = constants(len(order), 93)
    flat = np.concatenate([part for k, i in enumerate(order) for part in (words[i], marks[k : k + 1])])
    start = np.concatenate([[0], np.cumsum(sizes[order] + 1)])
    text = np.full(front + len(flat) + back, -1)
    text[front : front + len(flat)] = np.repeat(np.arange(len(order)), sizes[order] + 1)
    grams = Grams(_edged(flat, front, back))
    out = []
    for s in octaves(longest):
        many = int(np.searchsorted(-sizes[order], -max(2 * s, least), "right"))
        p, low, high = solve(grams, s, front, front + int(start[many]), least, text)
        out.append((text[low], p, low - front, high - front))
    owner, p, low, high = joined(*(np.concatenate(x) for x in zip(*out)))
    return order[owner], p, low - start[owner], high - start[owner]


def tiles(words: np.ndarray, least: int, tile: int) -> Iterator[tuple[int, int, int, int, np.ndarray]]:
    """(octave, first place, offset of the first boundary, boundaries' end, words) of each tile of a long text."""
    n = len(words)
    for s in octaves(n):
        h, core = reach(s, least), max(tile, 4 * s)
        for at in range(0, n, core):
            low, high = max(0, at - h), min(n, at + core + 2 * h + 2 * s)
            yield s, low, at - low, min(n, at + core) - low, words[low:high]


def _solve_tile(s: int, first: int, last: int, words: np.ndarray, least: int):
    h = reach(s, least)
    p, low, high = solve(Grams(_edged(words, h, 2 * h + 4 * s)), s, first + h, last + h, least)
    _, p, low, high = joined(np.zeros(len(p), np.int64), p, low - h, high - h)
    return p, low, high


_STORED = "row long, doc_id long, body string, open boolean, period long, low long, high long, octave long, place long, first long, last long, tile binary"


def _read(docs: DataFrame, least: int, tile: int, rewrite: Rewrite | None) -> DataFrame:
    """A table of three kinds of rows: documents (with body, their words joined by spaces), fragments (with period), and tiles of
    long documents. A document without a fragment or a tile is not open: it has no run."""
    names = [c.split()[0] for c in _STORED.split(", ")]
    kinds = {"body": pa.string(), "open": pa.bool_(), "tile": pa.binary()}

    def rows(n: int, **columns) -> pa.RecordBatch:
        arrays = []
        for name in names:
            kind = kinds.get(name, pa.int64())
            arrays.append(pa.array(columns[name], kind) if name in columns else pa.nulls(n, kind))
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 36
        for part, data, offsets in slices(batches, "_text"):
            start, end, bounds = find_words(data, offsets)
            hashes = hash_spans(data, start, end, SAME)
            bodies = _bodies(data, offsets, start, end, bounds)
            ids, words = part.column("doc_id").to_pylist(), []
            for i, doc_id in enumerate(ids):
                own = hashes[bounds[i] : bounds[i + 1]]
                order = rewrite(doc_id, len(own)) if rewrite is not None else None
                if order is not None:
                    spans = [data[a:b].tobytes() for a, b in zip(start[bounds[i] : bounds[i + 1]], end[bounds[i] : bounds[i + 1]])]
                    own, bodies[i] = own[order], b" ".join([spans[k] for k in order])
                words.append(own)
            open_ = np.array([len(w) > tile for w in words], bool)
            for i in np.flatnonzero(open_):
                for s, low, first, last, some in tiles(words[i], least, tile):
                    yield rows(1, row=[number + i], octave=[s], place=[low], first=[first], last=[last], tile=[some.tobytes()])
                words[i] = words[i][:0]
            owner, p, low, high = _solve_together(words, least)
            open_[owner] = True
            if len(owner):
                yield rows(len(owner), row=number + owner, period=p, low=low, high=high)
            yield rows(len(ids), row=number + np.arange(len(ids)), doc_id=ids, body=bodies, open=open_)
            number += len(ids)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text")).mapInArrow(read, _STORED)


def _bodies(data: np.ndarray, offsets: np.ndarray, start: np.ndarray, end: np.ndarray, bounds: np.ndarray) -> list[bytes]:
    """Words of each text joined by one space."""
    keep, plain = NOT_SPACE[data], data.copy()
    inner = np.ones(len(start), bool)
    inner[bounds[1:][np.diff(bounds) > 0] - 1] = False
    gaps = end[inner]
    keep[gaps], plain[gaps] = True, 0x20
    sums = np.concatenate([[0], np.cumsum(keep)])
    packed, at = plain[keep].tobytes(), sums[offsets]
    return [packed[a:b] for a, b in zip(at[:-1], at[1:])]


def _solve_long(tiles_: DataFrame, least: int) -> DataFrame:
    """Fragments of tiles, which are dealt evenly over all tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row, s, place, first, last, tile = (batch.column(c)[k].as_py() for c in ("row", "octave", "place", "first", "last", "tile"))
                p, low, high = _solve_tile(s, first, last, np.frombuffer(tile, np.uint64), least)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(p), row)), pa.array(p, pa.int64()), pa.array(low + place), pa.array(high + place)], names=["row", "period", "low", "high"]
                )

    n = int(tiles_.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return tiles_.repartition(n, "row", "octave", "place").mapInArrow(run, "row long, period long, low long, high long")


def stitch(fragments: DataFrame, least: int = LEAST) -> DataFrame:
    """(row, start, length, period) of the runs that fragments (row, period, low, high) make up."""
    order = Window.partitionBy("row", "period").orderBy("low", "high")
    before = F.max("high").over(order.rowsBetween(Window.unboundedPreceding, -1))
    cut = fragments.withColumn("new", F.when(F.col("low") <= before, 0).otherwise(1)).withColumn("part", F.sum("new").over(order))
    whole = cut.groupBy("row", "period", "part").agg(F.min("low").alias("start"), (F.max("high") - F.min("low") + F.col("period")).alias("length"))
    return whole.where(F.col("length") >= F.greatest(F.lit(least), 2 * F.col("period"))).select("row", "start", "length", "period")


def _collapse(opened: DataFrame) -> DataFrame:
    """Bodies without the words that repeat a run's first period."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for body, runs in zip(batch.column("body"), batch.column("runs")):
                body, runs = body.as_py(), runs.as_py() or []
                if runs:
                    words = body.split(" ")
                    steps = np.zeros(len(words) + 1, np.int64)
                    np.add.at(steps, [r["start"] + r["period"] for r in runs], 1)
                    np.add.at(steps, [r["start"] + r["length"] for r in runs], -1)
                    body = " ".join([words[i] for i in np.flatnonzero(np.cumsum(steps[:-1]) == 0)])
                out.append(body)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("runs"), pa.array(out, pa.string())], names=["doc_id", "runs", "collapsed"])

    return opened.select("doc_id", "body", "runs").mapInArrow(cut, f"doc_id long, runs {_RUNS}, collapsed string")


_RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


def collapse_runs(docs: DataFrame, least: int = LEAST, tile: int = TILE, rewrite: Rewrite | None = None) -> DataFrame:
    """(doc_id, runs, collapsed) of every row of ``docs``.

    ``runs`` are all stretches of words with a smallest period p and max(least, 2 p) words or more that can't be extended, by
    start, then period. ``collapsed`` are the words that no run holds after its first p ones, joined by spaces. ``rewrite``
    may give, for a doc_id and a number of words, the numbers of the words to read instead.
    """
    stored = materialize(_read(docs, least, tile, rewrite), "runs-read")
    fragments = stored.where("period is not null").select("row", "period", "low", "high")
    long_ones = _solve_long(stored.where("tile is not null").select("row", "octave", "place", "first", "last", "tile"), least)
    found = stitch(fragments.unionByName(long_ones), least)
    runs = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "period", "length"))).alias("runs"))
    runs = runs.withColumn("runs", F.expr("transform(runs, r -> named_struct('start', r.start, 'length', r.length, 'period', r.period))"))
    whole = stored.where("body is not null").select("row", "doc_id", "body", "open")
    opened = whole.where("open").join(runs, "row", "left").withColumn("runs", F.coalesce("runs", F.array().cast(_RUNS)))
    closed = whole.where("not open").select("doc_id", F.array().cast(_RUNS).alias("runs"), F.col("body").alias("collapsed"))
    return _collapse(opened).unionByName(closed)
