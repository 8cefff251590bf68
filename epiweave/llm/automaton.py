"""Benchmark decontamination with a generalised suffix automaton over the words of test items.

The automaton holds every run of words of every item. A document's words are streamed through it,
which gives the longest run of item words that ends at each word. Words that cannot be part of a run
as long as the shortest window are skipped first: a run of g words matches only where its
g-word hash is one of the items', so the automaton starts at the first such place and stops
after the last, which changes no length of g or more.

Defined results: null texts have no words; items without words are never found; equal items are
all reported; items too many for one automaton are taken in blocks whose results are joined; a
repeated document row gets its own result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.llm.memory import Step, map_lean
from epiweave.llm.words import LETTER_OR_DIGIT, LOWER, binary, combine, find_words, hash_spans, places_left, slices

WINDOW = 10
BLOCK_WORDS = 50_000
FILTER_BITS = 22


class Automaton:
    """States have a transition per next word, a suffix link and the length of their longest run."""

    def __init__(self, items: list[list[int]], window: int = WINDOW):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[int]] = {}
        whole: dict[int, list[tuple[int, int]]] = {}
        for index, words in enumerate(items):
            state = 0
            for word in words:
                state = self._add(state, word)
                ends.setdefault(state, set()).add(index)
        # which items contain a state's runs: those whose words end in it or in a state below it
        for state in sorted(range(1, len(self.link)), key=lambda s: -self.length[s]):
            if state in ends and self.link[state] > 0:
                ends.setdefault(self.link[state], set()).update(ends[state])
        for index, words in enumerate(items):
            if 0 < len(words) < window:
                state = 0
                for word in words:
                    state = self.next[state][word]
                whole.setdefault(state, []).append((len(words), index))
        self.whole = whole
        self.full: list[tuple[int, ...]] = [()] * len(self.link)
        self.short: list[tuple[tuple[int, int], ...]] = [()] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=lambda s: self.length[s]):
            up = self.link[state]
            # the state of the last `window` words, seen from a longer run
            self.full[state] = self.full[up] if self.length[up] >= window else tuple(sorted(ends.get(state, ()))) if self.length[state] >= window else ()
            self.short[state] = self.short[up] + tuple(whole.get(state, ()))

    def _new(self, length: int, link: int, transitions: dict[int, int]) -> int:
        self.next.append(transitions)
        self.link.append(link)
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, state: int, word: int) -> int:
        """The state of ``state``'s longest run plus ``word``, cut out of a longer one if need be."""
        after = self.next[state][word]
        if self.length[after] == self.length[state] + 1:
            return after
        copy = self._new(self.length[state] + 1, self.link[after], dict(self.next[after]))
        self.link[after] = copy
        while state >= 0 and self.next[state].get(word) == after:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _add(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        state = self._new(self.length[last] + 1, 0, {})
        while last >= 0 and word not in self.next[last]:
            self.next[last][word] = state
            last = self.link[last]
        if last >= 0:
            self.link[state] = self._split(last, word)
        return state

    def scan(self, words: list[int]) -> Iterator[tuple[int, int, tuple[int, ...]]]:
        """(place, matched words that count, items) for each word at which a window ends."""
        state = size = 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            else:
                size = 0
            found, items = (size, self.full[state]) if size >= self.window else (0, ())
            for length, item in self.short[state]:
                if length <= size:
                    found, items = max(found, length), (*items, item)
            if found:
                yield place, found, items


class Block:
    """Automaton of some items with the filter of runs that can match."""

    def __init__(self, ids: list, items: list[np.ndarray], window: int = WINDOW):
        keep = [i for i, words in enumerate(items) if len(words)]
        self.ids, items = [ids[i] for i in keep], [items[i] for i in keep]
        self.automaton = Automaton([words.tolist() for words in items], window)
        self.width = min((min(len(words), window) for words in items), default=1)
        runs = [combine(words, self.width) for words in items]
        self.runs = np.unique(np.concatenate(runs)) if runs else np.zeros(0, np.uint64)
        self.sieve = np.zeros(1 << FILTER_BITS, bool)
        self.sieve[self.runs >> np.uint64(64 - FILTER_BITS)] = True

    def places(self, hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of word ranges, each within one text, outside of which no window ends."""
        runs = combine(hashes, self.width)
        at = np.flatnonzero(self.sieve[runs >> np.uint64(64 - FILTER_BITS)])
        at = at[places_left(bounds)[at] >= self.width]
        slot = np.minimum(np.searchsorted(self.runs, runs[at]), max(0, len(self.runs) - 1))
        at = at[self.runs[slot] == runs[at]] if len(self.runs) else at[:0]
        if not len(at):
            return at, at
        text = np.searchsorted(bounds, at, "right")
        new = np.flatnonzero(np.concatenate([[True], (np.diff(at) > 1) | (np.diff(text) > 0)]))
        return at[new], at[np.concatenate([new[1:] - 1, [len(at) - 1]])] + self.width


def item_blocks(benchmark: DataFrame, block_words: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Items with their word hashes, streamed to the driver, in blocks of about ``block_words`` words."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "text"):
            start, end, bounds = find_words(data, offsets, LETTER_OR_DIGIT)
            words = hash_spans(data, start, end, LOWER)
            yield pa.RecordBatch.from_arrays(
                [part.column("item_id"), binary([words[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])])], names=["item_id", "words"]
            )

    ids, items, held = [], [], 0
    rows = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(hashed, "item_id string, words binary")
    for row in rows.toLocalIterator():
        words = np.frombuffer(bytes(row.words), np.uint64)
        if items and held + len(words) > block_words:
            yield ids, items
            ids, items, held = [], [], 0
        ids.append(row.item_id)
        items.append(words)
        held += len(words)
    yield ids, items


RESULT = "n_words long, n_hit long, spans array<struct<first:int,last:int>>, items array<string>"
SPANS = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The same places as disjoint ranges in order."""
    out: list[tuple[int, int]] = []
    for first, last in sorted(spans):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(last, out[-1][1]))
        else:
            out.append((first, last))
    return out


def _scan(docs: DataFrame, block: Block, keep_text: bool, then: tuple[Step, str] | None = None) -> DataFrame:
    """One pass over ``_text``; adds to the spans and items of the pass before, if there was one.

    ``then``, a further step and its schema, has the result's batches in the same worker, so that a task needs no second one for it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(block)
    done = ("n_words", "n_hit", "spans", "items")
    kept = [f for f in docs.schema if f.name not in done and (keep_text or f.name != "_text")]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", " + RESULT

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = shared.value
        for part, data, offsets in slices(batches, "_text"):
            start, end, bounds = find_words(data, offsets, LETTER_OR_DIGIT)
            hashes = hash_spans(data, start, end, LOWER)
            spans: list[list[tuple[int, int]]] = [[] for _ in range(part.num_rows)]
            items: list[set] = [set() for _ in range(part.num_rows)]
            if "spans" in part.schema.names:
                spans = [[(s["first"], s["last"]) for s in row] for row in part.column("spans").to_pylist()]
                items = [set(row) for row in part.column("items").to_pylist()]
            for low, high in zip(*block.places(hashes, bounds)):
                text = int(np.searchsorted(bounds, low, "right")) - 1
                before = int(low - bounds[text]) + 1
                for place, found, which in block.automaton.scan(hashes[low:high].tolist()):
                    items[text].update(block.ids[i] for i in which)
                    spans[text].append((before + place - found, before + place))
            spans = [joined(row) for row in spans]
            hit = [sum(last - first for first, last in row) for row in spans]
            yield pa.RecordBatch.from_arrays(
                [part.column(f.name) for f in kept] + [
                    pa.array(np.diff(bounds)), pa.array(hit, pa.int64()),
                    pa.array([[{"first": a, "last": b} for a, b in row] for row in spans], SPANS),
                    pa.array([sorted(row, key=lambda v: (v is not None, v)) for row in items], pa.list_(pa.string())),
                ],
                names=[*(f.name for f in kept), *done],
            )

    if then is None:
        return map_lean(docs, scan, schema)
    step, schema = then
    return map_lean(docs, lambda batches: step(scan(batches)), schema)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS, keep_text: bool = False, then: tuple[Step, str] | None = None
) -> DataFrame:
    """``docs`` with n_words, n_hit, spans and items; its own columns of these names give way. With ``then``, what that step makes of them.

    ``spans`` are disjoint ranges of word numbers inside occurrences of item windows; ``items`` the
    ids, as sorted strings, of the items that have an occurring window. Items beyond ``block_words``
    words are looked for by further passes, so an automaton that is sent to the tasks stays small.
    """
    names = [c for c in docs.columns if c not in ("n_words", "n_hit", "spans", "items", "text")]
    found = docs.select(*names, F.col("text").alias("_text"))
    blocks = list(item_blocks(benchmark, block_words))
    for k, (ids, items) in enumerate(blocks):
        last = k + 1 == len(blocks)
        found = _scan(found, Block(ids, items, window), keep_text or not last, then if last else None)
    return found.withColumnRenamed("_text", "text") if keep_text and then is None else found


def without_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """Text without the words of the spans and the bytes between them; a space marks each cut inside the text."""
    data = np.frombuffer(text.encode(), np.uint8)
    start, end, _ = find_words(data, np.array([0, len(data)]), LETTER_OR_DIGIT)
    parts, at = [], 0
    for first, last in spans:
        parts.append(data[at : start[first]].tobytes())
        at = int(end[last - 1])
    parts.append(data[at:].tobytes())
    return b" ".join(p.strip() for p in parts if p.strip()).decode() if spans else text


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5, min_hit: int = 1
) -> DataFrame:
    """``docs`` with item spans cut out of ``text``; documents of which more than ``max_coverage``
    of the words belong to spans are left out. ``n_chars``, if there, is counted anew for texts that
    were cut. Documents with fewer than ``min_hit`` words in spans stay as they are."""
    columns = docs.columns
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias("text" if c == "text" else names[c]) for c in columns])
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.drop("text").schema) + ", _text string, cut boolean"
    most = Fraction(repr(float(max_coverage)))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            few = [h * most.denominator <= n * most.numerator for h, n in zip(batch.column("n_hit").to_pylist(), batch.column("n_words").to_pylist())]
            batch = batch.filter(pa.array(few, pa.bool_()))
            for part, _, _ in slices(iter([batch]), "_text"):
                texts, hits = part.column("_text").to_pylist(), part.column("n_hit").to_pylist()
                spans = part.column("spans").to_pylist()
                is_cut = [h >= min_hit and h > 0 for h in hits]
                new = [without_spans(t, [(s["first"], s["last"]) for s in sp]) if c else t for t, sp, c in zip(texts, spans, is_cut)]
                own = [n for n in part.schema.names if n not in ("n_words", "n_hit", "spans", "items")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(new, pa.string()) if n == "_text" else part.column(n) for n in own] + [pa.array(is_cut, pa.bool_())], names=[*own, "cut"]
                )

    done = find_leaks(plain, benchmark, window, keep_text=True, then=(cut, schema))
    out = []
    for c in columns:
        value = F.col("_text" if c == "text" else names[c])
        if c == "n_chars":
            value = F.when(F.col("cut"), F.length("_text").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return done.select(*out)
