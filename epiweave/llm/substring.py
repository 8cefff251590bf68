"""Passages that repeat across documents: paragraph MinHash banding with exact verification.

Paragraphs are the lines of a text. Equal paragraphs are one class; classes of at least ``LEAST`` words are
banded with bands tuned for high recall, colliding ones are confirmed by exact Jaccard similarity of
their word shingles, and linked classes form components. A passage may also start or end inside a line,
so sentences count as paragraphs too, matched when equal. Every component belongs to the document
with the smallest doc_id that holds it; its occurrences in other documents are repeats. Repeats that touch, or
are only a few words apart, form spans, and spans of at least ``SPAN`` words are removed.

Defined results: null texts have no paragraphs; rows with a null doc_id stay as they are; rows that repeat a doc_id are
one owner; a paragraph that repeats inside one document only is left alone; an empty table gives an
empty result; rows that repeat a doc_id with different texts are cut each by its own paragraphs; result columns are the operator's own, or exactly those of the input for the cleaned table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.llm.memory import map_lean
from epiweave.llm.mixing import word_count
from epiweave.llm.minhash import band_keys, cluster, signatures, tune
from epiweave.llm.tables import if_small
from epiweave.llm.words import NOT_SPACE, byte_set, constants, distinct, find_words, hash_spans, mix, powers, shingles, slices
from epiweave.session import materialize

SHINGLE, PERCENT, RECALL, MOST_HASHES = 5, 80, 0.99, 36
#: Paragraphs of fewer words are only matched when equal, those of fewer than PIECE words not at all.
LEAST, PIECE = 9, 5
GAP, SPAN = 4, 25
#: Hashes of a signature, those of the bands included, and the bound of each look at them: over all five looks a pair of
#: lines at similarity 0.8 is lost with probability 4e-5, besides the 1 - RECALL by the bands.
HASHES, MISS = 160, 1e-5
NOT_NEWLINE = ~byte_set((0x0A, 0x0A))
STOP = np.isin(np.arange(256), np.frombuffer(b".!?", np.uint8))


def sequence_hashes(hashes: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hash of each run of words first:last (word numbers, in order)."""
    up, down = powers(len(hashes) + 1)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * constants(1, 91)[0])


def paragraphs(data: np.ndarray, offsets: np.ndarray):
    """(words, lines, pieces): word hashes with bounds; lines and pieces as (text, first, last) by word number.

    Pieces are the sentences of lines that hold more than one.
    """
    start, end, bounds = find_words(data, offsets)
    hashes = hash_spans(data, start, end)
    line_start, line_end, line_bounds = find_words(data, offsets, NOT_NEWLINE)
    first, last = np.searchsorted(start, line_start), np.searchsorted(start, line_end)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(line_bounds))
    some = last > first
    first, last, text = first[some], last[some], text[some]
    line_cut = np.zeros(len(hashes), bool)
    line_cut[last - 1] = True
    ends = np.flatnonzero(line_cut | STOP[data[end - 1]]) + 1 if len(end) else np.zeros(0, np.int64)
    begins = np.concatenate([[0], ends[:-1]]) if len(ends) else ends
    line_of = np.searchsorted(first, begins, "right") - 1
    inner = (begins != first[line_of]) | (ends != last[line_of]) if len(ends) else np.zeros(0, bool)
    return (hashes, bounds), (text, first, last), (text[line_of][inner], begins[inner], ends[inner])


def units(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, line, first, last, id) of all lines and pieces of at least ``PIECE`` words; first and last
    are word numbers in the document, ``mark`` is a hash of its text."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text"):
            (hashes, bounds), lines, pieces = paragraphs(data, offsets)
            ids, marks = part.column("doc_id"), part.column("mark")
            for is_line, (text, first, last) in ((True, lines), (False, pieces)):
                keep = last - first >= PIECE
                text, first, last = text[keep], first[keep], last[keep]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(text)), marks.take(pa.array(text)), pa.array(np.full(len(text), is_line)), pa.array((first - bounds[text]).astype(np.int32)),
                        pa.array((last - bounds[text]).astype(np.int32)), pa.array(sequence_hashes(hashes, first, last).view(np.int64)),
                    ],
                    names=["doc_id", "mark", "line", "first", "last", "id"],
                )

    plain = docs.where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").alias("_text"))
    return map_lean(plain, found, "doc_id long, mark long, line boolean, first int, last int, id long")


def line_classes(docs: DataFrame, shingle: int, rows: int, bands: int, least: int) -> DataFrame:
    """(id, n, keys) of the distinct lines of at least ``least`` words. Few of them share a bucket; only those get
    the longer signatures by which pairs are compared, so no more than the bands' hashes are taken of the others."""

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text"):
            (hashes, bounds), (text, first, last), _ = paragraphs(data, offsets)
            keep = last - first >= least
            text, first, last = text[keep], first[keep], last[keep]
            if not len(first):
                continue
            ids, place = np.unique(sequence_hashes(hashes, first, last), return_index=True)
            first, last = first[place], last[place]
            sizes = last - first
            inner = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(first - inner[:-1], sizes) + np.arange(inner[-1])
            sets, set_bounds = distinct(*shingles(hashes[at], inner, shingle))
            keys = band_keys(signatures(sets, set_bounds, rows * bands), rows).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids.view(np.int64)), pa.array(np.diff(set_bounds), pa.int64()), pa.array(list(keys), pa.list_(pa.int64()))], names=["id", "n", "keys"]
            )

    plain = docs.where("doc_id is not null").select(F.col("text").alias("_text"))
    rows_of = map_lean(plain, banded, "id long, n long, keys array<long>")
    return rows_of.groupBy("id").agg(*[F.first(c).alias(c) for c in ("n", "keys")])


def fetch_lines(docs: DataFrame, found: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Texts of lines by id, each taken from the first document that has it."""

    def fetch(ids: DataFrame) -> DataFrame:
        places = found.where("line").join(if_small(ids), "id", "left_semi").groupBy("id").agg(F.min(F.struct("doc_id", "mark", "first", "last")).alias("p"))
        places = materialize(places.groupBy(F.col("p.doc_id").alias("_doc"), F.col("p.mark").alias("_mark")).agg(F.collect_list(F.struct("id", "p.first", "p.last")).alias("lines")), "places")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, offsets in slices(iter([batch]), "_text"):
                    start, end, bounds = find_words(data, offsets)
                    ids, texts = [], []
                    for i, lines in enumerate(part.column("lines").to_pylist()):
                        for line in lines:
                            low, high = bounds[i] + line["first"], bounds[i] + line["last"]
                            if high <= bounds[i + 1]:
                                ids.append(line["id"])
                                texts.append(data[start[low] : end[high - 1]].tobytes().decode())
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string())], names=["id", "text"])

        own = docs.select(F.col("doc_id").cast("long").alias("_doc"), F.xxhash64("text").alias("_mark"), F.col("text").alias("_text"))
        own = own.join(if_small(places), ["_doc", "_mark"]).select("_text", "lines")
        return map_lean(own, cut, "id long, text string").dropDuplicates(["id"])

    return fetch


def join_spans(found: list[tuple[int, int]], gap: int, least: int) -> list[tuple[int, int]]:
    """Ranges of word numbers that overlap or are at most ``gap`` words apart as one, if at least ``least`` words long."""
    out: list[list[int]] = []
    for first, last in sorted(found):
        if out and first - out[-1][1] <= gap:
            out[-1][1] = max(out[-1][1], last)
        else:
            out.append([first, last])
    return [(a, b) for a, b in out if b - a >= least]


SPANS = "array<struct<first:int,last:int>>"


def repeats(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, recall: float = RECALL, gap: int = GAP, span: int = SPAN
) -> DataFrame:
    """(doc_id, mark, spans, removed) of the documents that repeat passages of other documents; stored."""
    rows, bands = tune(percent / 100, recall, MOST_HASHES)
    found = materialize(units(docs), "units")
    classes = materialize(line_classes(docs, shingle, rows, bands, LEAST), "lines")
    clusters = cluster(classes, fetch_lines(docs, found), shingle, percent, HASHES, rows, MISS)
    holders = found.groupBy("id").agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last_doc"))
    linked = holders.join(if_small(clusters), "id")
    first = linked.groupBy("component").agg(F.min("owner").alias("owner"))
    linked = linked.select("id", "component").join(first, "component").select("id", "owner")
    equal = holders.where("owner <> last_doc").select("id", "owner")
    owners = materialize(equal.unionByName(linked).groupBy("id").agg(F.min("owner").alias("owner")), "owners")
    flagged = found.join(if_small(owners), "id").where("doc_id <> owner")
    lists = flagged.groupBy("doc_id", "mark").agg(F.collect_set(F.struct("first", "last")).alias("found"))

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
        for batch in batches:
            rows = [join_spans([(u["first"], u["last"]) for u in row], gap, span) for row in batch.column("found").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array([[{"first": a, "last": b} for a, b in r] for r in rows], kind), pa.array([sum(b - a for a, b in r) for r in rows], pa.int64())],
                names=["doc_id", "mark", "spans", "removed"],
            )

    return materialize(map_lean(lists, spans, f"doc_id long, mark long, spans {SPANS}, removed long").where("removed > 0"), "repeats")


def report(docs: DataFrame, **options) -> DataFrame:
    """doc_id, n_words, n_spans, removed_words, kept_words and repeated of every row of ``docs``."""
    found = repeats(docs, **options).select(F.col("doc_id").alias("_doc"), "mark", F.size("spans").cast("long").alias("_spans"), "removed")
    sized = docs.select("doc_id", word_count(F.col("text")).alias("n_words"), F.xxhash64("text").alias("_mark"))
    sized = sized.join(if_small(found), (F.col("doc_id") == F.col("_doc")) & (F.col("mark") == F.col("_mark")), "left")
    removed = F.coalesce("removed", F.lit(0))
    return sized.select(
        "doc_id", "n_words", F.coalesce("_spans", F.lit(0)).alias("n_spans"), removed.alias("removed_words"),
        (F.col("n_words") - removed).alias("kept_words"), (removed > 0).alias("repeated"),
    )


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with spans cut out of ``text`` and ``n_chars``, if there, counted anew for those texts.
    Documents that consist of repeats alone are left out."""
    columns = docs.columns
    found = repeats(docs, **options).select(F.col("doc_id").alias("_doc"), F.col("mark").alias("_mark"), "spans")
    names = {c: f"c{i}" for i, c in enumerate(columns)}
    plain = docs.select(*[F.col(f"`{c}`").alias("_text" if c == "text" else names[c]) for c in columns])
    joined = plain.join(if_small(found), (F.col(names["doc_id"]) == F.col("_doc")) & (F.xxhash64("_text") == F.col("_mark")), "left").drop("_doc", "_mark")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in joined.schema if f.name != "spans") + ", cut boolean"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, offsets in slices(iter([batch]), "_text"):
                start, end, bounds = find_words(data, offsets)
                texts, lists = part.column("_text").to_pylist(), part.column("spans").to_pylist()
                for i, spans in enumerate(lists):
                    if spans:
                        at, pieces = int(offsets[i]), []
                        for s in spans:
                            pieces.append(data[at : start[bounds[i] + s["first"]]].tobytes().decode())
                            at = int(end[bounds[i] + s["last"] - 1])
                        texts[i] = "".join([*pieces, data[at : offsets[i + 1]].tobytes().decode()]).strip()
                own = [n for n in part.schema.names if n != "spans"]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(texts, pa.string()) if n == "_text" else part.column(n) for n in own] + [pa.array([bool(s) for s in lists], pa.bool_())],
                    names=[*own, "cut"],
                )

    done = map_lean(joined, cut, schema).where(~F.col("cut") | (word_count(F.col("_text")) > 0))
    out = []
    for c in columns:
        value = F.col("_text" if c == "text" else names[c])
        if c == "n_chars":
            value = F.when(F.col("cut"), F.length("_text").cast(docs.schema[c].dataType)).otherwise(value)
        out.append(value.alias(c))
    return done.select(*out)
