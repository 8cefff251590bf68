"""Statistics of whole texts: counts of characters, words, lines and repetitions, one row per document.

A null text counts as empty and has zeros everywhere. The counts are exact; shares derived from
them are plain columns, see :func:`shares`.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from epiweave.llm.words import (
    ASCII_LETTER, LOWER, NOT_SPACE, SAME, byte_set, combine, find_words, hash_spans, places_left, slices,
)

REPEAT_WINDOW = 8
SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
CHARACTER = ~byte_set((0x80, 0xBF))  # one such byte per code point
UPPER, DIGIT = byte_set((0x41, 0x5A)), byte_set((0x30, 0x39))
MARK = byte_set((0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E))
NOT_NEWLINE = ~byte_set((0x0A, 0x0A))
COUNTS = [
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_distinct_words",
    "n_upper", "n_digits", "n_marks", "n_letters", "n_short_words", "n_long_words", "n_sentences", "max_word_chars", "top_word", "n_repeat_pairs",
]


def _within(table: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bytes of each text that are in the table."""
    sums = np.concatenate([[0], np.cumsum(table[data], dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def keyed(hashes: np.ndarray, text: np.ndarray, n: int) -> np.ndarray:
    """The number of the text in the high bits, as much of the hash as fits below. Sorting these
    brings equal hashes of one text together without moving anything else."""
    bits = np.uint64(max(1, int(n).bit_length()))
    return (text.astype(np.uint64) << (np.uint64(64) - bits)) | (hashes >> bits)


def _runs(keys: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, size) of each group of equal keys."""
    keys = np.sort(keys)
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    bits = np.uint64(max(1, int(n).bit_length()))
    return (keys[first] >> (np.uint64(64) - bits)).astype(np.int64), keys[first], np.diff(first, append=len(keys))


def _most(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Largest value of each text, 0 for none."""
    out = np.zeros(len(bounds) - 1, np.int64)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        out[some] = np.maximum.reduceat(values, bounds[some])
    return out


def count_statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    n = len(offsets) - 1
    start, end, bounds = find_words(data, offsets)
    hashes = hash_spans(data, start, end, SAME)
    words = np.diff(bounds)
    text = np.repeat(np.arange(n), words)
    chars = np.concatenate([[0], np.cumsum(CHARACTER[data], dtype=np.int64)])
    sizes = chars[end] - chars[start]
    out = {
        "n_words": words, "word_chars": np.bincount(text, sizes, n).astype(np.int64),
        "n_chars": chars[offsets[1:]] - chars[offsets[:-1]],
        "n_symbols": _within(SYMBOL, data, offsets), "n_upper": _within(UPPER, data, offsets), "n_digits": _within(DIGIT, data, offsets),
        "n_marks": _within(MARK, data, offsets), "n_letters": _within(ASCII_LETTER | ~byte_set((0, 0x7F)) & CHARACTER, data, offsets),
        "n_short_words": np.bincount(text, sizes <= 2, n).astype(np.int64), "n_long_words": np.bincount(text, sizes >= 12, n).astype(np.int64),
    }
    last = data[end - 1] if len(end) else np.zeros(0, np.uint8)
    out["n_sentences"] = np.bincount(text, np.isin(last, np.frombuffer(b".!?", np.uint8)), n).astype(np.int64)
    owner, _, times = _runs(keyed(hashes, text, n), n)
    out["n_distinct_words"] = np.bincount(owner, minlength=n)
    out["top_word"] = _most(times, np.searchsorted(owner, np.arange(n + 1)))
    # words inside windows that occur twice or more in their text
    left = places_left(bounds)
    for width, name in ((REPEAT_WINDOW, "n_repeat_words"), (2, "n_repeat_pairs")):
        windows = combine(hashes, width)
        at = np.flatnonzero(left[: len(windows)] >= width)
        keys = keyed(windows[at], text[at], n)
        _, group, times = _runs(keys, n)
        twice = group[times > 1]
        slot = np.minimum(np.searchsorted(twice, keys), max(0, len(twice) - 1))
        again = at[twice[slot] == keys] if len(twice) else at[:0]
        cover = np.bincount(again, minlength=len(hashes) + 1) - np.bincount(again + width, minlength=len(hashes) + 1)
        out[name] = np.bincount(text, np.cumsum(cover[:-1]) > 0, n).astype(np.int64)
    # lines with a word that equal an earlier line
    line_start, line_end, line_bounds = find_words(data, offsets, NOT_NEWLINE)
    has_word = np.searchsorted(start, line_end) > np.searchsorted(start, line_start)
    line_text = np.repeat(np.arange(n), np.diff(line_bounds))[has_word]
    lines = hash_spans(data, line_start[has_word], line_end[has_word], SAME)
    out["n_lines"] = np.bincount(line_text, minlength=n)
    owner, _, _ = _runs(keyed(lines, line_text, n), n)
    out["n_dup_lines"] = out["n_lines"] - np.bincount(owner, minlength=n)
    out["max_word_chars"] = _most(sizes, bounds)
    return out


def document_statistics(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """``keep`` columns (doc_id by default) and the counts of each whole text."""
    keep = ["doc_id"] if keep is None else keep
    fields = [docs.schema[c] for c in keep]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + "".join(f", {c} long" for c in COUNTS)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, offsets in slices(batches, "_text"):
            found = count_statistics(data, offsets)
            yield pa.RecordBatch.from_arrays(
                [part.column(c) for c in keep] + [pa.array(found[c], pa.int64()) for c in COUNTS], names=[*keep, *COUNTS]
            )

    return docs.select(*keep, F.col("text").alias("_text")).mapInArrow(count, schema)


def _per(part: str, whole: str) -> Column:
    return F.col(part) / F.greatest(F.col(whole), F.lit(1))




def shares() -> dict[str, Column]:
    """Features derived from the counts; all are defined for empty texts."""
    return {
        "words": F.log1p(F.col("n_words").cast("double")),
        "mean_word": _per("word_chars", "n_words"),
        "longest_word": F.log1p(F.col("max_word_chars").cast("double")),
        "symbols": _per("n_symbols", "n_chars"),
        "dup_lines": _per("n_dup_lines", "n_lines"),
        "repeats": _per("n_repeat_words", "n_words"),
        "repeat_pairs": _per("n_repeat_pairs", "n_words"),
        "distinct": _per("n_distinct_words", "n_words"),
        "top_word_share": _per("top_word", "n_words"),
        "upper": _per("n_upper", "n_letters"),
        "digits": _per("n_digits", "n_chars"),
        "marks": _per("n_marks", "n_chars"),
        "letters": _per("n_letters", "n_chars"),
        "short_words": _per("n_short_words", "n_words"),
        "long_words": _per("n_long_words", "n_words"),
        "sentence_words": _per("n_words", "n_sentences"),
        "line_words": _per("n_words", "n_lines"),
    }
