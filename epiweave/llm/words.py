"""Words, hashes and word windows of many texts at once, as numpy arrays over their bytes.

Arrow hands a task the texts of a batch as one byte buffer with offsets. Separators are ASCII, so
words can be found on UTF-8 bytes without decoding. A hash is 64 bits wide and the same on every
machine and in every run.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 21
PIECE_BYTES = 1 << 18


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Table of 256 booleans that is true for bytes in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for low, high in ranges:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~byte_set((0x20, 0x20), (0x09, 0x0D))
LETTER_OR_DIGIT = byte_set((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF))
ASCII_LETTER = byte_set((0x41, 0x5A), (0x61, 0x7A))
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over all 64 bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    steps = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(steps + np.uint64(seed * 0xD1342543DE82EF95 % 2**64)) | np.uint64(1)


_BASE = 0x9E3779B97F4A7C15
_BYTE = constants(256, 1)
_LENGTH = np.uint64(0xC2B2AE3D27D4EB4F)


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.full(n + 1, _BASE, np.uint64), np.full(n + 1, pow(_BASE, -1, 2**64), np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(PIECE_BYTES, 1 << int(n - 1).bit_length() if n > 1 else 1))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts of a column and their n + 1 offsets; a null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    n = len(column)
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    ends = np.frombuffer(offsets, kind, n + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]], ends - ends[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, budget: int = SLICE_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of rows whose texts hold about ``budget`` bytes (or one longer text), with those bytes."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        row = 0
        while row < batch.num_rows:
            until = max(row + 1, int(np.searchsorted(offsets, offsets[row] + budget, "right")) - 1)
            until = min(until, batch.num_rows)
            part = offsets[row : until + 1]
            yield batch.slice(row, until - row), data[part[0] : part[-1]], part - part[0]
            row = until


def find_words(data: np.ndarray, offsets: np.ndarray, word_bytes: np.ndarray = NOT_SPACE):
    """(start, end, bounds): byte range of each word; the words of text i are bounds[i]:bounds[i+1]."""
    is_word = word_bytes[data]
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = is_word[:-1], is_word[1:]
    cuts = offsets[1:-1]
    before[cuts[cuts < len(data)]] = False
    after[cuts[cuts > 0] - 1] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray, fold: np.ndarray = LOWER) -> np.ndarray:
    """64-bit hash of each byte range; ranges are in order and do not overlap."""
    table, out, i = _BYTE[fold], np.empty(len(start), np.uint64), 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + PIECE_BYTES, "right")))
        low, high = int(start[i]), int(end[j - 1])
        up, down = powers(high - low)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(table[data[low:high]] * up[: high - low], out=sums[1:])
        first, last = start[i:j] - low, end[i:j] - low
        out[i:j] = mix((sums[last] - sums[first]) * down[first] + (last - first).astype(np.uint64) * _LENGTH)
        i = j
    return out


def word_hashes(data, offsets, word_bytes=NOT_SPACE, fold=LOWER):
    """(hashes, bounds) of the words of each text."""
    start, end, bounds = find_words(data, offsets, word_bytes)
    return hash_spans(data, start, end, fold), bounds


def combine(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hash of each run of ``width`` consecutive hashes, one for every place where a run starts."""
    n, factors = max(0, len(hashes) - width + 1), constants(width, 2 + width)
    total = np.zeros(n, np.uint64)
    for j in range(width):
        total += hashes[j : n + j] * factors[j]
    return mix(total)


def places_left(bounds: np.ndarray) -> np.ndarray:
    """For each word, how many words of its text follow, itself included."""
    n = int(bounds[-1])
    return np.repeat(bounds[1:], np.diff(bounds)) - np.arange(n)


def shingles(hashes: np.ndarray, bounds: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, bounds) of the windows of ``width`` words of each text. A text of fewer words, but
    not none, has one window: all of it."""
    lengths = np.diff(bounds)
    short = np.flatnonzero((lengths > 0) & (lengths < width))
    counts = np.maximum(lengths - width + 1, 0)
    counts[short] = 1
    out_bounds = np.concatenate([[0], np.cumsum(counts)])
    out = np.empty(out_bounds[-1], np.uint64)
    whole = np.zeros(len(short), np.uint64)
    for j, factor in enumerate(constants(width, 1000 + width)[: width - 1]):
        has = lengths[short] > j
        whole[has] += hashes[bounds[short[has]] + j] * factor
    is_short = np.zeros(len(out), bool)
    is_short[out_bounds[short]] = True
    out[is_short] = mix(whole + lengths[short].astype(np.uint64))
    full = combine(hashes, width)
    out[~is_short] = full[places_left(bounds)[: len(full)] >= width]
    return out, out_bounds


def distinct(hashes: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes of each text, and their bounds."""
    parts = [np.unique(hashes[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(p) for p in parts], np.int64)
    return (np.concatenate(parts) if parts else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def binary(rows: list[bytes | None]) -> pa.Array:
    return pa.array(rows, pa.binary())
