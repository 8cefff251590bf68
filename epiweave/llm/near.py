"""Near-duplicate documents: banded MinHash candidates, sequential Bayesian verification, exact confirmation.

Signatures of candidates are compared batch by batch. A pair is dropped once the posterior probability that
its similarity reaches the threshold falls below ``miss``; survivors are confirmed on full shingle sets.

Defined results: null texts and texts without words have an empty set and are linked with nothing;
rows with a null doc_id are kept and belong to no group; rows that repeat a doc_id are judged each by its own text, so
that one of them can stay while another one goes;
of texts with equal sets the smallest doc_id stays; an empty table gives an empty result; the result
has doc_id and its own columns only, so other columns can't clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.llm.memory import map_lean
from epiweave.llm.minhash import band_keys, cluster, fetch_documents, packed, signatures, word_sets
from epiweave.llm.tables import if_small
from epiweave.llm.words import binary
from epiweave.session import materialize

SHINGLE, PERCENT = 5, 80
#: 32 bands of 5 hashes miss a pair at similarity 0.8 with probability 3e-6. Three times as many hashes again sharpen the comparison.
ROWS, BANDS, HASHES = 5, 32, 640
#: Bound of each look at the signatures; over all twenty looks a pair at similarity 0.8 is lost with probability 6.5e-6.
MISS = 5e-7


def sign(docs: DataFrame, shingle: int, rows: int, bands: int, hashes: int) -> DataFrame:
    """doc_id, mark (a hash of the text), n_shingles and, for texts with words, a digest of the set, band hashes and signature bytes."""

    def signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets, bounds in word_sets(batches, "_text", shingle):
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            keys, sig, digests = ([None] * part.num_rows for _ in range(3))
            if len(some):
                found = signatures(sets, np.concatenate([bounds[some], bounds[-1:]]), hashes)
                for i, k, s in zip(some, band_keys(found[:, : rows * bands], rows).view(np.int64), packed(found)):
                    keys[i], sig[i] = k, s.tobytes()
                    digests[i] = hashlib.blake2b(sets[bounds[i] : bounds[i + 1]].tobytes(), digest_size=16).digest()
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("mark"), pa.array(sizes, pa.int64()), binary(digests), pa.array(keys, pa.list_(pa.int64())), binary(sig)],
                names=["doc_id", "mark", "n_shingles", "digest", "keys", "sig"],
            )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").alias("_text"))
    return map_lean(texts, signed, "doc_id long, mark long, n_shingles long, digest binary, keys array<long>, sig binary")


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS, hashes: int = HASHES,
    miss: float = MISS,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``.

    Documents are linked if 100 * intersection >= percent * union of their sets of ``shingle``-word shingles.
    """
    found = _judged(docs, shingle, percent, rows, bands, hashes, miss)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def _judged(docs: DataFrame, shingle: int, percent: int, rows: int, bands: int, hashes: int, miss: float) -> DataFrame:
    """As :func:`near_duplicates`, with the hash of each row's text."""
    signed = materialize(sign(docs, shingle, rows, bands, hashes), "signed")
    known = signed.where("digest is not null and doc_id is not null")
    one = known.groupBy("digest").agg(F.min(F.struct("doc_id", "mark")).alias("one"), *[F.first(c).alias(c) for c in ("n_shingles", "keys", "sig")])
    one = one.select("digest", F.col("one.doc_id").alias("doc"), "one.mark", F.col("n_shingles").alias("n"), "keys", "sig")
    classes = materialize(one.withColumn("id", F.monotonically_increasing_id()), "classes")
    clusters = cluster(classes, fetch_documents(docs, classes), shingle, percent, hashes, rows, miss)
    linked = materialize(clusters.join(classes.select("id", "doc"), "id"), "linked")
    first = materialize(linked.groupBy("component").agg(F.min("doc").alias("root")), "roots")
    linked = linked.join(if_small(first), "component").select("id", "root")
    roots = classes.select("digest", "id", "doc").join(linked, "id", "left").select("digest", F.coalesce("root", "doc").alias("root"))
    found = signed.select("doc_id", "mark", "n_shingles", "digest").join(roots, "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return found.select(
        "doc_id", "mark", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")
    )


def without_near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, rows: int = ROWS, bands: int = BANDS, hashes: int = HASHES, miss: float = MISS
) -> DataFrame:
    """Rows of ``docs`` whose document stays."""
    found = _judged(docs, shingle, percent, rows, bands, hashes, miss).where("not kept")
    dropped = materialize(found.select(F.col("doc_id").alias("_dropped"), F.col("mark").alias("_mark")).distinct(), "dropped")
    same = (F.col("doc_id") == F.col("_dropped")) & (F.xxhash64("text") == F.col("_mark"))
    return docs.join(if_small(dropped), same, "left_anti")
