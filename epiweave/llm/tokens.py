"""Token counts of flat token files by scanning for the end-of-document identifier.

A flat file is nothing but 16-bit identifiers, little endian, with one end identifier after each
document, and no index. Files are cut into blocks that are scanned independently: one vectorised comparison gives all
separators of a block. What is open at a block's start is the sum of the tails before it back to the last
separator, which a prefix scan over one small row per block yields.

Defined results: a null text is a document of no tokens; a file that doesn't end with a separator holds a last,
unended document if tokens follow the last separator; a file of odd length is an error; an empty table gives no files
and an empty result.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from epiweave.llm.files import place, written
from epiweave.llm.words import slices
from epiweave.session import materialize, work_path

END = 50256
BLOCK_TOKENS = 1 << 22
FILE_BYTES = 1 << 28


def tokenizer_path() -> str:
    """Vocabulary file: ``EPIWEAVE_TOKENIZER``, or the byte-level one of the machine's public tokenizers."""
    return os.environ.get("EPIWEAVE_TOKENIZER", "/opt/tokenizers/byte_bpe_multi_50k.tiktoken")


@lru_cache(maxsize=1)
def load(path: str):
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding("flat", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_tokens(docs: DataFrame, folder: str, vocabulary: str, end: int = END, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Write the texts as flat token files below ``folder``, each task its own; returns the stored
    (file, ordinal, doc_id, bytes), where bytes is the file's size on its last document and null on the others."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load(vocabulary)
        texts = ((i, "" if t is None else t) for part, _, _ in slices(batches, "_text") for i, t in zip(part.column("doc_id").to_pylist(), part.column("_text").to_pylist()))
        waiting, number = next(texts, None), 0
        while waiting is not None:
            name, ids, size = f"tokens-{TaskContext.get().partitionId():06d}-{number:04d}.bin", [], 0
            with written(f"{folder}/{name}") as out:
                while waiting is not None and size < file_bytes:
                    found = np.array([*encoding.encode_ordinary(waiting[1]), end], "<u2").tobytes()
                    out.write(found)
                    ids.append(waiting[0])
                    size += len(found)
                    waiting = next(texts, None)
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(ids)), pa.array(range(len(ids)), pa.int64()), pa.array(ids, pa.int64()), pa.array([None] * (len(ids) - 1) + [size], pa.int64())],
                names=["file", "ordinal", "doc_id", "bytes"],
            )

    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("_text"))
    return materialize(plain.mapInArrow(write, "file string, ordinal long, doc_id long, bytes long"), "token-files")


def find_ends(tokens: np.ndarray, end: int = END) -> tuple[np.ndarray, int]:
    """Tokens before each separator since the one before it or the block's start, and tokens after the last one."""
    at = np.flatnonzero(tokens == end)
    return np.diff(at, prepend=-1) - 1, int(len(tokens) - (at[-1] + 1 if len(at) else 0))


def count_tokens(spark: SparkSession, folder: str, files: DataFrame, end: int = END, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(file, ordinal, n_tokens, ended) of each document in the files (file, bytes) of ``folder``."""
    blocks = files.select(
        "file", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.greatest("bytes", F.lit(1)) - 1) / (2 * block_tokens)))).alias("block")
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, size, block in zip(*(batch.column(c).to_pylist() for c in ("file", "bytes", "block"))):
                if size % 2:
                    raise ValueError(f"{name} has an odd number of bytes")
                system, path = place(f"{folder}/{name}")
                with system.open_input_file(path) as file:
                    file.seek(2 * block_tokens * block)
                    tokens = np.frombuffer(file.read(min(2 * block_tokens, size - 2 * block_tokens * block)), "<u2")
                before, after = find_ends(tokens, end)
                n = len(before)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * (n + 1)), pa.array([block] * (n + 1), pa.int64()), pa.array([*range(n), None], pa.int64()), pa.array([*before.tolist(), after], pa.int64()), pa.array([None] * n + [n], pa.int64())],
                    names=["file", "block", "place", "tokens", "ends"],
                )

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = materialize(
        blocks.repartition(n, "file", "block").mapInArrow(scan, "file string, block long, place long, tokens long, ends long"), "token-ends"
    )
    # prefix scan: blocks without a separator add to what is open, the others start it anew
    order = Window.partitionBy("file").orderBy("block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    tails = found.where("place is null").select("file", "block", "tokens", "ends").withColumn("run", F.sum((F.col("ends") > 0).cast("long")).over(order))
    open_run = Window.partitionBy("file", "run").orderBy("block")
    tails = tails.withColumn("open", F.sum("tokens").over(open_run)).withColumn("first", F.coalesce(F.sum("ends").over(before), F.lit(0)))
    tails = tails.withColumn("carry", F.coalesce(F.lag("open").over(order), F.lit(0)))
    ended = found.where("place is not null").select("file", "block", "place", "tokens").join(tails.select("file", "block", "carry", "first"), ["file", "block"])
    ended = ended.select("file", (F.col("first") + F.col("place")).alias("ordinal"), (F.col("tokens") + F.when(F.col("place") == 0, F.col("carry")).otherwise(0)).alias("n_tokens"), F.lit(True).alias("ended"))
    last = Window.partitionBy("file").orderBy(F.col("block").desc())
    rest = tails.withColumn("_last", F.row_number().over(last)).where("_last = 1 and open > 0")
    rest = rest.select("file", (F.col("first") + F.col("ends")).alias("ordinal"), F.col("open").alias("n_tokens"), F.lit(False).alias("ended"))
    return ended.unionByName(rest)


def document_tokens(docs: DataFrame, vocabulary: str | None = None, **options) -> DataFrame:
    """(doc_id, file, ordinal, n_tokens) of every row: texts are written as flat files, which are then scanned."""
    spark = docs.sparkSession
    folder = work_path(spark, "flat")
    listed = write_tokens(docs, folder, vocabulary or tokenizer_path(), **options)
    files = listed.where("bytes is not null").select("file", "bytes")
    return listed.drop("bytes").join(count_tokens(spark, folder, files), ["file", "ordinal"]).select("doc_id", "file", "ordinal", "n_tokens")
