"""Two-pass external shuffle into shards: records are scattered into buckets that fit in memory, each bucket is shuffled and written.

First pass: a seeded hash of the whole record picks its bucket, so that buckets are equal but for chance; Spark's shuffle
carries the records there. Equal records are numbered within a task and hashed with that number, so that a record which is
repeated any number of times is spread like different ones. Second pass: each bucket, in the order of its hashes, goes through a
seeded Fisher-Yates shuffle and is written with its place. One behind another the buckets are a shuffle of all records; shards are
equal cuts of that order, found from the buckets' sizes.

As long as no two records are equal in all columns, the order depends on records and seed only, not on files, tasks or machines. Equal
records are numbered task by task, so that with them the order also depends on how they are spread over tasks. Defined results: a null text has no bytes; null ids and repeated rows are records like others; fewer records
than shards leave shards empty; an empty table gives an empty result. All columns of the input are kept in ``record``, so that
none clashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructField, StructType, LongType

from epiweave.llm.tables import if_small
from epiweave.session import materialize

SHARDS = 8
SEED = 20
#: Size that a bucket has on average. There are at least LEAST_BUCKETS, so that small tables are spread too.
BUCKET_BYTES, LEAST_BUCKETS = 64 << 20, 64
ROW_BYTES = 64
OFFSET_BLOCK = 1024


def fisher_yates(n: int, draw: np.random.Generator) -> np.ndarray:
    """A permutation of 0 to n - 1: from the last place down, each is swapped with a drawn one not behind it."""
    order = list(range(n))
    if n > 1:
        for i, j in zip(range(n - 1, 0, -1), draw.integers(0, np.arange(n, 1, -1)).tolist()):
            order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def text_size(text: str) -> Column:
    """Bytes of a text plus one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


@F.pandas_udf(LongType())
def copy_number(keys: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """How often a key came before in the same task."""
    seen: dict[int, int] = {}
    for batch in keys:
        earlier = batch.map(seen).fillna(0).astype("int64")
        yield batch.groupby(batch).cumcount() + earlier
        counts = batch.value_counts()
        for key, count in counts.items():
            seen[key] = seen.get(key, 0) + int(count)


def scatter(docs: DataFrame, text: str, seed: int, buckets: int) -> DataFrame:
    """(bucket, spot, size, text_crc32, record) of each row: its bucket, and a hash that orders it there."""
    whole = [F.to_json(F.col(f"`{f.name}`")) if isinstance(f.dataType, MapType) else F.col(f"`{f.name}`") for f in docs.schema]
    rows = docs.select(
        F.xxhash64(F.lit(seed), *whole).alias("key"), text_size(text).alias("size"), F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record"),
    )
    spread = rows.withColumn("spot", F.xxhash64(F.lit(seed + 1), "key", copy_number("key")))
    return spread.select(F.pmod(F.xxhash64(F.lit(seed + 2), "spot"), F.lit(buckets)).cast("int").alias("bucket"), "spot", "size", "text_crc32", "record")


def shuffle_buckets(scattered: DataFrame, seed: int, buckets: int) -> DataFrame:
    """Rows of each bucket in shuffled order, with their position in it. A task holds one bucket at a time."""
    schema = StructType([*scattered.schema.fields, StructField("position", LongType())])

    def shuffled(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held)
        bucket = rows.column("bucket")[0].as_py()
        order = fisher_yates(len(rows), np.random.default_rng([seed, bucket]))
        places = np.arange(len(rows))
        for i in range(0, len(rows), 1024):
            part = rows.take(pa.array(order[i : i + 1024])).append_column("position", pa.array(places[i : i + 1024]))
            yield from part.combine_chunks().to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            numbers = batch.column("bucket").to_numpy()
            edges = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
            for low, high in zip(edges[:-1], edges[1:]):
                if held and high > low and held[-1].column("bucket")[0].as_py() != numbers[low]:
                    yield from shuffled(held)
                    held = []
                if high > low:
                    held.append(batch.slice(low, high - low))
        if held:
            yield from shuffled(held)

    return scattered.repartitionById(buckets, "bucket").sortWithinPartitions("bucket", "spot").mapInArrow(run, schema)


def offsets(counts: DataFrame) -> DataFrame:
    """(bucket, offset): the records in all buckets before, summed by blocks of buckets and then within them."""
    blocks = counts.withColumn("block", F.floor(F.col("bucket") / OFFSET_BLOCK))
    before = lambda order: order.rowsBetween(Window.unboundedPreceding, -1)
    sums = blocks.groupBy("block").agg(F.sum("n").alias("whole")).withColumn("base", F.sum("whole").over(before(Window.orderBy("block"))))
    inner = F.sum("n").over(before(Window.partitionBy("block").orderBy("bucket")))
    both = blocks.withColumn("inner", inner).join(sums.select("block", "base"), "block")
    return both.select("bucket", (F.coalesce("base", F.lit(0)) + F.coalesce("inner", F.lit(0))).alias("offset"))


def shard(
    docs: DataFrame, text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, least_buckets: int = LEAST_BUCKETS
) -> DataFrame:
    """(shard, slot, size, text_crc32, bucket, position, record) of every row: all rows in a seeded random order, cut into shards whose
    numbers of rows differ by one at most. ``slot`` counts from 0 in each shard. The stored table behind it holds the buckets in their order."""
    total = docs.agg(F.sum(text_size(text) + ROW_BYTES)).first()[0] or 0
    buckets = max(least_buckets, -(-total // bucket_bytes))
    stored = materialize(shuffle_buckets(scatter(docs, text, seed, buckets), seed, buckets).drop("spot"), "shuffled")
    counts = materialize(stored.groupBy("bucket").agg(F.count("*").alias("n")), "bucket-sizes")
    n = counts.agg(F.sum("n")).first()[0] or 0
    starts = [k * n // shards for k in range(shards)]
    placed = stored.join(if_small(materialize(offsets(counts), "bucket-offsets")), "bucket").withColumn("place", F.col("offset") + F.col("position"))
    number = sum((F.col("place") >= start).cast("int") for start in starts[1:]) if shards > 1 else F.lit(0)
    first = F.element_at(F.array(*[F.lit(start).cast("long") for start in starts]), F.col("shard") + 1)
    placed = placed.withColumn("shard", number).withColumn("slot", F.col("place") - first)
    return placed.select("shard", "slot", "size", "text_crc32", "bucket", "position", "record")


def write_shards(placed: DataFrame, path: str) -> None:
    """A folder for each shard and in it one for each of its buckets, whose rows are in the order of slots."""
    n = max(1, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = placed.repartition(n, "shard", "bucket").sortWithinPartitions("shard", "bucket", "position")
    rows.select("record", "size", "text_crc32", "slot", "shard", "bucket").write.partitionBy("shard", "bucket").parquet(path)
