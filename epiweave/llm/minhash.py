"""MinHash signatures, banding, and clusters of near-equal texts with exact verification.

Texts that are equal as sets are one class; only classes meet. Classes that share a band's hash share a bucket.
Each member is compared with the bucket's smallest id first. Where a bucket still holds several
clusters after that, its members are compared with those of other clusters inside tasks, in blocks of
bounded size; only pairs that survive the comparison of signatures leave a task, the likeliest ones of each cluster first. They are
confirmed on the full sets, and clusters merge, before more are asked for. In buckets that have more than that, families of texts a little
under the threshold, the full sets come to the blocks and are compared there, and only links leave a task. So no bucket
is spread out into all its pairs and none is cut short.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from epiweave.llm.components import components
from epiweave.llm.memory import map_lean
from epiweave.llm.tables import if_small
from epiweave.llm.words import NOT_SPACE, LOWER, SAME, binary, constants, distinct, mix, shingles, slices, word_hashes
from epiweave.session import materialize

CACHE_SHINGLES = 1 << 15
BLOCK, BLOCK_BYTES = 4096, 32 << 20
STEP = 32
#: Rounds in which pairs are joined with texts, before full sets go to the blocks.
ROUNDS = 2


def bands_for(threshold: float, recall: float, rows: int) -> int:
    """Bands of ``rows`` hashes that a pair at the threshold shares at least one of with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def tune(threshold: float, recall: float, most: int = 64) -> tuple[int, int]:
    """(rows, bands) with the most rows, and so the fewest chance collisions, that stay within ``most`` hashes."""
    fits = [(r, bands_for(threshold, recall, r)) for r in range(1, 17)]
    return max((f for f in fits if f[0] * f[1] <= most), default=(1, most))


def signatures(sets: np.ndarray, bounds: np.ndarray, n: int) -> np.ndarray:
    """(texts, n) smallest value of each of ``n`` hash functions over each text's set; none may be empty."""
    factors = constants(n, 77)
    out = np.empty((len(bounds) - 1, n), np.uint64)
    i = 0
    while i < len(out):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + CACHE_SHINGLES, "right")) - 1)
        part, starts = sets[bounds[i] : bounds[j]], bounds[i:j] - bounds[i]
        room = np.empty_like(part)
        for k in range(n):
            np.multiply(part, factors[k], out=room)
            out[i:j, k] = np.minimum.reduceat(room, starts)
        i = j
    return out


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """(texts, bands) hash of each band of a signature, the band's number included."""
    bands = sig.shape[1] // rows
    parts = mix(sig[:, : bands * rows].reshape(len(sig), bands, rows))
    return mix((parts * constants(rows, 78)).sum(axis=2, dtype=np.uint64) + constants(bands, 79))


def packed(sig: np.ndarray) -> np.ndarray:
    """One byte of each hash: enough to estimate a similarity."""
    return (mix(sig) & np.uint64(255)).astype(np.uint8)


@lru_cache(maxsize=64)
def least_matches(n: int, threshold: float, miss: float) -> int:
    """Fewest of ``n`` equal hashes at which the similarity still reaches the threshold with a
    posterior probability of ``miss`` or more, from a uniform prior.

    With m of n equal the posterior is Beta(m + 1, n - m + 1), whose upper tail is a binomial sum.
    """
    tail = 0.0
    for m in range(n + 1):
        tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if tail >= miss:
            return m
    return n


def similar_enough(a: np.ndarray, b: np.ndarray, threshold: float, miss: float) -> tuple[np.ndarray, np.ndarray]:
    """(places, equal bytes) of the pairs of rows that no batch of hashes rules out, batch after batch."""
    at, equal = np.arange(len(a)), np.zeros(len(a), np.int32)
    for i in range(0, a.shape[1], STEP):
        equal = equal + (a[at, i : i + STEP] == b[at, i : i + STEP]).sum(axis=1, dtype=np.int32)
        stay = equal >= least_matches(min(i + STEP, a.shape[1]), threshold, miss)
        at, equal = at[stay], equal[stay]
    return at, equal


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a binary column of ``width`` bytes each."""
    return np.frombuffer(b"".join(v.as_py() for v in column), np.uint8).reshape(len(column), width)


def word_sets(column_batches, column: str, shingle: int, lower: bool = True):
    """(rows, distinct shingle hashes, bounds) for runs of rows."""
    for part, data, offsets in slices(column_batches, column):
        hashes, bounds = word_hashes(data, offsets, NOT_SPACE, LOWER if lower else SAME)
        yield part, *distinct(*shingles(hashes, bounds, shingle))


def signed(texts: DataFrame, shingle: int, width: int) -> DataFrame:
    """(id, n, sig) of texts (id, text) with words: size of the set and one byte of each of ``width`` hashes."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets, bounds in word_sets(batches, "text", shingle):
            sizes = np.diff(bounds)
            some = np.flatnonzero(sizes)
            if len(some):
                sig = packed(signatures(sets, np.concatenate([bounds[some], bounds[-1:]]), width))
                yield pa.RecordBatch.from_arrays(
                    [part.column("id").take(pa.array(some)), pa.array(sizes[some], pa.int64()), binary([s.tobytes() for s in sig])], names=["id", "n", "sig"]
                )

    return map_lean(texts.select("id", "text"), found, "id long, n long, sig binary")


def prune(pairs: DataFrame, width: int, threshold: float, miss: float) -> DataFrame:
    """Pairs (a, b, sig_a, sig_b) that may reach the threshold, as (a, b)."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, _ = similar_enough(matrix(batch.column("sig_a"), width), matrix(batch.column("sig_b"), width), threshold, miss)
            keep = pa.array(at)
            yield pa.RecordBatch.from_arrays([batch.column("a").take(keep), batch.column("b").take(keep)], names=["a", "b"])

    return map_lean(pairs.select("a", "b", "sig_a", "sig_b"), check, "a long, b long")


def linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    """Whether two sets without repeated members fulfil 100 * intersection >= percent * union; empty ones don't."""
    both = np.concatenate([x, y])
    both.sort()
    same = int((both[1:] == both[:-1]).sum())
    return len(both) > 0 and 100 * same >= percent * (len(both) - same)


def verify(pairs: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """(a, b, linked) of pairs (a, b): linked if 100 * intersection >= percent * union of the full sets."""
    one = texts.select(F.col("id").alias("a"), F.col("text").alias("text_a"))
    two = texts.select(F.col("id").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, first, fb in word_sets(iter([batch]), "text_a", shingle):
                yield from compared(part, first, fb)

    def compared(part: pa.RecordBatch, first: np.ndarray, fb: np.ndarray) -> Iterator[pa.RecordBatch]:
        row = 0
        for inner, second, sb in word_sets(iter([part]), "text_b", shingle):
            found = [linked(first[fb[row + k] : fb[row + k + 1]], second[sb[k] : sb[k + 1]], percent) for k in range(inner.num_rows)]
            row += inner.num_rows
            yield pa.RecordBatch.from_arrays([inner.column("a"), inner.column("b"), pa.array(found, pa.bool_())], names=["a", "b", "linked"])

    return map_lean(pairs.join(one, "a").join(two, "b"), check, "a long, b long, linked boolean")


def _open_blocks(members: DataFrame, clusters: DataFrame, classes: DataFrame) -> DataFrame:
    """Members of buckets in which several clusters have not met, in groups of at most two blocks.

    All members stand as targets; those outside the cluster of the bucket's first id also as
    queries. A large bucket is cut into blocks of targets and of queries, by rows and by the size of their sets, and each pair of blocks is a group.
    """
    now = members.join(clusters, "id", "left").withColumn("cluster", F.coalesce("component", "id")).drop("component")
    # a bucket's first id is a member itself, so the cluster that leads comes with the bucket's counts
    other = F.col("id") != F.col("pivot")
    unmet = now.groupBy("key").agg(
        F.max(F.when(~other, F.col("cluster"))).alias("lead"), F.min(F.when(other, F.col("cluster"))).alias("low"),
        F.max(F.when(other, F.col("cluster"))).alias("high"), F.count_if(other).alias("size"), F.sum(F.when(other, F.col("n"))).alias("weight"),
    ).where("low <> high")
    rows = materialize(now.where(other).join(unmet.drop("low", "high"), "key"), "unmet-members")
    asks = F.col("cluster") != F.col("lead")
    queries = rows.where(asks).groupBy("key").agg(F.count("*").alias("asking"), F.sum("n").alias("asking_weight"))
    rows = materialize(rows.join(queries, "key").join(classes.select("id", "sig"), "id"), "unmet")
    parts = lambda rows, weight: F.ceil(F.greatest(F.col(rows) / BLOCK, F.col(weight) * 8 / BLOCK_BYTES)).cast("int")
    blocks, ask_blocks = parts("size", "weight"), parts("asking", "asking_weight")
    spot = F.xxhash64("id")
    targets = rows.select(
        "key", F.pmod(spot, blocks).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), ask_blocks - 1)).alias("j"),
        F.lit(False).alias("asks"), "id", "n", "cluster", (~asks).alias("leading"), "band", "sig",
    )
    asking = rows.where(asks).select(
        "key", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("i"), F.pmod(spot, ask_blocks).cast("int").alias("j"),
        F.lit(True).alias("asks"), "id", "n", "cluster", F.lit(False).alias("leading"), "band", "sig",
    )
    return targets.unionByName(asking)


def _group_pairs(rows: pa.Table, width: int, band_rows: int, percent: int, miss: float, most: int) -> tuple[np.ndarray, np.ndarray, bool]:
    """(a, b, cut): pairs of different clusters in one group that may be linked, and whether some were left out.

    A pair counts in the first band that it shares only. Each asking cluster has its ``most`` likeliest pairs; the caller comes
    back for the rest. No more than that is held for any row while the group is read.
    """
    ask = rows.column("asks").to_numpy()
    ids, n, cluster, leading = (rows.column(c).to_numpy() for c in ("id", "n", "cluster", "leading"))
    band = int(rows.column("band")[0].as_py())
    sig = matrix(rows.column("sig").combine_chunks(), width)
    earlier = sig[:, : band * band_rows].reshape(len(sig), band, band_rows)
    targets, found, cut = np.flatnonzero(~ask), [], False
    for q in np.flatnonzero(ask):
        t = targets[(cluster[targets] != cluster[q]) & (leading[targets] | (ids[targets] < ids[q]))]
        t = t[(100 * np.minimum(n[t], n[q]) >= percent * np.maximum(n[t], n[q]))]
        if len(t):
            at, equal = similar_enough(sig[t], np.broadcast_to(sig[q], (len(t), width)), percent / 100, miss)
            first = ~(earlier[t[at]] == earlier[q]).all(axis=2).any(axis=1)
            at, equal = t[at[first]], equal[first]
            if len(at) > most:
                best = np.lexsort((ids[at], -equal))[:most]
                at, equal, cut = at[best], equal[best], True
            found.append((np.full(len(at), cluster[q]), -equal.astype(np.int64), ids[at], np.full(len(at), ids[q])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), False
    asking, unlike, a, b = (np.concatenate(x) for x in zip(*found))
    order = np.lexsort((b, a, unlike, asking))
    asking, a, b = asking[order], a[order], b[order]
    rank = np.arange(len(asking)) - np.searchsorted(asking, asking)
    keep = rank < most
    return np.minimum(a, b)[keep], np.maximum(a, b)[keep], cut or not keep.all()


def _group_links(rows: pa.Table, width: int, band_rows: int, percent: int, miss: float) -> list[tuple[int, int]]:
    """Links that join clusters of one group, found on the full sets in ``set``: no more than there are clusters.

    Pairs are those of :func:`_group_pairs`, all of them, the likeliest of each query first; pairs that links found before
    have brought together are passed over.
    """
    ask = rows.column("asks").to_numpy()
    ids, n, leading = (rows.column(c).to_numpy() for c in ("id", "n", "leading"))
    _, cluster = np.unique(rows.column("cluster").to_numpy(), return_inverse=True)
    sets = [np.frombuffer(v.as_py(), np.uint64) for v in rows.column("set")]
    band = int(rows.column("band")[0].as_py())
    sig = matrix(rows.column("sig").combine_chunks(), width)
    earlier = sig[:, : band * band_rows].reshape(len(sig), band, band_rows)
    targets, out = np.flatnonzero(~ask), []
    for q in np.flatnonzero(ask):
        t = targets[(cluster[targets] != cluster[q]) & (leading[targets] | (ids[targets] < ids[q]))]
        t = t[(100 * np.minimum(n[t], n[q]) >= percent * np.maximum(n[t], n[q]))]
        if not len(t):
            continue
        at, equal = similar_enough(sig[t], np.broadcast_to(sig[q], (len(t), width)), percent / 100, miss)
        first = ~(earlier[t[at]] == earlier[q]).all(axis=2).any(axis=1)
        for x in t[at[first]][np.argsort(-equal[first], kind="stable")]:
            if cluster[x] != cluster[q] and linked(sets[x], sets[q], percent):
                out.append((int(min(ids[x], ids[q])), int(max(ids[x], ids[q]))))
                cluster[cluster == cluster[x]] = cluster[q]
    return out


def _in_groups(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.Table]:
    """The rows of each group, one group at a time, of rows that are sorted by ``names``."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in names], axis=1)
        edges = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(keys)]
        for low, high in zip(edges[:-1], edges[1:]):
            if high > low:
                if last is not None and tuple(keys[low]) != last:
                    yield pa.Table.from_batches(held)
                    held = []
                last = tuple(keys[low])
                held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def _dealt(blocks: DataFrame) -> DataFrame:
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return blocks.repartition(n, "key", "i", "j").sortWithinPartitions("key", "i", "j")


def block_pairs(blocks: DataFrame, width: int, band_rows: int, percent: int, miss: float, most: int) -> DataFrame:
    """(a, b, cut) from all groups; a row with ``cut`` only says that the bucket a has more pairs."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_groups(batches, ["key", "i", "j"]):
            a, b, cut = _group_pairs(table, width, band_rows, percent, miss, most)
            if cut:
                key = [table.column("key")[0].as_py()]
                yield pa.RecordBatch.from_arrays([pa.array(key, pa.int64()), pa.array(key, pa.int64()), pa.array([True])], names=["a", "b", "cut"])
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(np.zeros(len(a), bool))], names=["a", "b", "cut"])

    return map_lean(_dealt(blocks), compare, "a long, b long, cut boolean")


def block_links(blocks: DataFrame, texts: DataFrame, shingle: int, width: int, band_rows: int, percent: int, miss: float) -> DataFrame:
    """Links (a, b) that join clusters, from all groups, compared on full sets."""

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets, bounds in word_sets(batches, "text", shingle):
            own = [sets[low:high].tobytes() for low, high in zip(bounds[:-1], bounds[1:])]
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(own, pa.binary())], names=["id", "set"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _in_groups(batches, ["key", "i", "j"]):
            found = _group_links(table, width, band_rows, percent, miss)
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    wanted = materialize(blocks.select("id").distinct(), "set-ids")
    sets = materialize(map_lean(texts.join(if_small(wanted), "id", "left_semi"), sets_of, "id long, set binary"), "sets")
    return map_lean(_dealt(blocks.join(sets, "id")), compare, "a long, b long")


def cluster(
    classes: DataFrame, fetch: Callable[[DataFrame], DataFrame], shingle: int, percent: int, width: int, band_rows: int, miss: float, first: int = 2
) -> DataFrame:
    """(id, component) of all classes that are linked with another one.

    ``classes`` has id, n (size of the set), keys (band hashes) and sig (``width`` bytes, those of the bands first). Without
    sig, only classes that share a bucket are signed, from their texts. ``fetch`` turns ids into (id, text). Links are pairs with 100 * intersection >= percent * union. Inside buckets the
    ``first`` likeliest pairs of each cluster are confirmed before all others: most clusters merge by
    them, and pairs within one cluster need no comparison. Buckets with more pairs come again with four times
    as many, and what is left after ``ROUNDS`` rounds is settled on full sets inside the blocks.
    """
    threshold = percent / 100
    buckets = classes.select("id", "n", F.posexplode("keys").alias("band", "key"))
    shared = buckets.groupBy("key").agg(F.min("id").alias("pivot"), F.count("*").alias("size")).where("size > 1").drop("size")
    members = materialize(buckets.join(shared, "key"), "buckets")
    wanted = materialize(members.select("id").distinct(), "candidates")
    texts = materialize(fetch(wanted), "texts")
    if texts.count() > wanted.count():  # equal rows of the input
        texts = materialize(texts.dropDuplicates(["id"]), "texts")
    if "sig" not in classes.columns:
        classes = materialize(signed(texts, shingle, width), "signed")
    one = classes.select(F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("sig").alias("sig_a"))
    two = classes.select(F.col("id").alias("b"), F.col("sig").alias("sig_b"))
    stars = members.where("id <> pivot").select(F.col("pivot").alias("a"), F.col("id").alias("b"), "n").distinct()
    stars = stars.join(one, "a").where(f"100 * least(n, n_a) >= {percent} * greatest(n, n_a)").join(two, "b")
    tested = materialize(verify(prune(stars, width, threshold, miss), texts, shingle, percent), "verified")
    clusters = materialize(components(tested.where("linked")), "clusters")
    most, left = first, members

    def merged(links: DataFrame) -> DataFrame:
        if links.isEmpty():
            return clusters
        stars = clusters.select(F.col("id").alias("a"), F.col("component").alias("b"))
        return materialize(components(stars.unionByName(links)), "clusters")

    for _ in range(ROUNDS):
        met = materialize(block_pairs(_open_blocks(left, clusters, classes), width, band_rows, percent, miss, most), "met")
        new = met.where("not cut").select("a", "b").distinct().join(tested.select("a", "b"), ["a", "b"], "left_anti")
        more = materialize(verify(new, texts, shingle, percent), "verified")
        clusters = merged(more.where("linked").select("a", "b"))
        again = materialize(met.where("cut").select(F.col("a").alias("key")).distinct(), "buckets-left")
        if again.isEmpty():
            return clusters
        left = materialize(members.join(if_small(again), "key", "left_semi"), "members-left")
        tested, most = tested.unionByName(more), 4 * most
    blocks = materialize(_open_blocks(left, clusters, classes), "blocks")
    return merged(materialize(block_links(blocks, texts, shingle, width, band_rows, percent, miss), "block-links"))


def fetch_documents(docs: DataFrame, classes: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Texts of classes by id: each is that of the document ``doc`` whose text has the hash ``mark``."""

    def fetch(ids: DataFrame) -> DataFrame:
        wanted = materialize(classes.select("id", "doc", "mark").join(ids, "id", "left_semi"), "wanted")
        texts = docs.select(F.col("doc_id").cast("long").alias("doc"), "text", F.xxhash64("text").alias("mark"))
        return texts.join(if_small(wanted), ["doc", "mark"]).select("id", "text")

    return fetch
