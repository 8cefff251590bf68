"""Web archives: a deterministic sharded WARC writer and its reader.

Records are sorted by page_id and cut into shards of about equal payload bytes, so that the same
pages give the same files, byte for byte. Inside a shard a file ends when its compressed size
reaches a limit. Every record is a gzip member of its own with headers and digests made anew.
Files get their final names only when whole, and only files that the manifest lists count as written.

Defined results: a null payload or URL is empty; of equal payloads the smallest page_id is stored and the
others refer to it; rows repeated with one page_id are records of their own, each of the type its own payload
gives it; a null page_id sorts first and is a response unless a page with an id has the same payload;
an empty table gives an archive without files.
"""

from __future__ import annotations

import base64
import bisect
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from epiweave.llm.files import place, written
from epiweave.session import work_path

SHARD_BYTES = 1 << 26
FILE_BYTES = 1 << 25
DATE = "2024-01-01T00:00:00Z"
BINS = 4096
MANIFEST = "shard int, part int, file string, records long, bytes long, sha1 string"
RECORD = "page_id long, url string, payload binary, payload_bytes long, payload_digest string, record_type string, refers_to long, digest_ok boolean"


def shard_starts(sizes: DataFrame, shard_bytes: int) -> list[int]:
    """First page_id of each shard but the first, from (page_id, payload_bytes).

    Bytes are summed per range of ids, at most ``BINS`` ranges at a time; ranges that hold more than
    a shard are split further. What comes to the driver is a few numbers per shard.
    """
    ends = sizes.agg(F.min("page_id"), F.max("page_id")).first()
    if ends[0] is None:
        return []
    shift = max(0, (ends[1] - ends[0]).bit_length() - (BINS.bit_length() - 1))
    ranges: dict[int, int] = {}
    found = sizes.where("page_id is not null")
    while True:
        sums = found.groupBy(F.shiftright("page_id", shift).alias("bin")).agg(F.sum("payload_bytes").alias("b")).collect()
        heavy = [r.bin for r in sums if r.b > shard_bytes and shift]
        ranges.update({r.bin << shift: r.b for r in sums if not (r.b > shard_bytes and shift)})
        if not heavy:
            break
        finer = max(0, shift - 6)
        found = found.where(F.shiftright("page_id", shift).isin(heavy))
        shift = finer
    starts, held = [], 0
    for start in sorted(ranges):
        if held and held + ranges[start] > shard_bytes:
            starts.append(start)
            held = 0
        held += ranges[start]
    return starts


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str = DATE) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the page it equals."""
    digest = base32(hashlib.sha1(payload).digest())
    name = lambda page: uuid.uuid5(uuid.NAMESPACE_URL, f"page:{page}")
    kind, body = ("response", payload) if refers_to is None else ("revisit", b"")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + body
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name(page_id)}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join((url or '').split())}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{base32(hashlib.sha1(block).digest())}",
        f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        lines.append(f"X-Page-Id: {page_id}")
    if refers_to is not None:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:uuid:{name(refers_to)}>", f"X-Refers-To-Page-Id: {refers_to}",
        ]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _files(rows: Iterator[tuple], folder: str, file_bytes: int) -> Iterator[tuple]:
    """Writes records of sorted rows (shard, page_id, digest, url, html, refers_to, is_page); yields manifest rows."""
    waiting = next(rows, None)
    shard = part = None
    refers: tuple = (None, None, None)
    while waiting is not None:
        shard, part = waiting[0], (part + 1 if waiting[0] == shard else 0)
        name, count, size, sha = f"shard-{shard:06d}-{part:04d}.warc.gz", 0, 0, hashlib.sha1()
        with written(f"{folder}/{name}") as out:
            while waiting is not None and waiting[0] == shard and size < file_bytes:
                _, page_id, digest, url, html, to, is_page = waiting
                if is_page:
                    member = _member(record(page_id, url, (html or "").encode(), refers[2] if refers[:2] == (page_id, digest) else None))
                    out.write(member)
                    sha.update(member)
                    count, size = count + 1, size + len(member)
                else:
                    refers = (page_id, digest, to)
                waiting = next(rows, None)
        if count:
            yield shard, part, name, count, size, sha.hexdigest()


def write_warc(
    pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES
) -> DataFrame:
    """Write pages (page_id, url, html) below ``folder``; returns the manifest.

    Which pages are revisits is decided on ids and digests alone. The decisions travel with the
    pages in one shuffle: a narrow row with the id of the equal page sorts just before the pages of its page_id and digest.
    """
    spark = pages.sparkSession
    page = pages.select("page_id", "url", "html")
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    keyed = page.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), F.octet_length(payload).cast("long").alias("payload_bytes"))
    firsts = keyed.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    revisits = keyed.join(firsts, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")) & F.col("refers_to").isNotNull())
    starts = shard_starts(keyed.select("page_id", "payload_bytes"), shard_bytes)

    @F.pandas_udf("int")
    def shard_of(ids: pd.Series) -> pd.Series:
        return ids.map(lambda v: 0 if pd.isna(v) else bisect.bisect_right(starts, int(v))).astype("int32")

    rows = page.select("page_id", F.unhex(F.sha1(payload)).alias("digest"), "url", "html", F.lit(None).cast("long").alias("refers_to"), F.lit(1).alias("is_page")).unionByName(
        revisits.select("page_id", "digest", F.lit(None).cast("string").alias("url"), F.lit(None).cast("string").alias("html"), "refers_to", F.lit(0).alias("is_page"))
    )
    order = ["shard", F.col("page_id").asc_nulls_first(), "digest", "is_page", "url", "html"]
    sorted_rows = (
        rows.withColumn("shard", shard_of(F.col("page_id").cast("string")))
        .repartition(len(starts) + 1, "shard").sortWithinPartitions(*order)
        .select("shard", "page_id", "digest", "url", "html", "refers_to", "is_page")
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flat = (row for batch in batches for row in zip(*(c.to_pylist() for c in batch.columns)))
        for done in _files(flat, folder, file_bytes):
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in zip(done, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()))],
                names=["shard", "part", "file", "records", "bytes", "sha1"],
            )

    sorted_rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _members(stream) -> Iterator[bytes]:
    """Content of each gzip member of a file."""
    unpack, parts = zlib.decompressobj(31), []
    while data := stream.read(1 << 20):
        while data:
            parts.append(unpack.decompress(data))
            data = b""
            if unpack.eof:
                yield b"".join(parts)
                data, unpack, parts = unpack.unused_data, zlib.decompressobj(31), []
    if parts and any(parts):
        raise ValueError("the archive ends inside a record")


def parse(member: bytes) -> tuple:
    """(page_id, url, payload, payload_bytes, digest, type, refers_to, digest_ok) of a record."""
    head, _, rest = member.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    digest, kind = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields["WARC-Type"]
    number = lambda name: int(fields[name]) if name in fields else None
    ok = base32(hashlib.sha1(block).digest()) == fields["WARC-Block-Digest"].removeprefix("sha1:")
    if kind == "response":
        ok = ok and base32(hashlib.sha1(payload).digest()) == digest and len(payload) == number("X-Payload-Length")
    return number("X-Page-Id"), fields["WARC-Target-URI"], payload if kind == "response" else None, number("X-Payload-Length"), digest, kind, number("X-Refers-To-Page-Id"), ok


def read_warc(spark: SparkSession, folder: str, payloads: bool = True, strict: bool = False) -> DataFrame:
    """Records of all files in the manifest. ``payloads=False`` checks payloads but leaves them out; ``strict`` raises at a record
    whose digests or length are not those of its content, which ``digest_ok`` tells otherwise."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    types = (pa.int64(), pa.string(), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.bool_())
    names = [c.split()[0] for c in RECORD.split(", ")]

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, path = place(f"{folder}/{name}")
                rows, held = [], 0
                with system.open_input_stream(path, compression=None) as stream:
                    for member in _members(stream):
                        row = parse(member)
                        if strict and not row[-1]:
                            raise ValueError(f"{name}: the record of page {row[0]} is damaged")
                        rows.append(row if payloads else (*row[:2], None, *row[3:]))
                        held += len(member) if payloads else 0
                        if len(rows) == 1000 or held > 1 << 23:
                            yield out(rows)
                            rows, held = [], 0
                if rows:
                    yield out(rows)

    files = manifest.count()
    return manifest.select("file").repartition(max(1, files), "file").mapInArrow(read, RECORD)


def archive(pages: DataFrame, **options) -> DataFrame:
    """Write pages to a new folder in the shared place and read the records back; a damaged one is an error."""
    folder = work_path(pages.sparkSession, "warc")
    write_warc(pages, folder, **options)
    return read_warc(pages.sparkSession, folder, payloads=False, strict=True)
