"""WARC records in seekable Zstandard bundles.

A bundle is one file: independent Zstandard frames of about ``frame_bytes`` of records,
then a skippable frame with the seek table of the Zstandard seekable format. Bundles are
made per input partition and written with Spark's own text sink, so they reach any file
system that Spark reaches and a retried task leaves nothing behind: each file holds one
row, whose line end is the four magic bytes that close a seek table. The index maps each
record identifier to its bundle, frame and offset inside the unpacked frame."""

from __future__ import annotations

import base64
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qrelmill.llm.work import Work, table

# Fixed values of the Zstandard seekable format and of WARC 1.1.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD_URN = "urn:x-page:"

CLOSING = struct.pack("<I", SEEKABLE_MAGIC)
RECORD_SCHEMA = (
    "bundle string, frame int, frame_offset long, offset long, length long, record_id string, record_type string, "
    "refers_to string, url string, payload_digest string, payload_bytes long, payload binary"
)


def _record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None) -> bytes:
    """One record; a revisit keeps the HTTP head, whose length is that of the full payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_URN}{'null' if page_id is None else page_id}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        "WARC-Payload-Digest: sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode(),
        "Content-Type: application/http;msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if revisit:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <{RECORD_URN}{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def seal(frames: list[tuple[bytes, int]]) -> bytes:
    """A bundle of compressed frames with their raw sizes, without the four closing bytes."""
    entries = b"".join(struct.pack("<II", len(data), raw) for data, raw in frames)
    table_ = entries + struct.pack("<IB", len(frames), 0)
    head = struct.pack("<II", SKIPPABLE_MAGIC, len(table_) + len(CLOSING))
    return b"".join(data for data, _ in frames) + head + table_


def seek_table(content: bytes) -> list[tuple[int, int, int]]:
    """(offset, compressed size, raw size) of each frame, from the footer alone."""
    if content[-4:] != CLOSING:
        raise ValueError("no seek table at the end of the bundle")
    count, flags = struct.unpack("<IB", content[-9:-4])
    width = 12 if flags & 0x80 else 8
    start = len(content) - 9 - count * width
    out, at = [], 0
    for i in range(count):
        packed, raw = struct.unpack_from("<II", content, start + i * width)
        out.append((at, packed, raw))
        at += packed
    return out


def _parse(data: bytes, at: int) -> tuple[dict[str, str], bytes, int]:
    """(head fields, block, end) of the record at ``at`` of an unpacked frame."""
    end = data.index(b"\r\n\r\n", at)
    fields = dict(line.split(": ", 1) for line in data[at:end].decode().split("\r\n")[1:])
    start = end + 4
    stop = start + int(fields["Content-Length"])
    return fields, data[start:stop], stop + 4


def _pack(frame_bytes: int, bundle_bytes: int, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=level)
        frames: list[tuple[bytes, int]] = []
        records: list[bytes] = []
        raw = packed = 0

        def close_frame() -> None:
            nonlocal raw, packed
            if records:
                data = packer.compress(b"".join(records))
                frames.append((data, raw))
                packed += len(data)
                records.clear()
                raw = 0

        def close_bundle() -> Iterator[pa.RecordBatch]:
            nonlocal packed
            close_frame()
            if frames:
                yield pa.RecordBatch.from_arrays([pa.array([seal(frames)], pa.binary())], ["content"])
                frames.clear()
                packed = 0

        for batch in batches:
            columns = [batch.column(c) for c in ("page_id", "url", "payload", "digest", "refers_to")]
            for i in range(batch.num_rows):
                record = _record(*(c[i].as_py() for c in columns))
                if raw and raw + len(record) > frame_bytes:
                    close_frame()
                    if packed >= bundle_bytes:
                        yield from close_bundle()
                records.append(record)
                raw += len(record)
        yield from close_bundle()

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema(
        [
            ("bundle", pa.string()),
            ("frame", pa.int32()),
            ("frame_offset", pa.int64()),
            ("offset", pa.int64()),
            ("length", pa.int64()),
            ("record_id", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.string()),
            ("url", pa.string()),
            ("payload_digest", pa.string()),
            ("payload_bytes", pa.int64()),
            ("payload", pa.binary()),
        ]
    )
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist(), strict=True):
            for n, (offset, packed, raw) in enumerate(seek_table(content)):
                data = unpacker.decompress(content[offset : offset + packed], max_output_size=raw)
                rows, at = [], 0
                while at < len(data):
                    fields, block, end = _parse(data, at)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    rows.append(
                        {
                            "bundle": path,
                            "frame": n,
                            "frame_offset": offset,
                            "offset": at,
                            "length": end - at,
                            "record_id": fields["WARC-Record-ID"].strip("<>"),
                            "record_type": fields["WARC-Type"],
                            "refers_to": fields["WARC-Refers-To"].strip("<>") if "WARC-Refers-To" in fields else None,
                            "url": fields.get("WARC-Target-URI"),
                            "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
                            "payload_bytes": int(http.rpartition(b"Content-Length: ")[2]),
                            "payload": payload if fields["WARC-Type"] == "response" else None,
                        }
                    )
                    at = end
                yield pa.RecordBatch.from_pylist(rows, schema=schema)


def plan_records(pages: DataFrame, work: Work, min_bytes: int = 1000) -> DataFrame:
    """page_id, url, payload, digest, refers_to: which record each page becomes.

    Of equal payloads of ``min_bytes`` or more the largest page_id is the response. Only
    one row per task and digest is shuffled, and only digests seen twice come back."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", payload.alias("payload"))
    exact = F.unhex(F.sha2(F.col("payload"), 256))
    long = F.octet_length("payload") >= min_bytes
    repeated = work.save(
        rows.filter(long)
        .select(exact.alias("same"), "page_id")
        .groupBy("same")
        .agg(F.max("page_id").alias("response_id"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n"),
        "repeated",
    )
    refers = F.when(F.coalesce(F.col("page_id") != F.col("response_id"), F.col("response_id").isNotNull()), F.col("response_id"))
    return (
        rows.withColumn("same", F.when(long, exact))
        .join(repeated, "same", "left")
        .select("page_id", "url", "payload", F.sha1("payload").alias("digest"), refers.alias("refers_to"))
    )


def write_bundles(
    records: DataFrame, path: str, frame_bytes: int = 256 << 10, bundle_bytes: int = 8 << 20, level: int = 3
) -> None:
    """Write records (page_id, url, payload, digest, refers_to) as bundles below ``path``.

    A frame holds whole records, at least one; a bundle is closed after ``bundle_bytes``."""
    (
        records.mapInArrow(_pack(frame_bytes, bundle_bytes, level), "content binary")
        .select(F.col("content").cast("string").alias("value"))
        .write.option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", CLOSING.decode("latin-1"))
        .text(path)
    )


def read_bundles(spark: SparkSession, path: str) -> DataFrame:
    """All records of the bundles below ``path``, with their place (see RECORD_SCHEMA)."""
    files = spark.read.format("binaryFile").load(path).filter("length > 4").select("path", "content")
    return files.mapInArrow(_unpack, RECORD_SCHEMA)


def build_index(spark: SparkSession, path: str) -> DataFrame:
    """record_id to (bundle, frame, frame_offset, offset, length)."""
    return read_bundles(spark, path).select("record_id", "bundle", "frame", "frame_offset", "offset", "length")


def fetch(spark: SparkSession, path: str, index: DataFrame, record_ids: DataFrame) -> DataFrame:
    """The records named by ``record_ids`` (record_id): only their frames are unpacked."""
    places = (
        index.join(record_ids.distinct(), "record_id")
        .groupBy("bundle")
        .agg(F.collect_list(F.struct("record_id", "frame", "offset")).alias("places"))
    )
    files = spark.read.format("binaryFile").load(path).select(F.col("path").alias("bundle"), "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker = zstandard.ZstdDecompressor()
        for batch in batches:
            for places_, content in zip(batch.column("places").to_pylist(), batch.column("content").to_pylist(), strict=True):
                frames = seek_table(content)
                for n in sorted({p["frame"] for p in places_}):
                    at, packed, raw = frames[n]
                    data = unpacker.decompress(content[at : at + packed], max_output_size=raw)
                    for p in places_:
                        if p["frame"] == n:
                            _, block, _ = _parse(data, p["offset"])
                            yield pa.RecordBatch.from_pydict(
                                {"record_id": [p["record_id"]], "payload": [block.partition(b"\r\n\r\n")[2]]}
                            )

    return files.join(places, "bundle").select("places", "content").mapInArrow(run, "record_id string, payload binary")


def _page_id(column: str):
    return F.regexp_extract(column, f"^{RECORD_URN}(-?[0-9]+)$", 1).try_cast("long")


def archive(pages: DataFrame, min_bytes: int = 1000) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles and read the bundles back.

    One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.
    A null html is an empty payload. A page with a null id is a revisit when an equal
    payload has an id, and a response otherwise. Pages that repeat the id of their response
    are responses too. An empty table gives an empty archive. Other columns are not read."""
    spark = pages.sparkSession
    work = Work(spark, "warc")
    write_bundles(plan_records(pages, work, min_bytes), work.path("bundles"))
    read = read_bundles(spark, work.path("bundles"))
    # The digest of a response is taken from the payload that was read.
    digest = F.when(F.col("payload").isNotNull(), F.sha1("payload")).otherwise(F.col("payload_digest"))
    size = F.when(F.col("payload").isNotNull(), F.octet_length("payload").cast("long")).otherwise(F.col("payload_bytes"))
    return read.select(
        _page_id("record_id").alias("page_id"),
        size.alias("payload_bytes"),
        digest.alias("payload_digest"),
        "record_type",
        _page_id("refers_to").alias("refers_to"),
    )


def op9_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes FROM pages),
g AS (SELECT payload, max(page_id) AS response_id FROM p WHERE payload_bytes >= 1000 GROUP BY payload)
SELECT p.page_id, p.payload_bytes, sha1(p.payload) AS payload_digest,
       CASE WHEN g.response_id <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.response_id <> p.page_id THEN g.response_id END AS refers_to
FROM p LEFT JOIN g ON p.payload = g.payload AND p.payload_bytes >= 1000
"""
