"""WARC records in seekable Zstandard bundles.

A bundle is a sequence of independent Zstandard frames of about ``FRAME_BYTES`` of records each,
then one skippable frame that holds a seek table: per frame its compressed and uncompressed size.
The file ends with the table's length and a magic number, so a reader finds the table from the
end, and ordinary Zstandard tools still decompress the whole file. Beside the bundles an index
maps every record identifier to (bundle, frame, offset inside the frame), so one record, or any
run of frames, is read without touching the rest.

Of the records with equal payloads of at least ``min_revisit`` bytes the one with the largest page
id is the response; the others are revisits of it without a body. Smaller payloads are always
responses. Equality is by SHA-256 of the payload.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .runtime import materialize, open_shared, scratch

FRAME_BYTES = 1 << 20
FRAMES_A_TASK = 16
# Skippable-frame magic, seekable-format magic, and the WARC/1.1 revisit profile.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

INDEX = "bundle string, frame int, frame_at bigint, frame_size bigint, offset bigint, record_id string"


def record(page_id: int, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One WARC/1.1 record. The original length of a revisit's payload is kept in its own field."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    kind = "response" if refers_to is None else "revisit"
    body = payload if refers_to is None else b""
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        "Content-Type: text/html; charset=utf-8",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head.append(f"Content-Length: {len(body)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse(data: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """(fields in lower case, body, end) of the record at ``at``."""
    split = data.index(b"\r\n\r\n", at)
    lines = data[at:split].decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("no WARC record here")
    fields = {k.lower(): v for k, v in (line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])}
    begin, size = split + 4, int(fields["content-length"])
    return fields, data[begin : begin + size], begin + size + 4


class BundleWriter:
    """Write records to a file object; ``close`` appends the seek table."""

    def __init__(self, file, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.file, self.frame_bytes = file, frame_bytes
        self.zstd = zstandard.ZstdCompressor(level=level, write_content_size=True)
        self.held: list[bytes] = []
        self.names: list[str] = []
        self.size = self.at = 0
        self.frames: list[tuple[int, int]] = []

    def add(self, name: str, data: bytes) -> list[tuple]:
        """Index rows (frame, frame_at, frame_size, offset, name) of a frame that this record filled."""
        self.held.append(data)
        self.names.append(name)
        self.size += len(data)
        return self.flush() if self.size >= self.frame_bytes else []

    def flush(self) -> list[tuple]:
        if not self.held:
            return []
        packed = self.zstd.compress(b"".join(self.held))
        self.file.write(packed)
        rows, offset = [], 0
        for name, data in zip(self.names, self.held):
            rows.append((len(self.frames), self.at, len(packed), offset, name))
            offset += len(data)
        self.frames.append((len(packed), offset))
        self.at += len(packed)
        self.held, self.names, self.size = [], [], 0
        return rows

    def close(self) -> None:
        table = b"".join(struct.pack("<II", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)
        self.file.close()


def seek_table(file, size: int) -> list[tuple[int, int]]:
    """(position, compressed size) of each frame, from the footer of an open bundle."""
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    file.seek(size - 9 - 8 * count)
    at, out = 0, []
    for packed, _ in struct.iter_unpack("<II", file.read(8 * count)):
        out.append((at, packed))
        at += packed
    return out


def with_revisits(pages: DataFrame, min_revisit: int = 0) -> DataFrame:
    """(page_id, url, payload BINARY, refers_to): null html is an empty payload.

    Every row has a record, rows that repeat an id as well: where the largest id of a payload
    occurs more than once, all its rows are responses. Rows without an id have none.
    """
    rows = pages.where("page_id is not null").select(F.col("page_id").cast("bigint").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    keyed = rows.withColumn("_k", F.sha2("payload", 256))
    again = keyed.where(F.octet_length("payload") >= min_revisit).groupBy("_k").agg(F.max("page_id").alias("_first"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = materialize(again.select(F.col("_k").alias("_rk"), "_first"), "revisits")
    marked = keyed.join(again, F.col("_k") == F.col("_rk"), "left") if not again.isEmpty() else keyed.withColumn("_first", F.lit(None).cast("bigint"))
    return marked.select("page_id", "url", "payload", F.when(F.col("_first") != F.col("page_id"), F.col("_first")).alias("refers_to"))


def write_bundles(records: DataFrame, folder: str, frame_bytes: int = FRAME_BYTES) -> DataFrame:
    """One bundle per task below ``folder``; the materialized index of all records.

    Names hold the task attempt, and only the index of the attempt that succeeded is kept, so a lost
    or repeated attempt leaves at most an unnamed file.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        context, writer = TaskContext.get(), None
        bundle = f"{folder}/part-{context.partitionId():06d}-{context.taskAttemptId()}.warc.zst"

        def index(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
            columns = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)]
            return pa.RecordBatch.from_arrays([pa.array([bundle] * len(rows), pa.string()), *columns], ["bundle", "frame", "frame_at", "frame_size", "offset", "record_id"])

        for batch in batches:
            for page_id, url, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or BundleWriter(open_shared(bundle, "wb"), frame_bytes)
                rows = writer.add(f"urn:page:{page_id}", record(page_id, url, payload, refers_to))
                if rows:
                    yield index(rows)
        if writer:
            rows = writer.flush()
            writer.close()
            yield index(rows)

    return materialize(records.select("page_id", "url", "payload", "refers_to").mapInArrow(run, INDEX), "warc-index")


def read_frames(index: DataFrame) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of all records of the index.

    Work is dealt by frame, so a large bundle is read by many tasks. The index gives a frame's number,
    the bundle's seek table its place. The digest of a response is taken from its body, and must
    equal the one in its header.
    """
    frames = materialize(index.groupBy("bundle", "frame").agg(F.count(F.lit(1)).alias("n")), "frames")
    tasks = max(1, -(-frames.count() // FRAMES_A_TASK), index.sparkSession.sparkContext.defaultParallelism)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        zstd, held, places = zstandard.ZstdDecompressor(), None, []
        for batch in batches:
            for bundle, frame, n in zip(*(c.to_pylist() for c in batch.columns)):
                with open_shared(bundle, "rb") as file:
                    if bundle != held:
                        held, places = bundle, seek_table(file, file.seek(0, 2))
                    file.seek(places[frame][0])
                    data = zstd.decompress(file.read(places[frame][1]))
                rows, pos = [], 0
                while pos < len(data):
                    fields, body, pos = parse(data, pos)
                    digest = fields["warc-payload-digest"].removeprefix("sha1:")
                    kind = fields["warc-type"]
                    if kind == "response" and base64.b32encode(hashlib.sha1(body).digest()).decode() != digest:
                        raise ValueError(f"{bundle}: damaged record {fields['warc-record-id']}")
                    refers = fields.get("warc-refers-to")
                    rows.append((_page(fields["warc-record-id"]), fields["warc-target-uri"], int(fields["x-payload-length"]), digest, kind, _page(refers) if refers else None))
                if len(rows) != n:
                    raise ValueError(f"{bundle}: {len(rows)} records in a frame of {n}")
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64())
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names)

    spread = frames.repartition(tasks, "bundle", "frame").sortWithinPartitions("bundle", "frame")
    return spread.mapInArrow(run, "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint")


def _page(name: str) -> int:
    return int(name.strip("<>").rpartition(":")[2])


def lookup(index: DataFrame, record_id: str) -> tuple[dict[str, str], bytes]:
    """Fields and body of one record, by seeking to its frame and its offset in it."""
    row = index.where(F.col("record_id") == record_id).first()
    if row is None:
        raise KeyError(record_id)
    with open_shared(row["bundle"], "rb") as file:
        file.seek(row["frame_at"])
        data = zstandard.ZstdDecompressor().decompress(file.read(row["frame_size"]))
    return parse(data, row["offset"])[:2]


#: Base32 takes five bits at a time: two hex digits hold those of each place.
OP6_SQL = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages WHERE page_id IS NOT NULL),
d AS (SELECT page_id, payload, sha1(payload) || '0' AS h, max(page_id) OVER (PARTITION BY payload) AS newest FROM p)
SELECT page_id, octet_length(payload) AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(h, CAST(5 * i // 4 + 1 AS INTEGER), 2) AS INTEGER) >> CAST(3 - 5 * i % 4 AS INTEGER)) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN newest = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN newest <> page_id THEN newest END AS refers_to FROM d"""


def op6_warc(spark, sf_dir: str) -> DataFrame:
    """A row a page that has an id, from the archives as they were written."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    index = write_bundles(with_revisits(pages), scratch(spark, "warc"))
    return read_frames(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
