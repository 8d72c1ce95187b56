"""WARC archives with Zstandard: written and read back by Spark.

An archive is a sequence of frames.  The first is a skippable frame that holds the
dictionary; then comes one compressed frame per record.  Spark's text writer puts the
frames of a task one after the other and commits the files, to any file system that
Spark knows; what it writes between two rows is chosen to be an empty skippable frame,
which every reader passes over.  The reader takes whole files (`binaryFile`), loads the
dictionary, walks from frame to frame by their block headers, and checks each record.

An archive holds at most `ARCHIVE_RECORDS` records, so that it fits a row of `binaryFile`.
Its dictionary is trained on its first `DICTIONARY_RECORDS` records.

Of records with equal payloads that with the largest page_id is a response and the
others are revisits without a payload.  Equal payloads are found by digest: one small
row per page is aggregated, and only pages in groups of two or more are joined, so a
payload that a third of all pages share moves as digests, never as text.

Defined results: a null text is an empty payload.  A null page_id is kept as null; it is
a response only where its group has no other id.  Rows that repeat the largest page_id
are responses all.  An empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARCHIVE_RECORDS = 8192
DICTIONARY_RECORDS, DICTIONARY_BYTES = 256, 32 << 10
LEVEL = 3
#: Fixed values of the format: the first bytes of a dictionary, of an empty skippable
#: frame and of a compressed frame.
DICTIONARY_MAGIC = b"\x5d\x2a\x4d\x18"
EMPTY_FRAME = b"\x50\x2a\x4d\x18\x00\x00\x00\x00"
FRAME_MAGIC = b"\x28\xb5\x2f\xfd"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"


def with_references(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """(page_id, url, payload, refers_to); refers_to is null for responses.

    Payloads of fewer than `least_bytes` bytes are responses all.
    """
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    given = pages.select("page_id", "url", payload.alias("payload"))
    given = given.withColumn("digest", F.sha1("payload"))
    narrow = given.filter(F.octet_length("payload") >= least_bytes).select("page_id", "digest")
    groups = narrow.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n"))
    shared = groups.filter("n > 1 AND refers_to IS NOT NULL").drop("n")
    again = F.col("page_id").isNull() | (F.col("page_id") != F.col("refers_to"))
    visits = narrow.join(shared, "digest").filter(again).distinct()
    visits = visits.withColumnsRenamed({"page_id": "visit", "digest": "visit_digest"})
    same = F.col("page_id").eqNullSafe(F.col("visit")) & (F.col("digest") == F.col("visit_digest"))
    return given.join(visits, same, "left").select("page_id", "url", "payload", "refers_to")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url, payload: bytes, refers_to, nth: int, date: str) -> bytes:
    """One record: headers, block, and the empty lines behind it."""
    again = refers_to is not None
    block = HTTP_HEAD % len(payload) + (b"" if again else payload)
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if again else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}:{nth}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Payload-Length: {len(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if page_id is not None:
        head.append(f"WARC-Page-ID: {page_id}")
    if url is not None:
        # A line break in an address would end the header early.
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if again:
        head += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
        head.append(f"WARC-Refers-To-Page-ID: {refers_to}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary, or where there is too little to train on, plain content."""
    try:
        trained = zstandard.train_dictionary(DICTIONARY_BYTES, samples, k=1024, d=8)
        return trained.as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _frames(date: str):
    def frames(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of an archive's file: its dictionary, then its records."""
        waiting: list[bytes] = []
        packer, held, nth = None, 0, 0

        def out(rows: list[bytes]) -> pa.RecordBatch:
            return pa.record_batch({"frame": pa.array(rows, pa.binary())})

        def opened():
            nonlocal packer
            content = dictionary(waiting)
            data = zstandard.ZstdCompressionDict(content)
            packer = zstandard.ZstdCompressor(LEVEL, dict_data=data, write_checksum=True)
            first = DICTIONARY_MAGIC + struct.pack("<I", len(content)) + content
            rows = [first, *map(packer.compress, waiting)]
            waiting.clear()
            return out(rows)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows: list[bytes] = []
                for row in batch.slice(at, 256).to_pylist():
                    if held == ARCHIVE_RECORDS:  # the writer begins a new file here
                        if waiting:
                            yield opened()
                        elif rows:
                            yield out(rows)
                            rows = []
                        packer, held = None, 0
                    made = record(row["page_id"], row["url"], row["payload"], row["refers_to"], nth, date)
                    held, nth = held + 1, nth + 1
                    if packer is None:
                        waiting.append(made)
                        if len(waiting) == DICTIONARY_RECORDS:
                            yield opened()
                    else:
                        rows.append(packer.compress(made))
                if rows:
                    yield out(rows)
        if waiting:
            yield opened()

    return frames


def write(pages: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z") -> None:
    """Archives of `pages` (page_id, url, html) below `path`."""
    frames = with_references(pages).mapInArrow(_frames(date), "frame binary")
    (
        frames.select(F.col("frame").cast("string"))
        .write.option("lineSep", EMPTY_FRAME.decode())
        .option("maxRecordsPerFile", ARCHIVE_RECORDS + 1)
        .text(path)
    )


def frame_end(data: memoryview, at: int) -> int:
    """End of the compressed frame at `at`, by its header and those of its blocks."""
    flags = data[at + 4]
    single = flags >> 5 & 1
    sizes = (single, 2, 4, 8)
    pos = at + 5 + (not single) + (0, 1, 2, 4)[flags & 3] + sizes[flags >> 6]
    while True:
        if pos + 3 > len(data):
            raise ValueError(f"frame at {at} is cut off")
        head = int.from_bytes(data[pos : pos + 3], "little")
        pos += 3 + (1 if head >> 1 & 3 == 1 else head >> 3)
        if head & 1:
            break
    pos += 4 * (flags >> 2 & 1)
    if pos > len(data):
        raise ValueError(f"frame at {at} is cut off")
    return pos


def records(content: bytes) -> Iterator[bytes]:
    """The records of an archive."""
    data, at, unpacker = memoryview(content), 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = bytes(data[at : at + 4])
        if magic == FRAME_MAGIC:
            end = frame_end(data, at)
            yield unpacker.decompress(data[at:end])
        elif len(magic) == 4 and magic[1:] == DICTIONARY_MAGIC[1:] and magic[0] & 0xF0 == 0x50:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if end > len(data) or at + 8 > len(data):
                raise ValueError(f"skippable frame at {at} is cut off")
            if at == 0 and magic == DICTIONARY_MAGIC:
                loaded = zstandard.ZstdCompressionDict(bytes(data[8:end]))
                unpacker = zstandard.ZstdDecompressor(dict_data=loaded)
        else:
            raise ValueError(f"no frame begins at {at}")
        at = end


def parse(made: bytes) -> dict:
    """A record's fields, its headers and lengths checked."""
    head, found, rest = made.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not found or lines[0] != "WARC/1.1":
        raise ValueError("record without a WARC/1.1 header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"header line {line!r}")
        if name.lower() in fields:
            raise ValueError(f"header {name} comes twice")
        fields[name.lower()] = value.strip()
    if missing := [name for name in REQUIRED if name not in fields]:
        raise ValueError(f"record without {missing}")
    length = int(fields["content-length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise ValueError(f"block of {len(rest) - 4} bytes, Content-Length {length}")
    block = rest[:length]
    if fields.get("warc-block-digest") not in (None, f"sha1:{digest(block)}"):
        raise ValueError("block differs from its digest")
    http, found, payload = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("block without an HTTP header")
    kind, said = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    size = int(fields["warc-payload-length"])
    if kind == "response" and (len(payload), digest(payload)) != (size, said):
        raise ValueError("payload differs from its length or digest")
    if kind == "revisit" and (payload or "warc-refers-to" not in fields):
        raise ValueError("revisit with a payload, or without a reference")
    number = {k: int(fields[k]) if k in fields else None for k in ("warc-page-id", "warc-refers-to-page-id")}
    return {
        "page_id": number["warc-page-id"],
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": said,
        "record_type": kind,
        "refers_to": number["warc-refers-to-page-id"],
        "payload": payload if kind == "response" else None,
    }


SCHEMA = pa.schema(
    {
        "page_id": pa.int64(),
        "url": pa.string(),
        "payload_bytes": pa.int64(),
        "payload_digest": pa.string(),
        "record_type": pa.string(),
        "refers_to": pa.int64(),
        "payload": pa.binary(),
    }
)


def _parsed(payloads: bool):
    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                rows, size = [], 0
                for made in records(content.as_py()):
                    row = parse(made)
                    if not payloads:
                        row["payload"] = None
                    rows.append(row)
                    size += len(made)
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, SCHEMA)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, SCHEMA)

    return parsed


def read(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records of the archives below `path`; a revisit's payload is null."""
    files = spark.read.format("binaryFile").load(path).select("content")
    columns = (
        "page_id bigint, url string, payload_bytes bigint, payload_digest string, "
        "record_type string, refers_to bigint, payload binary"
    )
    return files.mapInArrow(_parsed(payloads), columns)
