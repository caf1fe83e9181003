"""Operator 2: WARC records in seekable Zstandard bundles, and reading them back by record."""

from __future__ import annotations

import base64
import hashlib
import math
import struct
from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import TaskFile, open_folder
from millrace.scratch import stage, work_dir

# fixed values of the seekable Zstandard format
SKIPPABLE_MAGIC = 0x184D2A5E
SEEK_MAGIC = 0x8F92EAB1
WITH_CHECKSUMS = 0x80

#: Frames that one task reads, about.
FRAMES_PER_TASK = 16

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"

MANIFEST = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("record_id", T.StringType()),
    T.StructField("archive", T.StringType()),
    T.StructField("frame", T.IntegerType()),
    T.StructField("frame_at", T.LongType()),
    T.StructField("frame_bytes", T.LongType()),
    T.StructField("record_at", T.LongType()),
    T.StructField("record_bytes", T.LongType()),
])
RECORDS = T.StructType([
    T.StructField("page_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()),
    T.StructField("payload_digest", T.StringType()),
    T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload", T.BinaryType()),
])


def record_id(page_id: int | None, salt: str) -> str:
    """Record name that depends on the page alone (without an id: on ``salt``)."""
    name = f"page:{page_id}" if page_id is not None else f"row:{salt}"
    h = hashlib.md5(name.encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def header_text(value: str) -> str:
    """Line ends inside a header value, per cent encoded."""
    return value.replace("%", "%25").replace("\r", "%0D").replace("\n", "%0A")


def header_value(text: str) -> str:
    return text.replace("%0A", "\n").replace("%0D", "\r").replace("%25", "%")


def make_record(page_id, url, payload: bytes, digest: str, refers_to, date: str, salt: str) -> tuple[str, bytes]:
    """One response or revisit record; a revisit leaves the payload out."""
    name = record_id(page_id, salt)
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {name}", f"WARC-Date: {date}"]
    if page_id is not None:
        lines.append(f"Page-ID: {page_id}")
    if url is not None:
        lines.append(f"WARC-Target-URI: {header_text(url)}")
    lines += [f"WARC-Payload-Digest: sha1:{digest}", f"Payload-Length: {len(payload)}"]
    head = HTTP_HEAD % len(payload)
    if refers_to is None:
        block = head + payload
    else:
        block = head
        lines += [f"WARC-Refers-To: {record_id(refers_to, '')}", f"Refers-To-Page: {refers_to}", f"WARC-Profile: {PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return name, "\r\n".join(lines).encode() + block + b"\r\n\r\n"


def parse_record(data: bytes) -> dict:
    """Headers, and of a response the payload; checks lengths and the digest."""
    head, _, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.decode().split("\r\n")
    if first != "WARC/1.1":
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    digest, refers = fields["WARC-Payload-Digest"].removeprefix("sha1:"), fields.get("Refers-To-Page")
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        if len(payload) != int(fields["Payload-Length"]) or base32_sha1(payload) != digest:
            raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    page, url = fields.get("Page-ID"), fields.get("WARC-Target-URI")
    return {
        "page_id": None if page is None else int(page), "url": None if url is None else header_value(url),
        "record_type": fields["WARC-Type"], "refers_to": None if refers is None else int(refers),
        "payload_digest": digest, "payload_bytes": int(fields["Payload-Length"]), "payload": payload,
    }


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


class Bundle:
    """One archive: independent Zstandard frames of whole records, then the seek table."""

    def __init__(self, folder: str, frame_bytes: int, level: int):
        self.file, self.limit = TaskFile(folder, ".warc.zst"), frame_bytes
        self.packer = zstandard.ZstdCompressor(level=level)
        self.frames, self.records, self.plain = [], [], bytearray()
        info = b"software: millrace\r\nformat: WARC File Format 1.1\r\n"
        self.plain += b"WARC/1.1\r\nWARC-Type: warcinfo\r\nContent-Type: application/warc-fields\r\nContent-Length: %d\r\n\r\n%s\r\n\r\n" % (len(info), info)

    def add(self, page_id, name: str, record: bytes) -> list[tuple]:
        """Index rows of a frame that this record fills, else none."""
        self.records.append((page_id, name, len(self.plain), len(record)))
        self.plain += record
        return self.flush() if len(self.plain) >= self.limit else []

    def flush(self) -> list[tuple]:
        if not self.records:
            return []
        plain = bytes(self.plain)
        packed = self.packer.compress(plain)
        at = self.file.write(packed)
        self.frames.append(struct.pack("<III", len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        rows = [(p, n, self.file.name, len(self.frames) - 1, at, len(packed), r, size) for p, n, r, size in self.records]
        self.records, self.plain = [], bytearray()
        return rows

    def close(self) -> None:
        table = b"".join(self.frames) + struct.pack("<IBI", len(self.frames), WITH_CHECKSUMS, SEEK_MAGIC)
        self.file.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.file.close()


def read_seek_table(stream, size: int) -> list[tuple[int, int, int, int]]:
    """(offset, packed bytes, plain bytes, checksum) of every frame, from the archive's end."""
    stream.seek(size - 9)
    count, flags, magic = struct.unpack("<IBI", stream.read(9))
    if magic != SEEK_MAGIC or flags != WITH_CHECKSUMS:
        raise ValueError("no seek table")
    stream.seek(size - 9 - 12 * count)
    table, at, frames = stream.read(12 * count), 0, []
    for packed, plain, check in struct.iter_unpack("<III", table):
        frames.append((at, packed, plain, check))
        at += packed
    return frames


def with_originals(pages: DataFrame, page_id: Column, url: Column, payload: Column, smallest: int) -> DataFrame:
    """(page_id, url, payload, refers_to): payloads that others share, joined to their smallest page id.

    Only digests that occur more than once are joined, so the join moves few rows
    or is broadcast by its measured size; a hot digest can be split.
    """
    body = F.coalesce(payload, F.lit("")).cast("binary")
    rows = pages.select(page_id.cast("bigint").alias("page_id"), url.alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("length", F.octet_length("payload"))
    shared = (
        rows.where(F.col("length") >= smallest).groupBy("digest")
        .agg(F.min("page_id").alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    )
    refers = F.when(F.col("original").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("original")), F.col("original"))
    joined = rows.join(shared, "digest", "left")
    return joined.select("page_id", "url", "payload", refers.alias("refers_to"))


def write_archives(
    pages: DataFrame, folder: str, *, page_id: Column, url: Column, payload: Column, smallest_revisit: int = 0,
    frame_bytes: int = 1 << 20, archive_bytes: int = 1 << 30, level: int = 3, date: str = "2024-01-01T00:00:00Z",
) -> DataFrame:
    """Write one record per row into archives below ``folder``; returns the stored index.

    Records whose payloads of ``smallest_revisit`` bytes or more are equal: the
    rows with the smallest page id are responses, the others revisit it.  Rows
    without a page id cannot be referred to; if a whole group has none, all are
    responses.  A null payload is empty, a null url is left out.  A frame holds
    whole records up to about ``frame_bytes``; a longer record has its own.  The
    index maps every record to archive, frame and offset inside the frame; an
    archive that it doesn't name belongs to a lost attempt and is never read.
    """
    rows = with_originals(pages, page_id, url, payload, smallest_revisit)
    schema = pa.schema([
        ("page_id", pa.int64()), ("record_id", pa.string()), ("archive", pa.string()), ("frame", pa.int32()),
        ("frame_at", pa.int64()), ("frame_bytes", pa.int64()), ("record_at", pa.int64()), ("record_bytes", pa.int64()),
    ])

    def index(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bundle = None
        for batch in batches:
            for page, address, body, refers in zip(*(batch.column(i) for i in range(4))):
                bundle = bundle or Bundle(folder, frame_bytes, level)
                page, address, body, refers = page.as_py(), address.as_py(), body.as_py(), refers.as_py()
                name, record = make_record(page, address, body, base32_sha1(body), refers, date, f"{bundle.file.name}{bundle.file.size}:{len(bundle.plain)}")
                if done := bundle.add(page, name, record):
                    yield index(done)
                if bundle.file.size >= archive_bytes:
                    if done := bundle.flush():
                        yield index(done)
                    bundle.close()
                    bundle = None
        if bundle:
            if done := bundle.flush():
                yield index(done)
            bundle.close()

    return stage(rows.mapInArrow(write, MANIFEST), "warc-index")


def read_archives(index: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records that ``index`` names, read by frame ranges; frames and payloads are checked."""
    schema = T.StructType([f for f in RECORDS if with_payload or f.name != "payload"])
    names = schema.names

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        unpacker, current, plain, checks, stream = zstandard.ZstdDecompressor(), None, b"", {}, None
        for batch in batches:
            found, held = [], 0
            for row in batch.to_pylist():
                if stream is None or row["archive"] != current[0]:
                    if stream is not None:
                        stream.close()
                    stream = files.open_input_file(f"{root}/{row['archive']}")
                    checks, current = {f[0]: f for f in read_seek_table(stream, stream.size())}, (row["archive"], None)
                if row["frame_at"] != current[1]:
                    at, packed, size, check = checks[row["frame_at"]]
                    plain = unpacker.decompress(stream.read_at(packed, at), max_output_size=size)
                    if xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != check:
                        raise ValueError(f"frame {row['frame']} of {row['archive']} is damaged")
                    current = (row["archive"], row["frame_at"])
                found.append(parse_record(plain[row["record_at"]: row["record_at"] + row["record_bytes"]]))
                held += row["record_bytes"]
                if held >= 16 << 20:
                    yield out(found)
                    found, held = [], 0
            if found:
                yield out(found)

    def out(found: list[dict]) -> pa.RecordBatch:
        kinds = {"page_id": pa.int64(), "refers_to": pa.int64(), "payload_bytes": pa.int64(), "payload": pa.binary()}
        return pa.RecordBatch.from_arrays([pa.array([r[n] for r in found], kinds.get(n, pa.string())) for n in names], names=names)

    # the index is small and the frames are large: a number, so that tasks aren't put together by its size
    tasks = max(1, math.ceil(index.select("archive", "frame").distinct().count() / FRAMES_PER_TASK))
    spread = index.repartition(tasks, "archive", "frame").sortWithinPartitions("archive", "frame_at", "record_at")
    return spread.mapInArrow(read, schema)


def archive_folder(pages: DataFrame) -> str:
    return work_dir(pages.sparkSession, "warc")
