"""WARC archives as seekable Zstandard bundles, with revisit records for equal payloads.

A bundle is one file: records grouped into independent Zstandard frames, a skippable frame
that maps record identifiers to (frame, offset inside the frame, length), and a skippable
frame with the seek table, which lists the compressed and decompressed size of every frame
before it. Any Zstandard reader gets the plain WARC stream; a reader that knows the table
decompresses only the frame it needs.

Bundles are made in the tasks and written by Spark's text writer, one value per file, so they
go through Spark's commit protocol to any file system Spark can write. That writer ends each
value with a separator; the separator is set to the four bytes that must end a seek table.

Of records with equal payloads of at least ``least`` bytes, the one with the largest page id
is the response and the others are revisits that refer to it. Payload digests are compared,
not payloads. The digests of payloads that occur more than once are joined to the pages:
broadcast when a count shows that they are few, else by a shuffled join that adaptive
execution splits where one payload has a great share of the rows.

Edge cases: a null html is an empty payload; a null url has no target header; a null page id
is written without a number, refers to the response of its payload if there is one and is
never referred to; rows that repeat the largest page id are all responses; a record larger
than a frame or a bundle has one of its own; an empty table gives no bundles; other columns
are not read.
"""

from __future__ import annotations

import json
import re
import struct

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.operators.skew import broadcast_if_small
from digestloom.session import materialise, work_dir

LEAST_REVISIT_BYTES = 1000
FRAME_BYTES = 256 << 10
BUNDLE_BYTES = 16 << 20

# Fixed values of the Zstandard formats.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
_FOOTER = struct.pack("<I", SEEKABLE_MAGIC)
_ID = "urn:digestloom:page:"


def _header(fields: list[tuple[str, str]], first: str) -> bytes:
    return ("\r\n".join([first, *(f"{k}: {v}" for k, v in fields)]) + "\r\n\r\n").encode()


def _clean(url: str) -> str:
    """Header values hold no control characters; those of a url are percent-encoded."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def record(page_id, url, payload: bytes, digest: str, size: int, refers_to, date: str) -> bytes:
    """One WARC record. Revisits keep the digest and size of the payload but not the payload."""
    revisit = refers_to is not None
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(size))], "HTTP/1.1 200 OK")
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<{_ID}{'' if page_id is None else page_id}>"),
        ("WARC-Date", date),
        *([("WARC-Target-URI", _clean(url))] if url is not None else []),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(size)),
    ]
    if revisit:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{_ID}{refers_to}>"),
        ]
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    return _header(fields, "WARC/1.1") + block + b"\r\n\r\n"


def _skippable(magic: int, content: bytes) -> bytes:
    return struct.pack("<II", magic, len(content)) + content


class Bundle:
    """Collects records and gives the bytes of a bundle, without the last four of its footer."""

    def __init__(self, frame_bytes: int, level: int):
        self.packer = zstandard.ZstdCompressor(level=level)
        self.frame_bytes = frame_bytes
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.index: list[tuple[str, int, int, int]] = []
        self.open: list[bytes] = []
        self.filled = 0
        self.raw = 0

    def add(self, name: str, content: bytes) -> None:
        if self.filled and self.filled + len(content) > self.frame_bytes:
            self._close()
        self.index.append((name, len(self.frames), self.filled, len(content)))
        self.open.append(content)
        self.filled += len(content)
        self.raw += len(content)

    def _close(self) -> None:
        if self.open:
            packed = self.packer.compress(b"".join(self.open))
            self.frames.append(packed)
            self.sizes.append((len(packed), self.filled))
            self.open, self.filled = [], 0

    def finish(self) -> bytes:
        self._close()
        index = _skippable(SKIPPABLE_INDEX, self.packer.compress(json.dumps(self.index).encode()))
        entries = [*self.sizes, (len(index), 0)]
        table = b"".join(struct.pack("<II", *e) for e in entries) + struct.pack("<IB", len(entries), 0)
        seek = _skippable(SKIPPABLE_SEEK_TABLE, table + _FOOTER)
        return b"".join([*self.frames, index, seek])[: -len(_FOOTER)]


def seek_table(data: bytes) -> list[tuple[int, int, int]]:
    """Offset, compressed size and decompressed size of every frame of a bundle."""
    count, flags, magic = struct.unpack("<IBI", data[-9:])
    if magic != SEEKABLE_MAGIC or flags:
        raise ValueError("not a bundle of this kind")
    at, out = 0, []
    for i in range(count):
        packed, size = struct.unpack_from("<II", data, len(data) - 9 - 8 * (count - i))
        out.append((at, packed, size))
        at += packed
    return out


def record_index(data: bytes) -> list[list]:
    """Identifier, frame, offset inside the decompressed frame and length of every record."""
    at, size, _ = seek_table(data)[-1]
    return json.loads(zstandard.ZstdDecompressor().decompress(data[at + 8 : at + size]))


def read_record(data: bytes, entry, table=None) -> bytes:
    """One record of a bundle; only its frame is decompressed."""
    _, frame, offset, length = entry
    at, size, _ = (table or seek_table(data))[frame]
    return zstandard.ZstdDecompressor().decompress(data[at : at + size])[offset : offset + length]


def parse_record(content: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and the HTTP body of a record."""
    head, _, rest = content.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    return fields, block.partition(b"\r\n\r\n")[2]


def _bundles(frame_bytes: int, bundle_bytes: int, level: int, date: str):
    def run(batches):
        bundle = Bundle(frame_bytes, level)
        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "digest", "size", "refers_to"))):
                content = record(*row, date)
                if bundle.raw and bundle.raw + len(content) > bundle_bytes:
                    yield _one(bundle.finish())
                    bundle = Bundle(frame_bytes, level)
                bundle.add(f"{_ID}{'' if row[0] is None else row[0]}", content)
        if bundle.raw:
            yield _one(bundle.finish())

    def _one(data):
        return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["content"])

    return run


def responses(pages: DataFrame, least: int = LEAST_REVISIT_BYTES) -> DataFrame:
    """Payloads of at least ``least`` bytes that occur more than once, with their response."""
    return (
        pages.filter(F.col("size") >= least)
        .groupBy("digest", "size")
        .agg(F.max("page_id").alias("response"), F.count("*").alias("copies"))
        .filter("copies > 1 and response is not null")
        .select("digest", "size", "response")
    )


def write_archive(
    pages: DataFrame,
    folder: str,
    *,
    least: int = LEAST_REVISIT_BYTES,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write ``pages`` (``page_id, url, html``) as bundles into ``folder``."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select("page_id", F.col("url").cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    repeated = materialise(responses(rows.select("page_id", "digest", "size"), least), "payloads")
    joined = rows.join(broadcast_if_small(repeated), ["digest", "size"], "left")
    refers_to = F.when(F.col("response") != F.coalesce("page_id", F.col("response") - 1), F.col("response"))
    joined = joined.select("page_id", "url", "payload", "digest", "size", refers_to.alias("refers_to"))
    bundles = joined.mapInArrow(_bundles(frame_bytes, bundle_bytes, level, date), "content binary")
    (
        bundles.select(F.col("content").cast("string").alias("value"))
        .write.mode("errorifexists")
        .option("maxRecordsPerFile", 1)
        .option("encoding", "ISO-8859-1")
        .option("lineSep", _FOOTER.decode("latin-1"))
        .text(folder)
    )


def _entries(batches):
    import hashlib

    for batch in batches:
        for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
            data = data.as_py()
            table = seek_table(data)
            unpacker = zstandard.ZstdDecompressor()
            frames = {}
            out = []
            for name, frame, offset, length in record_index(data):
                if frame not in frames:
                    at, size, _ = table[frame]
                    frames = {frame: unpacker.decompress(data[at : at + size])}
                fields, body = parse_record(frames[frame][offset : offset + length])
                kind = fields["WARC-Type"]
                digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                size = int(fields["X-Payload-Length"])
                if kind == "response" and (hashlib.sha1(body).hexdigest(), len(body)) != (digest, size):
                    raise ValueError(f"{path}: the payload of {name} does not match its digest")
                number = fields["WARC-Record-ID"].strip("<>").removeprefix(_ID)
                other = fields.get("WARC-Refers-To", "").strip("<>").removeprefix(_ID)
                out.append((int(number) if number else None, size, digest, kind, int(other) if other else None, path, frame, offset, length))
            names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "bundle", "frame", "frame_offset", "record_bytes"]
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)


def read_archive(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the bundles: its header, and where it lies.

    Payloads of responses are decompressed and held against their digests.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(
        _entries,
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "bundle string, frame long, frame_offset long, record_bytes long",
    )


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive the pages in the shared folder and read the archive back."""
    folder = work_dir(pages.sparkSession, "warc")
    write_archive(pages, folder)
    return read_archive(pages.sparkSession, folder)
