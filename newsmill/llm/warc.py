"""WARC bundles in the seekable Zstandard format.

Records are grouped into independent Zstandard frames; a skippable frame at the end holds the seek table (compressed and
decompressed size of every frame).  The index maps a record identifier to (file, frame, offset inside the frame, length),
so one record costs one read of the footer and one frame."""

from __future__ import annotations

import hashlib
import struct
import uuid
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from newsmill.session import materialize, scratch_path

FRAME_BYTES = 1 << 20
MIN_DEDUP_BYTES = 100
# fixed values of the seekable format: magic of its skippable frame and of its footer
SKIPPABLE_MAGIC, FOOTER_MAGIC = 0x184D2A5E, 0x8F92EAB1
_FOOTER = struct.Struct("<IBI")
_ENTRY = struct.Struct("<II")
INDEX = "file string, frame long, offset long, length long, record_id string"
_INDEX_TYPES = [("file", pa.string()), ("frame", pa.int64()), ("offset", pa.int64()), ("length", pa.int64()), ("record_id", pa.string())]


class BundleWriter:
    """Write records to one bundle; holds at most a frame and a record."""

    def __init__(self, sink, frame_bytes: int = FRAME_BYTES, level: int = 3):
        self.sink, self.frame_bytes = sink, frame_bytes
        self.compressor = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.frame, self.size, self.entries = [], 0, []

    def add(self, record: bytes) -> tuple[int, int, int]:
        """(frame, offset in the decompressed frame, length) of the record."""
        if self.size and self.size + len(record) > self.frame_bytes:
            self._close_frame()
        at = (len(self.entries), self.size, len(record))
        self.frame.append(record)
        self.size += len(record)
        return at

    def _close_frame(self) -> None:
        if self.size:
            raw = self.compressor.compress(b"".join(self.frame))
            self.sink.write(raw)
            self.entries.append((len(raw), self.size))
            self.frame, self.size = [], 0

    def close(self) -> None:
        self._close_frame()
        table = b"".join(_ENTRY.pack(*e) for e in self.entries) + _FOOTER.pack(len(self.entries), 0, FOOTER_MAGIC)
        self.sink.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)


class BundleReader:
    """Read frames or single records of a bundle through a seekable file."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - _FOOTER.size)
        n, flags, magic = _FOOTER.unpack(source.read(_FOOTER.size))
        if magic != FOOTER_MAGIC:
            raise ValueError("no seek table at the end of the file")
        entry = _ENTRY.size + (4 if flags & 0x80 else 0)
        source.seek(size - _FOOTER.size - n * entry)
        raw = source.read(n * entry)
        self.frames, at = [], 0
        for i in range(n):
            packed, plain = _ENTRY.unpack_from(raw, i * entry)
            self.frames.append((at, packed, plain))
            at += packed
        self.decompressor = zstandard.ZstdDecompressor()

    def frame(self, i: int) -> bytes:
        at, packed, plain = self.frames[i]
        self.source.seek(at)
        return self.decompressor.decompress(self.source.read(packed), max_output_size=plain)

    def record(self, frame: int, offset: int, length: int) -> bytes:
        return self.frame(frame)[offset:offset + length]


def warc_record(record_id: str, uri: str, payload: bytes, payload_bytes: int, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record: a response with the payload behind an HTTP header, or a revisit that carries the payload's digest and length but not the payload."""
    kind = "response" if refers_to is None else "revisit"
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<{record_id}>"), ("WARC-Date", date),
            ("WARC-Target-URI", uri.replace("\r", "%0D").replace("\n", "%0A")), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("X-Payload-Length", str(payload_bytes))]
    if refers_to is not None:
        head += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                 ("WARC-Refers-To", f"<{refers_to}>")]
        payload = b""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\nContent-Length: {payload_bytes}\r\n\r\n".encode() + payload
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return ("WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block + b"\r\n\r\n"


def parse_records(frame: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset, headers, payload behind the HTTP header) of every record of a decompressed frame."""
    at = 0
    while at < len(frame):
        end = frame.index(b"\r\n\r\n", at)
        lines = frame[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}")
        head = dict(x.split(": ", 1) for x in lines[1:])
        size = int(head["Content-Length"])
        block = frame[end + 4:end + 4 + size]
        yield at, head, block[block.index(b"\r\n\r\n") + 4:]
        at = end + 4 + size + 4


def page_urn(page_id, place: str = "") -> str:
    """The record identifier of a page; one without an id, which nothing refers to, is named by its ``place`` in the bundles."""
    return f"urn:page:#{place}" if page_id is None else f"urn:page:{page_id}"


def urn_page(urn: str) -> int | None:
    text = urn.strip("<>").removeprefix("urn:page:")
    return None if text.startswith("#") else int(text)


def revisit_plan(pages: DataFrame, key: str = "page_id", html: str = "html", min_bytes: int = MIN_DEDUP_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that repeat a payload of at least ``min_bytes`` bytes.

    Only (page_id, digest) is shuffled; the first page per digest is a partial minimum, and digests that occur once are
    gone before the join, which splits a hot digest like any skewed partition."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    d = pages.select(F.col(key).alias("page_id"), payload.alias("p")).where(F.octet_length("p") >= min_bytes)
    d = d.select("page_id", F.unhex(F.sha2("p", 256)).alias("digest"))
    first = d.groupBy("digest").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    return (d.join(first.drop("n"), "digest").where("page_id <> refers_to OR page_id IS NULL AND refers_to IS NOT NULL")
            .select("page_id", "digest", "refers_to").distinct())


def write_bundles(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html",
                  min_bytes: int = MIN_DEDUP_BYTES, frame_bytes: int = FRAME_BYTES, date: str | None = None) -> DataFrame:
    """Write every page as a WARC record and return the index (file, frame, offset, length, record_id).

    ``path`` is a folder that all executors reach (any filesystem pyarrow knows, by its URI).  Each task writes one file
    under a name of its own attempt and names it in the index rows, which are committed by Spark: what a lost or
    repeated attempt left behind is in no index row and is never read.

    A page whose payload (html in UTF-8, null as empty) of at least ``min_bytes`` bytes equals that of a page with a
    smaller id is a revisit of the smallest such page.  Rows that share page_id and payload are all responses (or all
    revisits of the same page); a null page_id is never referred to unless all its equals are null, then all are
    responses.  Null urls are empty.  Records of pages without an id are named by their place, those of rows that share an id share a name.  ``date``
    is the WARC-Date of all records, by default the time of the call.  Other columns are ignored; an empty table writes nothing."""
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    plan = revisit_plan(pages, key, html, min_bytes).withColumnsRenamed({"page_id": "_page", "digest": "_digest"})
    rows = pages.select(F.col(key).alias("page_id"), F.coalesce(F.col(url).cast("string"), F.lit("")).alias("url"),
                        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    rows = rows.join(plan.hint("shuffle_hash"), rows.page_id.eqNullSafe(plan._page) & (rows.digest == plan._digest), "left")
    rows = rows.select("page_id", "url", F.when(F.col("_page").isNull() & F.col("_digest").isNull(), F.col("payload")).alias("payload"),
                       F.octet_length("payload").cast("long").alias("size"), F.lower(F.hex("digest")).alias("digest"),
                       "refers_to", F.col("_digest").isNotNull().alias("revisit"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, sink, name, store, root, written = None, None, None, None, None, 0
        index: list[tuple] = []

        def flush() -> pa.RecordBatch:
            columns = list(zip(*index))
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, _INDEX_TYPES)], [n for n, _ in _INDEX_TYPES])

        for b in batches:
            ids, urls, payloads, sizes, digests, refers, revisit = (b.column(i) for i in range(7))
            for i in range(b.num_rows):
                if writer is None:
                    store, root = fs.FileSystem.from_uri(path)
                    name = f"part-{uuid.uuid4().hex}.warc.zst"
                    store.create_dir(root, recursive=True)
                    sink = store.open_output_stream(f"{root}/{name}", compression=None)
                    writer = BundleWriter(sink, frame_bytes)
                urn = page_urn(ids[i].as_py(), f"{name.removesuffix('.warc.zst')}-{written}")
                written += 1
                record = warc_record(urn, urls[i].as_py(), payloads[i].as_py() or b"", sizes[i].as_py(), digests[i].as_py(),
                                     page_urn(refers[i].as_py()) if revisit[i].as_py() else None, date)
                index.append((name, *writer.add(record), urn))
            if len(index) >= 20_000:
                yield flush()
                index.clear()
        if writer is not None:
            writer.close()
            sink.close()
        if index:
            yield flush()

    # the index is committed before anybody reads it, and later reads never run the writing tasks again
    return materialize(rows.mapInArrow(write, INDEX))


RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary"


def read_bundles(spark: SparkSession, path: str, files: DataFrame, payloads: bool = False) -> DataFrame:
    """Every record of the bundles named in ``files.file``: its headers, and digest and length of the payload, computed
    anew for responses and taken from the headers for revisits, which carry none.

    A task reads one frame of one bundle at a time.  A response whose payload does not match its own digest raises."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(path)
        for b in batches:
            for name in b.column(0).to_pylist():
                info = store.get_file_info(f"{root}/{name}")
                with store.open_input_file(f"{root}/{name}") as source:
                    reader = BundleReader(source, info.size)
                    for i in range(len(reader.frames)):
                        yield _parsed(reader.frame(i), payloads)

    return files.select("file").distinct().mapInArrow(read, RECORDS)


def _parsed(frame: bytes, payloads: bool) -> pa.RecordBatch:
    rows: list[tuple] = []
    for _, head, payload in parse_records(frame):
        stated = head["WARC-Payload-Digest"].removeprefix("sha256:")
        size, digest = int(head["X-Payload-Length"]), stated
        if head["WARC-Type"] == "response":
            size, digest = len(payload), hashlib.sha256(payload).hexdigest()
            if digest != stated:
                raise ValueError(f"{head['WARC-Record-ID']}: payload does not match its digest")
        rows.append((urn_page(head["WARC-Record-ID"]), size, digest, head["WARC-Type"],
                     urn_page(head["WARC-Refers-To"]) if "WARC-Refers-To" in head else None, head["WARC-Target-URI"],
                     payload if payloads else None))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def read_record(path: str, file: str, frame: int, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its index row: the footer and one frame are read."""
    store, root = fs.FileSystem.from_uri(path)
    info = store.get_file_info(f"{root}/{file}")
    with store.open_input_file(f"{root}/{file}") as source:
        raw = BundleReader(source, info.size).record(frame, offset, length)
    _, head, payload = next(parse_records(raw))
    return head, payload


def bundle_folder(spark: SparkSession) -> str:
    """A fresh folder for bundles on the storage that all executors share, as a URI."""
    path = scratch_path(spark, "warc")
    return path if "://" in path or path.startswith("file:") else f"file://{path}"


WARC_SQL = """
WITH p AS (SELECT page_id, encode(COALESCE(html, '')) AS b FROM pages),
d AS (SELECT page_id, CAST(octet_length(b) AS BIGINT) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN MIN(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to FROM f
"""
