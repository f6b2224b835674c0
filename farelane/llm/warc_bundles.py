"""WARC records in seekable Zstandard bundles.

Records are grouped into independent Zstandard frames of about FRAME_BYTES;
a bundle is a file of such frames behind a ``warcinfo`` frame, ended by the
seek table of the public seekable format (a skippable frame with every
frame's compressed and decompressed size).  Any Zstandard decoder reads a
bundle as one stream of WARC records.  An index table maps each record to
bundle, frame and the place inside the frame, so a record is read by
decompressing its frame alone.

Records with equal payloads (SHA-256 and so byte for byte) of at least
``least_bytes`` are written once: the smallest id's as ``response``, the
others as ``revisit`` records, which hold the headers and refer to it.

Bundles are written and read by the tasks through ``pyarrow.fs``, so the
folder must be one that executors and driver share (file, s3, gs or hdfs).  A
task that runs again writes bundles with new names; only those of the task
that ended are in the index, so lost executors leave nothing but unused files.

Defined results: NULL payloads count as empty, NULL urls as none.  Every row
gives a record, repeated rows too; rows that repeat the smallest id of equal
payloads are all responses, with one record id.  A NULL id is never referred
to; if equal payloads have no other, each is a response.  Other columns are
ignored, whatever their names.  An empty table gives no bundle, and reading
it back gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

FRAME_BYTES, BUNDLE_BYTES = 1 << 20, 128 << 20
#: Frames that one task reads back.
TASK_FRAMES = 32
LEVEL = 3
#: Equal payloads that are more than one in so many rows are heavy; there are no more groups than that.
HEAVY_SHARE = 1000
#: Fixed values of the public seekable format and of the WARC standard.
SKIPPABLE_MAGIC, SEEK_TABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


def file_system(folder: str):
    """File system and path of a folder given by URI or absolute path."""
    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "/", folder))


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_name(key, digest: str) -> str:
    """A record id, from the row's id and its payload's digest."""
    return f"urn:x-page:{'-' if key is None else quote(str(key), safe='').replace('-', '%2D')}:{digest}"


def key_of(name: str) -> str | None:
    """The row's id, as text, that a record id holds."""
    text = name.split(":")[2]
    return None if text == "-" else unquote(text)


def _headers(fields: list[tuple[str, str]], block: bytes) -> bytes:
    lines = ["WARC/1.1", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8") + block + b"\r\n\r\n"


def record(key, url: str | None, payload: bytes, refers_to, date: str = DATE) -> tuple[str, bytes]:
    """Id and bytes of a row's record; a revisit if it refers to another id."""
    digest = payload_digest(payload)
    name = record_name(key, digest)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m.group()), url or "") or name
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{name}>"), ("WARC-Date", date),
              ("WARC-Target-URI", target), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{record_name(refers_to, digest)}>"), ("WARC-Profile", REVISIT_PROFILE)]
        return name, _headers(fields, head)
    return name, _headers(fields, head + payload)


def parse(frame: bytes, at: int = 0) -> tuple[dict[str, str], bytes, int]:
    """Headers and block of the record at a place of a frame, and the next
    record's place."""
    end = frame.index(b"\r\n\r\n", at)
    first, *lines = frame[at:end].decode("utf-8").split("\r\n")
    if not first.startswith("WARC/"):
        raise ValueError(f"no WARC record at {at}: {first[:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines)
    stop = end + 4 + int(headers["Content-Length"])
    return headers, frame[end + 4:stop], stop + 4


class BundleWriter:
    """Writes one bundle: frames of whole records, then the seek table."""

    def __init__(self, stream, level: int = LEVEL):
        import zstandard
        self.stream, self.sizes, self.written = stream, [], 0
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.compressor = zstandard.ZstdCompressor(level=level, write_content_size=True, write_checksum=True)

    def add(self, data: bytes) -> tuple[int, int]:
        """Frame number and frame-relative place of a record put at the end."""
        place = len(self.sizes), self.held_bytes
        self.held.append(data)
        self.held_bytes += len(data)
        return place

    def end_frame(self) -> None:
        if self.held:
            packed = self.compressor.compress(b"".join(self.held))
            self.stream.write(packed)
            self.sizes.append((len(packed), self.held_bytes))
            self.written += len(packed)
            self.held, self.held_bytes = [], 0

    def close(self) -> None:
        self.end_frame()
        entries = b"".join(struct.pack("<II", *s) for s in self.sizes)
        body = entries + struct.pack("<IBI", len(self.sizes), 0, SEEK_TABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(body)) + body)
        self.stream.close()


class BundleReader:
    """Random access to the frames of one bundle by its seek table."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, flags, magic = struct.unpack("<IBI", source.read_at(9, size - 9))
        if magic != SEEK_TABLE_MAGIC:
            raise ValueError("no seek table at the end of the bundle")
        width = 12 if flags & 128 else 8
        table = source.read_at(frames * width, size - 9 - frames * width)
        self.frames, at = [], 0  # place, compressed and decompressed size
        for k in range(frames):
            packed, plain = struct.unpack_from("<II", table, k * width)
            self.frames.append((at, packed, plain))
            at += packed

    def frame(self, k: int) -> bytes:
        import zstandard
        at, packed, plain = self.frames[k]
        return zstandard.ZstdDecompressor().decompress(self.source.read_at(packed, at), max_output_size=plain)


def classify(pages: DataFrame, id_col: str = "page_id", payload_col: str = "html", url_col: str = "url", least_bytes: int = 0) -> DataFrame:
    """``key, url, payload, refers_to`` of every row: the smallest id with an
    equal payload of at least ``least_bytes``, NULL for a response.

    Heavy groups of equal payloads are at most HEAVY_SHARE and are broadcast;
    their rows are dealt by id in the join of the others, so no payload's rows
    meet in one task."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("key"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("sha", F.when(F.octet_length("payload") >= least_bytes, F.sha2("payload", 256)))
    groups = saved(rows.where("sha IS NOT NULL").groupBy("sha").agg(F.min("key").alias("first"), F.count("*").alias("n"))
                   .where("n > 1"), "equal-payloads")
    total = pages.count()
    heavy = groups.where(F.col("n") * HEAVY_SHARE >= total).select("sha", F.col("first").alias("heavy_first"))
    light = groups.where(F.col("n") * HEAVY_SHARE < total).select(F.col("sha").alias("dealt"), F.col("first").alias("light_first"))
    rows = rows.join(F.broadcast(heavy), "sha", "left")  # at most HEAVY_SHARE rows
    rows = rows.withColumn("dealt", F.when(F.col("heavy_first").isNull(), F.coalesce("sha", F.xxhash64("key").cast("string")))
                           .otherwise(F.xxhash64("key").cast("string")))
    first = F.coalesce("heavy_first", "light_first")
    return rows.join(light, "dealt", "left").select(
        "key", "url", "payload", F.when(~F.col("key").eqNullSafe(first), first).alias("refers_to"))


def _write(folder: str, date: str, frame_bytes: int, bundle_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        writer, name = None, ""
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("record_id", "bundle", "frame", "offset", "length")}
            columns = [batch.column(c) for c in ("key", "url", "payload", "refers_to")]
            for row in zip(*columns):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    fs.create_dir(root, recursive=True)
                    writer = BundleWriter(fs.open_output_stream(f"{root}/{name}", compression=None))
                    writer.add(_headers([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-bundle:{name}>"), ("WARC-Date", date),
                                         ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
                    writer.end_frame()
                key, url, payload, refers_to = (v.as_py() for v in row)
                record_id, data = record(key, url, payload, refers_to, date)
                frame, offset = writer.add(data)
                for column, value in zip(out.values(), (record_id, name, frame, offset, len(data))):
                    column.append(value)
                if writer.held_bytes >= frame_bytes:
                    writer.end_frame()
                    if writer.written >= bundle_bytes:
                        writer.close()
                        writer = None
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(out["record_id"], pa.string()), pa.array(out["bundle"], pa.string()),
                 *(pa.array(out[c], pa.int64()) for c in ("frame", "offset", "length"))], names=["key", *out])
        if writer:
            writer.close()
    return run


def write_bundles(records: DataFrame, folder: str, date: str = DATE, frame_bytes: int = FRAME_BYTES, bundle_bytes: int = BUNDLE_BYTES) -> DataFrame:
    """Writes ``records`` (key, url, payload, refers_to) as bundles below
    ``folder`` and returns the index: key, record_id, bundle, frame, offset
    inside the decompressed frame, length."""
    kind = records.schema["key"].dataType.simpleString()
    return saved(records.select("key", "url", "payload", "refers_to").mapInArrow(
        _write(f"{folder}/bundles", date, frame_bytes, bundle_bytes),
        f"key {kind}, record_id string, bundle string, frame long, offset long, length long"), "warc-index")


def _read(folder: str, with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(folder)
        opened: dict[str, BundleReader] = {}
        for batch in batches:
            for bundle, frame, offsets in zip(*(batch.column(c).to_pylist() for c in ("bundle", "frame", "offsets"))):
                if bundle not in opened:
                    while len(opened) >= 64:
                        opened.pop(next(iter(opened))).source.close()
                    opened[bundle] = BundleReader(fs.open_input_file(f"{root}/{bundle}"))
                data = opened[bundle].frame(frame)
                out: dict[str, list] = {k: [] for k in ("record_id", "url", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload")}
                for at in offsets:
                    headers, block, _ = parse(data, at)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    end = block.index(b"\r\n\r\n") + 4
                    payload = block[end:]
                    size = int(re.search(rb"\r\nContent-Length: (\d+)", block[:end]).group(1))
                    if headers["WARC-Type"] == "response" and (len(payload) != size or payload_digest(payload) != digest):
                        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")
                    refers = headers.get("WARC-Refers-To")
                    row = (headers["WARC-Record-ID"][1:-1], headers["WARC-Target-URI"], headers["WARC-Type"], refers and refers[1:-1], digest, size,
                           payload if with_payload and headers["WARC-Type"] == "response" else None)
                    for column, value in zip(out.values(), row):
                        column.append(value)
                kinds = {"payload_bytes": pa.int64(), "payload": pa.binary()}
                yield pa.RecordBatch.from_pydict({k: pa.array(v, kinds.get(k, pa.string())) for k, v in out.items()})
    return run


def read_bundles(index: DataFrame, folder: str, with_payload: bool = False) -> DataFrame:
    """The records that ``index`` (all of it, or the rows wanted) names, read
    from their frames: record_id, url, record_type, refers_to (a record id),
    payload_digest, payload_bytes and, if asked, the payload of responses.
    Payloads are held against their digests."""
    tasks = -(-index.select("bundle", "frame").distinct().count() // TASK_FRAMES) or 1
    frames = index.repartition(tasks, "bundle", "frame").groupBy("bundle", "frame").agg(F.array_sort(F.collect_list("offset")).alias("offsets"))
    return frames.mapInArrow(_read(f"{folder}/bundles", with_payload), "record_id string, url string, record_type string, refers_to string, "
                             "payload_digest string, payload_bytes long, payload binary")


def broken_revisits(records: DataFrame) -> DataFrame:
    """Revisits (refers_to, digest, size) whose response is missing or differs.
    Revisits are aggregated first, so a hot response meets few rows."""
    asked = records.where("record_type = 'revisit'").select("refers_to", "payload_digest", "payload_bytes").distinct()
    held = records.where("record_type = 'response'").select(F.col("record_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    return asked.join(held, ["refers_to", "payload_digest", "payload_bytes"], "left_anti")


def row_key(name: str, kind: str):
    """Column: the row's id, of type ``kind``, that a record id column holds."""
    text = F.split(F.col(name), ":")[2]
    return F.when(text != "-", F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))).cast(kind)
