"""WARC archives in seekable Zstandard bundles.

A bundle is a file of independent Zstandard frames, each of some records. Two skippable frames end it: a map of its record
ids to frames and places in them, and a seek table, as the public seekable format has it. Any reader of Zstandard reads the
whole file; with the map, or the index of all bundles (record -> bundle, frame, place in the frame), one record costs one frame.

Tasks write bundles under names of their own and return the index rows. Only index rows that Spark
commits belong to the archive, so a task that is lost or run twice leaves at most a file that nobody
reads. Responses are written first, so that a revisit can name the record that it refers to. The index is kept beside the
bundles.
"""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field
from datetime import datetime, timezone

import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import steps_dir
from .common import batch_limits, batches, step

# fixed values of the seekable format
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
# another skippable frame, for the map of records
MAPPED = 0x184D2A50
END = b"\r\n"
HTTP = "application/http; msgtype=response"


@dataclass(frozen=True)
class Layout:
    """Bytes of records a frame gathers before it is closed, compressed bytes of a bundle, and level."""

    frame: int = 1 << 18
    bundle: int = 64 << 20
    level: int = 3


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)


@dataclass
class BundleWriter:
    """Writes records to a bundle; `place` is where the next one goes: the frame's number and the place in it."""

    out: pa.NativeFile
    layout: Layout
    frames: list[tuple[int, int]] = field(default_factory=list)
    held: bytearray = field(default_factory=bytearray)
    records: list[str] = field(default_factory=list)
    size: int = 0

    def place(self) -> tuple[int, int]:
        return len(self.frames), len(self.held)

    def add(self, name: str, record: bytes) -> None:
        frame, place = self.place()
        self.records.append(f"{frame} {place} {name}")
        self.held += record
        if len(self.held) >= self.layout.frame:
            self.close_frame()

    def close_frame(self) -> None:
        if self.held:
            packed = zstandard.ZstdCompressor(self.layout.level).compress(bytes(self.held))
            self.out.write(packed)
            self.frames.append((len(packed), len(self.held)))
            self.size += len(packed)
            self.held = bytearray()

    def close(self) -> list[int]:
        """Write the map of records and the seek table; gives each frame's offset."""
        self.close_frame()
        known = zstandard.ZstdCompressor(self.layout.level).compress("\n".join(self.records).encode())
        self.out.write(struct.pack("<II", MAPPED, len(known)) + known)
        entries = b"".join(struct.pack("<II", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self.out.write(struct.pack("<II", SKIPPABLE, len(entries) + len(foot)) + entries + foot)
        self.out.close()
        offsets = [0]
        for packed, _ in self.frames:
            offsets.append(offsets[-1] + packed)
        return offsets[:-1]


def read_seek_table(file: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Offset, compressed and full size of each frame, from the end of a bundle."""
    size = file.size()
    file.seek(size - 9)
    count, _, magic = struct.unpack("<IBI", file.read(9))
    if magic != SEEKABLE:
        raise ValueError("the bundle has no seek table")
    file.seek(size - 9 - 8 * count)
    table, at = [], 0
    for packed, full in struct.iter_unpack("<II", file.read(8 * count)):
        table.append((at, packed, full))
        at += packed
    return table


def read_frame(file: pa.NativeFile, offset: int, packed: int, full: int) -> bytes:
    file.seek(offset)
    return zstandard.ZstdDecompressor().decompress(file.read(packed), max_output_size=full)


def read_record_map(file: pa.NativeFile) -> dict[str, tuple[int, int]]:
    """Frame and place of each record of a bundle, by its id."""
    at = sum(packed for _, packed, _ in read_seek_table(file))
    file.seek(at)
    magic, size = struct.unpack("<II", file.read(8))
    if magic != MAPPED:
        raise ValueError("the bundle has no map of its records")
    lines = zstandard.ZstdDecompressor().decompress(file.read(size)).decode().splitlines()
    rows = (line.split(" ", 2) for line in lines)
    return {name: (int(frame), int(place)) for frame, place, name in rows}


def record_uri(page_id: int | None, bundle: str, frame: int, place: int) -> str:
    """Unique, however often a page repeats: the page, its bundle and the place there."""
    return f"urn:x-page:{'' if page_id is None else page_id}:{bundle}:{frame}:{place}"


def _header_value(text: str) -> str:
    """A value without line ends and other controls, which are percent-coded."""
    return "".join(f"%{ord(c):02X}" if ord(c) < 32 or ord(c) == 127 else c for c in text)


def warc_record(
    name: str, url: str | None, payload: bytes, size: int, sha1: bytes, refers_to: str | None, date: str
) -> bytes:
    """One record: an HTTP response with the payload, or a revisit, which has no block but names the record that has.

    A page without an address has its own name as target.
    """
    fields = [
        ("WARC-Type", "response" if refers_to is None else "revisit"),
        ("WARC-Record-ID", f"<{name}>"),
        ("WARC-Date", date),
        ("WARC-Target-URI", name if url is None else _header_value(url)),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(sha1).decode()),
        ("X-Payload-Length", str(size)),
    ]
    if refers_to is None:
        fields.append(("Content-Type", HTTP))
        http = ["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", f"Content-Length: {size}"]
        block = END.join(x.encode() for x in http) + END + END + payload
    else:
        fields += [
            ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
            ("WARC-Refers-To", f"<{refers_to}>"),
        ]
        block = b""
    fields.append(("Content-Length", str(len(block))))
    head = b"WARC/1.1" + END + b"".join(f"{k}: {v}".encode() + END for k, v in fields)
    return head + END + block + END + END


def payload_of(block: bytes) -> bytes:
    """What follows the header of an HTTP message."""
    return block[block.index(END + END) + 4 :] if block else b""


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """Place, header fields and block of each record of a frame."""
    at = 0
    while at < len(data):
        stop = data.index(END + END, at)
        lines = data[at:stop].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin = stop + 4
        size = int(fields["Content-Length"])
        yield at, fields, data[begin : begin + size]
        at = begin + size + 4


def with_revisits(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages with payload size, digest, and `refers_to`: of equal payloads of at least `least` bytes
    the page with the largest id keeps the payload and the others refer to it."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        "url",
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload).alias("digest"),
    )
    # only digests that two pages share
    shared = (
        rows.filter((F.col("payload_bytes") >= least) & F.col("page_id").isNotNull())
        .groupBy("digest")
        .agg(F.max("page_id").alias("holder"), F.min("page_id").alias("other"))
        .filter("other < holder")
        .select("digest", "holder")
    )
    return rows.join(shared, "digest", "left").withColumn(
        "refers_to", F.when(F.col("page_id") < F.col("holder"), F.col("holder"))
    )


INDEX = (
    "record string, page_id bigint, bundle string, frame int, frame_offset bigint, frame_bytes int, "
    "frame_full int, place int"
)


def write_archive(
    pages: DataFrame, folder: str, layout: Layout = Layout(), least: int = 1000, written_at: datetime | None = None
) -> DataFrame:
    """Write a record per row of `pages` to bundles in `folder`, and the index beside them; gives the index.

    Index columns: record (its id), page_id, bundle (path), frame (number), frame_offset, frame_bytes
    (compressed), frame_full, place (of the record in the frame).

    Columns page_id, url, html; others are ignored, whatever their names. A NULL html is an empty
    payload, a NULL url leaves the record's own id as target. A row without page_id is a response of its own. Rows that
    repeat a page_id each get a record. An empty table writes an empty index. Records are dated `written_at` (now).
    """
    spark = pages.sparkSession
    batch_limits(spark)
    date = (written_at or datetime.now(timezone.utc)).astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")

    def write(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["record", "page_id", "bundle", "frame", "frame_offset", "frame_bytes", "frame_full", "place"]
        types = [pa.string(), pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        filesystem, root = _open(folder)
        writer, bundle, records = None, "", []

        def finish() -> pa.RecordBatch:
            offsets = writer.close()
            path = f"{folder}/{bundle}.warc.zst"
            rows = [
                (name, page, path, frame, offsets[frame], *writer.frames[frame], place)
                for name, page, frame, place in records
            ]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        columns = ["page_id", "url", "payload", "payload_bytes", "digest", "record"]
        for batch in batches(frames, columns):
            for page, url, payload, size, digest, refers_to in zip(*(c.to_pylist() for c in batch)):
                if writer is None:
                    bundle, records = uuid.uuid4().hex, []
                    filesystem.create_dir(root, recursive=True)
                    writer = BundleWriter(
                        filesystem.open_output_stream(f"{root}/{bundle}.warc.zst", compression=None), layout
                    )
                place = writer.place()
                name = record_uri(page, bundle, *place)
                writer.add(name, warc_record(name, url, payload, size, bytes.fromhex(digest), refers_to, date))
                records.append((name, page, *place))
                if writer.size >= layout.bundle:
                    yield finish()
                    writer = None
        if writer is not None:
            yield finish()

    marked = with_revisits(pages, least)
    own = marked.filter("refers_to IS NULL").select(
        "page_id", "url", "payload", "payload_bytes", "digest", F.lit(None).cast("string").alias("record")
    )
    responses = step(own.mapInArrow(write, INDEX), "warc-responses")
    # of a page that repeats any record will do
    named = responses.groupBy(F.col("page_id").alias("refers_to")).agg(F.min("record").alias("record"))
    again = (
        marked.filter("refers_to IS NOT NULL")
        .select("page_id", "url", "payload_bytes", "digest", "refers_to")
        .join(named, "refers_to")
        .select("page_id", "url", F.lit(None).cast("binary").alias("payload"), "payload_bytes", "digest", "record")
    )
    revisits = step(again.mapInArrow(write, INDEX), "warc-revisits")
    responses.unionByName(revisits).write.mode("overwrite").parquet(f"{folder}/index")
    return open_archive(spark, folder)


def open_archive(spark: SparkSession, folder: str) -> DataFrame:
    """The index of an archive that has been written."""
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


RECORDS = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"


def _page_of(uri: str | None) -> int | None:
    number = (uri or "").strip("<>").removeprefix("urn:x-page:").split(":")[0]
    return int(number) if number else None


def read_archive(index: DataFrame) -> DataFrame:
    """All records of an archive, frame by frame: page_id, payload_bytes, payload_digest (SHA-1 in
    hex), record_type, refers_to. Payloads are checked against their digests."""
    frames_of = index.select("bundle", "frame_offset", "frame_bytes", "frame_full").distinct()

    def read(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
        types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
        for batch in batches(frames, ["bundle", "frame_offset", "frame_bytes", "frame_full"]):
            last, file = None, None
            for bundle, offset, packed, full in sorted(zip(*(c.to_pylist() for c in batch))):
                if bundle != last:
                    if file:
                        file.close()
                    filesystem, path = _open(bundle)
                    last, file = bundle, filesystem.open_input_file(path)
                rows = []
                for _, fields, block in parse_records(read_frame(file, offset, packed, full)):
                    sha1 = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:"))
                    kind = fields["WARC-Type"]
                    payload = payload_of(block)
                    if kind == "response" and hashlib.sha1(payload).digest() != sha1:
                        raise ValueError(f"{fields['WARC-Record-ID']}: payload does not match its digest")
                    rows.append(
                        (
                            _page_of(fields["WARC-Record-ID"]),
                            len(payload) if kind == "response" else int(fields["X-Payload-Length"]),
                            sha1.hex(),
                            kind,
                            _page_of(fields.get("WARC-Refers-To")),
                        )
                    )
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
            if file:
                file.close()

    return frames_of.mapInArrow(read, RECORDS)


def find_record(index: DataFrame, page_id: int) -> list[tuple[dict[str, str], bytes]]:
    """Header fields and block of the records of one page: one frame is read for each."""
    found = []
    for row in index.filter(F.col("page_id") == page_id).collect():
        filesystem, path = _open(row.bundle)
        with filesystem.open_input_file(path) as file:
            offset, packed, full = read_seek_table(file)[row.frame]
            data = read_frame(file, offset, packed, full)[row.place :]
        _, fields, block = next(parse_records(data))
        found.append((fields, block))
    return found


def archive_folder(pages: DataFrame) -> str:
    """A new folder for bundles beside this application's steps."""
    return f"{steps_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
