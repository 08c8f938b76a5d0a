"""WARC archives in seekable Zstandard bundles.

A page becomes a WARC/1.1 record; a payload that a smaller page_id already
holds becomes a revisit record without payload. Records are grouped into
independent Zstandard frames, frames into bundles; a bundle ends in a seek
table (a skippable frame with the frames' sizes), so any Zstandard reader can
unpack it whole and a seekable one can jump to a frame. The index maps each
record identifier to its frame and the offset inside that frame.

Bundles are rows (name, content, index) of a Parquet table that Spark writes:
the commit is atomic, lost tasks are run again, and it works on every store.
A content is a complete ``.warc.zst`` file. Frames hold about ``FRAME_BYTES``
of records and bundles about ``BUNDLE_BYTES`` of frames (one record more at
most), which bounds a task's memory by its longest page.

Only pages whose payload may occur twice move. A blocked Bloom filter of the
digests (see ``exact_dedup``) tells the others apart, and these become records
in the task that reads them. Of the rest, digests and lengths alone decide
which record is the response; a revisit record needs no html, and one html per
digest follows its response after each task has reduced its copies to one.

Defined results: a null html is an empty payload and empty payloads equal
each other; a null page_id is the smallest and reads back as null; of
repeated rows (one page_id, one payload) one is the response; a null url is
left out, and control characters in it are percent-encoded. Only page_id, url
and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .exact_dedup import filter_blocks, repeat_filter, with_repeat_flag

FRAME_BYTES = 256 * 1024
BUNDLE_BYTES = 4 * 1024 * 1024
LEVEL = 6
DATE = "2024-01-01T00:00:00Z"
# Fixed values of the seekable format: skippable frame magic, seek table magic.
SKIPPABLE_MAGIC, SEEKABLE_MAGIC = 0x184D2A5E, 0x8F92EAB1
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

BUNDLES = ("name string, content binary, "
           "records array<struct<record_id: string, frame: int, position: int, length: int>>")
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def record_id(page_id: int | None, tag: str) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}:{tag}>"


def page_of(identifier: str) -> int | None:
    page = identifier.split(":")[2]
    return int(page) if page else None


def build_record(identifier: str, url, payload: bytes | None, n: int, digest: str, refers_to: str | None) -> bytes:
    """The record of a payload of ``n`` bytes: a response, or a revisit of ``refers_to`` without the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n\r\n".encode()
    block = http if refers_to else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: {identifier}",
            f"WARC-Date: {DATE}"]
    if url is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if refers_to:
        head += [f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {REVISIT_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
             f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def parse_record(record: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of one record."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError("not a WARC record")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    n = int(headers["Content-Length"])
    if rest[n:] != b"\r\n\r\n":
        raise ValueError("record does not end where its length says")
    return headers, rest[:n]


# ------------------------------------------------------------------ bundles
class BundleWriter:
    """Collects records; ``add`` and ``close`` return finished bundles."""

    def __init__(self, prefix: str):
        self.prefix, self.number = prefix, 0
        self.compressor = zstandard.ZstdCompressor(level=LEVEL)
        self._reset()

    def _reset(self):
        self.frames, self.sizes, self.index, self.open, self.open_bytes = [], [], [], [], 0

    def _end_frame(self):
        if self.open:
            raw = b"".join(self.open)
            frame = self.compressor.compress(raw)
            self.frames.append(frame)
            self.sizes.append((len(frame), len(raw)))
            self.open, self.open_bytes = [], 0

    def add(self, identifier: str, record: bytes):
        self.index.append({"record_id": identifier, "frame": len(self.frames), "position": self.open_bytes,
                           "length": len(record)})
        self.open.append(record)
        self.open_bytes += len(record)
        if self.open_bytes >= FRAME_BYTES:
            self._end_frame()
        return self.close() if sum(s for s, _ in self.sizes) >= BUNDLE_BYTES else None

    def close(self):
        self._end_frame()
        if not self.frames:
            return None
        table = b"".join(struct.pack("<II", *s) for s in self.sizes) + struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        content = b"".join(self.frames) + struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table
        out = {"name": f"{self.prefix}-{self.number:05d}.warc.zst", "content": content, "records": self.index}
        self.number += 1
        self._reset()
        return out


class BundleReader:
    """Random access by (frame, position, length) through the seek table."""

    def __init__(self, content: bytes):
        self.content = memoryview(content)
        n, _, magic = struct.unpack("<IBI", self.content[-9:])
        if magic != SEEKABLE_MAGIC:
            raise ValueError("no seek table")
        table = self.content[-9 - 8 * n:-9]
        self.frames, at = [], 0
        for packed, raw in struct.iter_unpack("<II", table):
            self.frames.append((at, packed, raw))
            at += packed
        self.current, self.data = -1, b""

    def record(self, frame: int, position: int, length: int) -> bytes:
        if frame != self.current:
            at, packed, raw = self.frames[frame]
            self.data = zstandard.ZstdDecompressor().decompress(self.content[at:at + packed], max_output_size=raw)
            self.current = frame
        return self.data[position:position + length]


# ------------------------------------------------------------------ on Spark
def with_references(pages: DataFrame) -> DataFrame:
    """One row per record: page_id, tag (tells records of one page_id apart), url, html
    (null for revisits), n_bytes, sha and the page and tag that the record revisits, null
    for responses."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select("page_id", "url", html.alias("html"), F.unhex(F.sha1(html)).alias("sha"))
    slim = staged(rows.select("page_id", "url", F.octet_length("html").cast("long").alias("n_bytes"), "sha",
                              F.monotonically_increasing_id().alias("row_id")), "page_digests")
    blocks = filter_blocks(slim.count())
    bits = staged(repeat_filter(slim, blocks), "page_filter")
    none, digest = F.lit(None), F.hex("sha")
    flagged = with_repeat_flag(rows, bits, blocks)
    alone = flagged.filter("NOT maybe_repeated").select(
        "page_id", digest.alias("tag"), "url", "html", F.octet_length("html").cast("long").alias("n_bytes"), "sha",
        none.cast("long").alias("ref_page"), none.cast("string").alias("ref_tag"))
    # row ids come from the written table, so both of its readers see the same ones
    repeated = with_repeat_flag(slim, bits, blocks).filter("maybe_repeated").withColumn(
        "tag", F.concat_ws("-", digest, F.col("row_id").cast("string")))
    first = staged(repeated.groupBy("sha").agg(F.min(F.struct("page_id", "row_id", "tag", "url", "n_bytes")).alias("first")),
                   "first")
    payload = flagged.filter("maybe_repeated").groupBy("sha").agg(F.first("html").alias("html"))       # all alike
    responses = first.join(payload, "sha").select(
        "first.page_id", "first.tag", "first.url", "html", "first.n_bytes", "sha",
        none.cast("long").alias("ref_page"), none.cast("string").alias("ref_tag"))
    revisits = repeated.join(first, "sha").filter(F.col("row_id") != F.col("first.row_id")).select(
        "page_id", "tag", "url", none.cast("binary").alias("html"), "n_bytes", "sha",
        F.col("first.page_id").alias("ref_page"), F.col("first.tag").alias("ref_tag"))
    return alone.unionByName(responses).unionByName(revisits)


def write_bundles(pages: DataFrame) -> DataFrame:
    """The staged table of bundles (name, content, records)."""
    schema = pa.schema([("name", pa.string()), ("content", pa.binary()),
                        ("records", pa.list_(pa.struct([("record_id", pa.string()), ("frame", pa.int32()),
                                                        ("position", pa.int32()), ("length", pa.int32())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        writer = BundleWriter(f"part-{TaskContext.get().partitionId():06d}")
        for b in batches:
            for row in zip(*b.columns):
                page_id, tag, url, html, n, sha, ref_page, ref_tag = (v.as_py() for v in row)
                refers = None if ref_tag is None else record_id(ref_page, ref_tag)
                identifier = record_id(page_id, tag)
                digest = base64.b32encode(sha).decode()
                done = writer.add(identifier, build_record(identifier, url, html, n, digest, refers))
                if done:
                    yield pa.RecordBatch.from_pylist([done], schema=schema)
        done = writer.close()
        if done:
            yield pa.RecordBatch.from_pylist([done], schema=schema)
    return staged(with_references(pages).mapInArrow(run, BUNDLES), "warc")


def read_bundles(bundles: DataFrame) -> DataFrame:
    """One row per record, read through index and seek table; a response whose payload
    does not match its digest raises."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for content, records in zip(b.column(0), b.column(1)):
                reader = BundleReader(content.as_buffer())
                out = []
                for r in records.as_py():
                    headers, block = parse_record(reader.record(r["frame"], r["position"], r["length"]))
                    http, _, payload = block.partition(b"\r\n\r\n")
                    n = int(re.search(rb"Content-Length: (\d+)", http)[1])
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Record-ID"] != r["record_id"]:
                        raise ValueError("the index points at another record")
                    if kind == "response" and (len(payload) != n or base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
                        raise ValueError(f"payload of {r['record_id']} does not match its digest")
                    out.append((page_of(r["record_id"]), n, digest, kind,
                                page_of(headers["WARC-Refers-To"]) if kind == "revisit" else None))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (
                    pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()))],
                    names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"])
    return bundles.select("content", "records").mapInArrow(run, RECORDS)
