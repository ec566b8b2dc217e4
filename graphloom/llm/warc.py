"""WARC archives in Zstandard with a shared dictionary: writer and reader (operator 3).

An archive starts with a skippable frame that holds the dictionary; then each record is
one frame.  Archives travel as rows (archive, content), the shape that Spark's binaryFile
source gives for files too.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .cluster import staged
from .textops import chunks

# Fixed values of the formats.
SKIPPABLE, FRAME, DICTIONARY = 0x184D2A5D, 0xFD2FB528, 0xEC30A437
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

ARCHIVE_BYTES = 8 << 20
DICT_BYTES, DICT_PAGES, DICT_SAMPLE = 64 << 10, 400, 32 << 10  # dictionary; it is trained on so many pages' first so many characters
LEVEL = 3
DATE = "1970-01-01T00:00:00Z"  # a fixed date, so that archives of equal input are equal
_FIRST = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Type: application/http; msgtype=response\r\nHTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n<!DOCTYPE html><html><head></head><body></body></html>"


class InvalidArchive(ValueError):
    """An archive or record that breaks the format."""


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def train_dictionary(samples: list[bytes], size: int = DICT_BYTES) -> bytes:
    """A dictionary from samples; where they are too few to train on, the fixed start of a record."""
    try:
        return zstd.train_dictionary(size, samples).as_bytes()
    except zstd.ZstdError:
        return _FIRST


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}", f"WARC-Block-Digest: sha1:{digest(block)}", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def leading_frame(dictionary: bytes) -> bytes:
    packed = zstd.ZstdCompressor(level=19).compress(dictionary)
    return struct.pack("<II", SKIPPABLE, len(packed)) + packed


def frames(content: bytes, at: int = 0) -> Iterator[tuple[int, int, int]]:
    """(kind, start, end) of each frame: kind is the frame's magic number; data of skippable frames only."""
    n = len(content)
    while at < n:
        if n - at < 8:
            raise InvalidArchive(f"cut-off frame at {at}")
        magic, size = struct.unpack_from("<II", content, at)
        if magic & 0xFFFFFFF0 == 0x184D2A50:
            end = at + 8 + size
            if end > n:
                raise InvalidArchive(f"cut-off skippable frame at {at}")
            yield magic, at + 8, end
        elif magic == FRAME:
            try:
                end = at + zstd.frame_header_size(content[at : at + 18])
                checked = zstd.get_frame_parameters(content[at : at + 18]).has_checksum
            except zstd.ZstdError as e:
                raise InvalidArchive(f"bad frame header at {at}: {e}") from e
            last = False
            while not last:
                if end + 3 > n:
                    raise InvalidArchive(f"cut-off frame at {at}")
                head = int.from_bytes(content[end : end + 3], "little")
                last, kind, length = bool(head & 1), head >> 1 & 3, head >> 3
                if kind == 3:
                    raise InvalidArchive(f"reserved block type at {end}")
                end += 3 + (1 if kind == 1 else length)
            end += 4 * checked
            if end > n:
                raise InvalidArchive(f"cut-off frame at {at}")
            yield magic, at, end
        else:
            raise InvalidArchive(f"no frame at {at}")
        at = end


@dataclass
class Record:
    """A validated record; payload is None for revisits."""

    headers: dict[str, str]
    http: dict[str, str]
    payload: bytes | None

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    @property
    def payload_bytes(self) -> int:
        return int(self.http["content-length"])


def _fields(raw: bytes, start: str) -> dict[str, str]:
    lines = raw.decode("utf-8", "surrogatepass").split("\r\n")
    if not re.fullmatch(start, lines[0]):
        raise InvalidArchive(f"unknown first line {lines[0][:60]!r}")
    out: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not re.fullmatch(r"[!#$%&'*+.^_`|~0-9A-Za-z-]+", name):
            raise InvalidArchive(f"bad header line {line[:60]!r}")
        out[name.lower()] = value.strip()
    return out


def parse_record(data: bytes) -> Record:
    """Checks version, required headers, lengths and digests of one record."""
    head, gap, rest = data.partition(b"\r\n\r\n")
    if not gap:
        raise InvalidArchive("header without end")
    h = _fields(head, r"WARC/1\.[01]")
    for need in ("warc-type", "warc-record-id", "warc-date", "content-length"):
        if need not in h:
            raise InvalidArchive(f"missing header {need}")
    if not h["content-length"].isdigit() or len(rest) != int(h["content-length"]) + 4:
        raise InvalidArchive(f"content-length {h['content-length']} of a block of {len(rest) - 4}")
    block, tail = rest[:-4], rest[-4:]
    if tail != b"\r\n\r\n":
        raise InvalidArchive("record without end")
    if h.get("warc-block-digest", "").startswith("sha1:") and h["warc-block-digest"][5:] != digest(block):
        raise InvalidArchive("block digest differs")
    if h["warc-type"] not in ("response", "revisit"):
        return Record(h, {}, block)
    top, gap, payload = block.partition(b"\r\n\r\n")
    if not gap:
        raise InvalidArchive("HTTP header without end")
    http = _fields(top, r"HTTP/\d\.\d \d{3}.*")
    if not http.get("content-length", "").isdigit():
        raise InvalidArchive("HTTP header without length")
    if h["warc-type"] == "revisit":
        if payload or "warc-refers-to" not in h or "warc-payload-digest" not in h:
            raise InvalidArchive("revisit with a payload, or without reference or digest")
        return Record(h, http, None)
    if len(payload) != int(http["content-length"]):
        raise InvalidArchive(f"HTTP length {http['content-length']} of a payload of {len(payload)}")
    if h.get("warc-payload-digest", "").startswith("sha1:") and h["warc-payload-digest"][5:] != digest(payload):
        raise InvalidArchive("payload digest differs")
    return Record(h, http, payload)


def read_archive(content: bytes) -> Iterator[Record]:
    """Records of one archive, one per frame; the dictionary, plain or compressed, comes first."""
    dictionary, first = None, True
    for magic, start, end in frames(content):
        if magic == SKIPPABLE and first:
            raw = content[start:end]
            if raw[:4] == struct.pack("<I", FRAME):
                raw = zstd.ZstdDecompressor().decompress(raw)
            dictionary = zstd.ZstdCompressionDict(raw)
            reader = zstd.ZstdDecompressor(dict_data=dictionary)
        elif magic == FRAME:
            if first:
                reader = zstd.ZstdDecompressor()
            try:
                frame = content[start:end]
                size = zstd.frame_content_size(frame)
                data = reader.decompress(frame) if size >= 0 else reader.decompressobj().decompress(frame)
            except zstd.ZstdError as e:
                raise InvalidArchive(f"frame at {start}: {e}") from e
            if size >= 0 and len(data) != size:
                raise InvalidArchive(f"frame at {start} holds {len(data)} bytes of {size}")
            yield parse_record(data)
        first = False


_PAGE = re.compile(r"<urn:x-page:(-?\d*)>")


def _page(uri: str) -> int | None:
    m = _PAGE.fullmatch(uri)
    return int(m[1]) if m and m[1] else None


def _sample(rows: DataFrame) -> list[bytes]:
    """The first DICT_SAMPLE characters of DICT_PAGES pages at most, those with the smallest hashes; only hashes are compared."""
    order = F.xxhash64("page_id", "url")
    last = rows.select(order.alias("o")).orderBy("o").limit(DICT_PAGES).agg(F.max("o")).first()[0]
    if last is None:
        return []
    some = rows.where(order <= last).select(F.substring("html", 1, DICT_SAMPLE).alias("html")).limit(DICT_PAGES)
    return sorted(r.html.encode() for r in some.collect())


def write_archives(pages: DataFrame, least: int = 0, limit: int = ARCHIVE_BYTES) -> DataFrame:
    """(archive, records, content): a record per row of pages, in archives of about `limit` bytes.

    Of rows with equal payloads of at least `least` bytes those with the smallest page_id are
    responses, the others revisits of it; a null page_id is larger than any.  A null html is
    an empty payload, a null url leaves out the target.  An empty table gives no archive.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce("html", F.lit("")).alias("html"))
    dictionary = train_dictionary(_sample(rows.where("html <> ''")))
    rows = rows.withColumn("_sha1", F.sha1("html"))
    again = rows.where(F.octet_length("html") >= least).groupBy(F.col("_sha1").alias("_k")).agg(F.count("*").alias("_n"), F.min("page_id").alias("_first")).where("_n > 1").select("_k", "_first")
    dealt = rows.join(again, (rows._sha1 == again._k) & (F.octet_length("html") >= least), "left").select("page_id", "url", "html", "_first")

    def run(batches):
        from pyspark import TaskContext

        part, count = TaskContext.get().partitionId(), 0
        packer = zstd.ZstdCompressor(level=LEVEL, dict_data=zstd.ZstdCompressionDict(dictionary), write_checksum=True, write_content_size=True)
        lead = leading_frame(dictionary)
        held, size = [], 0

        def archive():
            return pa.RecordBatch.from_arrays([pa.array([f"pages-{part:06d}-{count:05d}.warc.zst"]), pa.array([len(held)]), pa.array([b"".join([lead, *held])], pa.binary())], names=["archive", "records", "content"])

        for batch in batches:
            for piece in chunks(batch, "html"):
                for page_id, url, html, first in zip(*[c.to_pylist() for c in piece.columns]):
                    revisit = first is not None and page_id != first
                    held.append(packer.compress(record(page_id, url, html.encode("utf-8", "surrogatepass"), first, revisit)))
                    size += len(held[-1])
                    if size >= limit:
                        yield archive()
                        held, size, count = [], 0, count + 1
        if held:
            yield archive()

    return dealt.mapInArrow(run, "archive string, records long, content binary")


def export_archives(archives: DataFrame, folder: str) -> DataFrame:
    """Writes each archive as a file of its name into a folder that all executors reach, and returns the names.

    The folder is any URI that pyarrow.fs opens; a file is written whole, so a repeated task only writes it again.
    """

    def run(batches):
        from pyarrow import fs

        where, path = fs.FileSystem.from_uri(folder)
        where.create_dir(path, recursive=True)
        for batch in batches:
            for name, content in zip(batch.column("archive").to_pylist(), batch.column("content").to_pylist()):
                with where.open_output_stream(f"{path}/{name}", compression=None) as f:
                    f.write(content)
            yield batch.select(["archive"])

    return archives.select("archive", "content").mapInArrow(run, "archive string")


def read_archives(archives: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to, url, payload) of each record.

    archives: rows with a binary column `content`, as of write_archives or spark.read.format("binaryFile").
    Each record is validated; a broken one raises InvalidArchive.  payload is null for
    revisits.  Null contents hold no records.
    """

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]

    def run(batches):
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for r in read_archive(content.as_py() or b""):
                    if r.kind in ("response", "revisit"):
                        to = r.headers.get("warc-refers-to")
                        held.append((_page(r.headers["warc-record-id"]), r.payload_bytes, r.headers["warc-payload-digest"].partition(":")[2], r.kind, _page(to) if to else None, r.headers.get("warc-target-uri"), r.payload))
                        size += len(r.payload or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types)], names=names)

    return archives.select("content").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, payload binary")


def op3_warc_roundtrip(spark, sf_dir: str) -> DataFrame:
    archives = staged(write_archives(spark.read.parquet(f"{sf_dir}/pages.parquet")), "archives")
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
