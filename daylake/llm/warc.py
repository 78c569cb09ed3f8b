"""WARC archives: one gzip member per record, written and read as streams.

A payload that several pages share is stored once, in the record of the page with the largest id; the
others are revisit records that name it. The reader goes through a file in order, decompresses one
member at a time in small steps, frames each block by its Content-Length and verifies its digests.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daylake.llm.common import batch, shared_folder, stored, workers_import

VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads from this size on are stored once.
LEAST_SHARED = 1_000
#: A file is closed when it has reached this size.
FILE_BYTES = 1 << 30
CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    """Arrow's file system for a Spark path: local, HDFS, S3 (also named s3a) and others it knows."""
    uri = re.sub(r"^s3[an]:", "s3:", uri)
    if re.match(r"^file:/(?!//)", uri):
        uri = "file:///" + uri.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(uri)


def digest_label(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def digest_hex(label: str) -> str:
    """Bare hex of a `sha1:` label in base 32 or hex."""
    value = label.partition(":")[2] or label
    return value.lower() if len(value) == 40 else base64.b32decode(value.upper()).hex()


def record_id(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(identifier: str) -> int | None:
    value = identifier.strip("<>").removeprefix("urn:page:")
    return int(value) if value else None


def _header_value(text: str) -> str:
    """A header value holds no control characters and no line ends."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record(
    page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False
) -> bytes:
    """One response or revisit record, uncompressed. A revisit keeps the HTTP header of its page,
    whose Content-Length tells the size of the payload that it leaves out."""
    http = (
        f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if revisit else http + payload
    lines = [
        VERSION.decode(),
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {record_id(page_id)}",
        f"WARC-Date: {DATE}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
        f"WARC-Block-Digest: {digest_label(hashlib.sha1(block).digest())}",
        f"WARC-Payload-Digest: {digest_label(hashlib.sha1(payload).digest())}",
    ]
    if url:
        lines.append(f"WARC-Target-URI: {_header_value(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes, level: int = 6) -> bytes:
    """`data` as one gzip member."""
    squeeze = zlib.compressobj(level, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


@dataclass
class Record:
    headers: dict[str, str]
    block: bytes

    @property
    def kind(self) -> str:
        return self.headers["warc-type"]

    def http(self) -> tuple[dict[str, str], bytes]:
        """HTTP header fields and the body that follows them."""
        head, _, body = self.block.partition(b"\r\n\r\n")
        return _fields(head), body


class Damaged(ValueError):
    """A record whose framing or digest is wrong."""


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


def _members(source) -> Iterator[Iterator[bytes]]:
    """Decompressed chunks, member by member. The caller drains each before it takes the next."""
    rest = b""
    while rest := rest or source.read(CHUNK):
        inflate = zlib.decompressobj(31)

        def chunks(inflate=inflate) -> Iterator[bytes]:
            nonlocal rest
            while not inflate.eof:
                if not (data := inflate.unconsumed_tail or rest or source.read(CHUNK)):
                    raise Damaged("the last gzip member is cut off")
                rest = b""
                yield inflate.decompress(data, CHUNK)
            rest = inflate.unused_data

        part = chunks()
        yield part
        for _ in part:  # what the caller left
            pass


def _framed(chunks: Iterator[bytes]) -> Record:
    held = b""
    while (end := held.find(b"\r\n\r\n")) < 0:
        if not (more := next(chunks, None)) and more is None:
            raise Damaged("a record header has no end")
        held += more
    head = held[:end]
    if not head.startswith(b"WARC/"):
        raise Damaged("a member does not begin with a WARC version")
    headers = _fields(head)
    length = int(headers["content-length"])
    parts = [held[end + 4 :]]
    parts += chunks  # to the end of the member, where zlib checks its sum
    body = b"".join(parts)
    if len(body) != length + 4 or body[length:] != b"\r\n\r\n":
        raise Damaged(f"a block of {length} bytes is framed by {len(body)}")
    return Record(headers, body[:length])


def verified(found: Record) -> Record:
    """The record, if the digests that it carries are those of its content."""
    block = found.headers.get("warc-block-digest")
    if block and digest_hex(block) != hashlib.sha1(found.block).hexdigest():
        raise Damaged("a block differs from its digest")
    payload = found.headers.get("warc-payload-digest")
    if payload and found.kind == "response":
        fields, body = found.http()
        if int(fields.get("content-length", len(body))) != len(body):
            raise Damaged("a payload is not as long as its header says")
        if digest_hex(payload) != hashlib.sha1(body).hexdigest():
            raise Damaged("a payload differs from its digest")
    return found


def read_records(source) -> Iterator[Record]:
    """Verified records of an open binary stream, in order. It holds one record at a time."""
    for chunks in _members(source):
        yield verified(_framed(chunks))


MANIFEST = pa.schema([("path", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])


def _write(folder: str, file_bytes: int, level: int):
    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = filesystem(folder)
        sink, path, records, size = None, "", 0, 0
        for part in batches:
            for page_id, url, html, refers_to, revisit in zip(*(c.to_pylist() for c in part.columns), strict=True):
                if sink is None:
                    files.create_dir(root, recursive=True)
                    # Each attempt of a task has a name of its own; the manifest lists the ones that count.
                    path, records, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    sink = files.open_output_stream(f"{root}/{path}", compression=None)
                data = member(record(page_id, url, (html or "").encode("utf-8", "replace"), refers_to, revisit), level)
                sink.write(data)
                records, size = records + 1, size + len(data)
                if size >= file_bytes:
                    sink.close()
                    yield batch(MANIFEST, [f"{folder}/{path}"], [records], [size])
                    sink = None
        if sink is not None:
            sink.close()
            yield batch(MANIFEST, [f"{folder}/{path}"], [records], [size])

    return written


def deduplicated(pages: DataFrame, least_shared: int = LEAST_SHARED) -> DataFrame:
    """(page_id, url, html, refers_to, revisit): which pages are stored as revisits.

    The largest id of each digest that several pages share is found with partial sums before the
    shuffle. The join back leaves it to Spark to broadcast a short list of digests or to split the
    partitions of a frequent one.
    """
    slim = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    raw = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    keyed = slim.select("*", F.when(F.octet_length(raw) >= least_shared, F.unhex(F.sha1(raw))).alias("digest"))
    shared = (
        keyed.where("digest is not null")
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    marked = keyed.join(shared, "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return marked.select(
        "page_id", "url", "html", F.when(revisit, F.col("first")).alias("refers_to"), revisit.alias("revisit")
    )


def write_archives(
    pages: DataFrame,
    folder: str,
    least_shared: int = LEAST_SHARED,
    file_bytes: int = FILE_BYTES,
    level: int = 6,
) -> DataFrame:
    """Write `pages` (page_id, url, html) as archives below `folder`; the manifest of what was written.

    Of pages with equal payloads of at least `least_shared` bytes, the one with the largest id holds
    the payload. Null html is an empty payload, a null url is left out. A null page_id never holds
    for others, unless all ids of its payload are null: then each is a response. Rows that repeat the
    largest id are responses too. The manifest is a written table, so files of lost or repeated task
    attempts are not in it.
    """
    workers_import(pages.sparkSession)
    written = deduplicated(pages, least_shared).mapInArrow(
        _write(folder, file_bytes, level), "path string, records long, bytes long"
    )
    return stored(written, "warc-manifest")


PAGES = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
        ("payload", pa.binary()),
    ]
)


def _read(with_payload: bool, rows: int = 256):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            for path in part.column(0).to_pylist():
                files, place = filesystem(path)
                out: list[tuple] = []
                with files.open_input_stream(place, compression=None) as source:
                    for found in read_records(source):
                        fields, body = found.http()
                        revisit = found.kind == "revisit"
                        out.append(
                            (
                                page_of(found.headers["warc-record-id"]),
                                found.headers.get("warc-target-uri"),
                                int(fields["content-length"]),
                                digest_hex(found.headers["warc-payload-digest"]),
                                found.kind,
                                page_of(found.headers["warc-refers-to"]) if revisit else None,
                                body if with_payload and not revisit else None,
                            )
                        )
                        if len(out) >= rows:
                            yield batch(PAGES, *zip(*out, strict=True))
                            out = []
                if out:
                    yield batch(PAGES, *zip(*out, strict=True))

    return read


def read_archives(manifest: DataFrame, with_payload: bool = True) -> DataFrame:
    """One row per record of the archives in `manifest` (path).

    page_id, url, payload_bytes, payload_digest (lower-case hex SHA-1), record_type, refers_to and, if
    asked for, the payload of responses. Each file is a task of its own, which reads it in order; a damaged
    record fails the task. An empty manifest gives no rows.
    """
    workers_import(manifest.sparkSession)
    # By number, which Spark does not reduce however short the list is.
    files = max(1, manifest.count())
    return manifest.select("path").repartition(files).mapInArrow(
        _read(with_payload),
        "page_id long, url string, payload_bytes long, payload_digest string, record_type string,"
        " refers_to long, payload binary",
    )


def archived(pages: DataFrame) -> DataFrame:
    """`pages` written as archives in the shared folder and read back, without the payloads."""
    folder = shared_folder(pages.sparkSession, "warc")
    return read_archives(write_archives(pages, folder), with_payload=False)
