"""WARC archives: written from pages with one gzip member per record, read sequentially.

Of pages with equal payloads the one with the smallest id becomes a `response`; the others
become `revisit` records that name it and carry no payload. Payloads below `least` bytes
are always responses.

Tasks write archives under names of their own and report them in a stored manifest, so
a lost or repeated task leaves at most an unlisted file, which is never read. The reader
takes a file front to back: it inflates piece by piece, frames records by their content
length, and checks block and payload digests. It holds a piece at a time, the header of one
record, however long its url, and a payload only where payloads are asked for.

Null html is an empty payload; a null url is left out. In a header a url's line ends are
spelled %0D and %0A, and it comes back so, without blanks around it. A null page id never becomes the
response while another page has the payload. Repeated rows of the smallest id are responses
alike. No page gives no archive and no row. Other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstar.sources.scratch import shared_folder, stored

CHUNK = 1 << 16
ARCHIVE_BYTES = 256 << 20
LEVEL = 5
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n"


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def _id(number: int | None) -> str:
    return "<urn:x-page:{}>".format("" if number is None else number)


def _number(spelled: str | None) -> int | None:
    digits = (spelled or "")[len("<urn:x-page:") : -1]
    return int(digits) if digits else None


def _header(lines: list[tuple[str, str]], first: str) -> bytes:
    spelled = [first, *(f"{name}: {value}" for name, value in lines)]
    return "\r\n".join(x.replace("\r", "%0D").replace("\n", "%0A") for x in spelled).encode() + END + END


def member(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str = DATE) -> Iterator[bytes]:
    """The bytes of one record, a whole gzip member, piece by piece."""
    digest = _base32(hashlib.sha1(payload).digest())
    http = _header([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", str(len(payload)))], "HTTP/1.1 200 OK")
    body = b"" if revisit else payload
    block = hashlib.sha1(http)
    block.update(body)
    lines = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", _id(page_id)),
        ("WARC-Date", date),
        ("WARC-Block-Digest", f"sha1:{_base32(block.digest())}"),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(http) + len(body))),
    ]
    if url is not None:
        lines.append(("WARC-Target-URI", url))
    if revisit:
        lines += [("WARC-Profile", PROFILE), ("WARC-Refers-To", _id(refers_to))]
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    yield packer.compress(_header(lines, "WARC/1.1") + http)
    for at in range(0, len(body), CHUNK):
        yield packer.compress(body[at : at + CHUNK])
    yield packer.compress(END + END) + packer.flush()


class _Member:
    """One gzip member of a stream, inflated as it is read."""

    def __init__(self, stream, pending: bytes):
        self.stream = stream
        self.pending = pending
        self.inflate = zlib.decompressobj(31)
        self.ready = bytearray()

    def _fill(self) -> bool:
        while not self.inflate.eof:
            data = self.inflate.unconsumed_tail or self.pending or self.stream.read(CHUNK)
            self.pending = b""
            if not data:
                raise ValueError("the archive ends inside a record")
            out = self.inflate.decompress(data, CHUNK)
            if out:
                self.ready += out
                return True
        return False

    def head(self) -> list[str]:
        """Lines up to the next empty one."""
        seen = 0
        while (end := self.ready.find(END + END, seen)) < 0:
            # What was looked through need not be again, but for the start of an end.
            seen = max(0, len(self.ready) - 3)
            if not self._fill():
                raise ValueError("a record's header does not end")
        lines = bytes(self.ready[:end]).decode(errors="replace").split("\r\n")
        del self.ready[: end + 4]
        return lines

    def take(self, size: int) -> Iterator[bytes]:
        """Exactly this many bytes, in pieces."""
        while size:
            if not self.ready and not self._fill():
                raise ValueError("a record is shorter than its content length")
            piece = bytes(self.ready[:size])
            del self.ready[: len(piece)]
            size -= len(piece)
            yield piece

    def close(self) -> bytes:
        """Check the end of the record; returns what was read beyond the member."""
        if b"".join(self.take(4)) != END + END or self.ready or self._fill():
            raise ValueError("a record is longer than its content length")
        return self.inflate.unused_data


def _named(lines: list[str]) -> dict[str, str]:
    split = (line.split(":", 1) for line in lines if ":" in line)
    return {name.strip().lower(): value.strip() for name, value in split}


def _record(source: _Member, with_payload: bool) -> dict:
    version, *lines = source.head()
    if not version.startswith("WARC/1."):
        raise ValueError(f"no WARC record: {version[:40]!r}")
    named = _named(lines)
    left = int(named["content-length"])
    block, inner, payload, kept = hashlib.sha1(), bytearray(), hashlib.sha1(), []
    length, http = 0, None
    for piece in source.take(left):
        block.update(piece)
        if http is None:
            inner += piece
            end = inner.find(END + END)
            if end < 0:
                continue
            http = _named(bytes(inner[:end]).decode(errors="replace").split("\r\n"))
            piece = bytes(inner[end + 4 :])
        payload.update(piece)
        length += len(piece)
        if with_payload:
            kept.append(piece)
    if http is None:
        raise ValueError("an HTTP header does not end")
    kind = named["warc-type"]
    told = named["warc-payload-digest"].removeprefix("sha1:")
    if named["warc-block-digest"].removeprefix("sha1:") != _base32(block.digest()):
        raise ValueError(f"block digest of {named['warc-record-id']} differs")
    if kind == "response" and (told != _base32(payload.digest()) or length != int(http["content-length"])):
        raise ValueError(f"payload of {named['warc-record-id']} differs from its digest")
    return {
        "page_id": _number(named["warc-record-id"]),
        "url": named.get("warc-target-uri"),
        "payload_bytes": int(http["content-length"]),
        "payload_digest": told,
        "record_type": kind,
        "refers_to": _number(named.get("warc-refers-to")),
        "payload": b"".join(kept) if with_payload and kind == "response" else None,
    }


def records(stream, with_payload: bool = False) -> Iterator[dict]:
    """Every record of an open archive in order."""
    pending = stream.read(CHUNK)
    while pending:
        source = _Member(stream, pending)
        yield _record(source, with_payload)
        pending = source.close() or stream.read(CHUNK)


def write_archives(pages: DataFrame, folder: str, least: int = 0, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write every page to archives under the folder, which all executors reach.

    Returns the stored manifest: path, records and bytes of each archive. A shuffle on the
    payload brings a page and its group's first id together; it has one row for each
    payload on its other side, so that a hot payload is split like any skewed join.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8").alias("payload"),
    )
    keyed = rows.withColumn("same", F.sha2("payload", 256))
    firsts = keyed.groupBy("same").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("alike"))
    firsts = firsts.filter("alike > 1").drop("alike")
    repeats = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")) & (F.length("payload") >= least)
    planned = keyed.join(firsts, "same", "left").select("page_id", "url", "payload", "first", repeats.alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = pafs.FileSystem.from_uri(folder)
        out, name, count, size = None, "", 0, 0

        def told() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pydict({"path": [f"{folder}/{name}"], "records": [count], "bytes": [size]})

        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns)):
                page_id, url, payload, first, revisit = row
                if out is None:
                    name, count, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}")
                for piece in member(page_id, url, payload, first, revisit):
                    out.write(piece)
                    size += len(piece)
                count += 1
                if size >= archive_bytes:
                    yield told()
                    out = None
        if out is not None:
            yield told()

    store, top = pafs.FileSystem.from_uri(folder)
    store.create_dir(top, recursive=True)
    manifest = planned.mapInArrow(run, "path string, records bigint, bytes bigint")
    return stored(manifest)


def read_archives(manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """Every record of the listed archives, each read by one task front to back and checked.

    Columns: page_id, url, payload_bytes and payload_digest of the full payload,
    record_type, refers_to, and payload (null for revisits, or unless asked for).
    """
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                store, at = pafs.FileSystem.from_uri(path)
                held, size = [], 0
                with store.open_input_stream(at) as stream:
                    for record in records(stream, with_payload):
                        held.append(record)
                        size += 200 + len(record["payload"] or b"")
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names)
                            held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_arrays([pa.array([r[n] for r in held], k) for n, k in zip(names, kinds)], names)

    tasks = max(1, manifest.count())
    shape = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, payload binary"
    return manifest.select("path").repartitionByRange(tasks, "path").mapInArrow(run, shape)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives under the one that the cluster shares."""
    return f"{shared_folder(spark)}/warc/{uuid.uuid4().hex}"
