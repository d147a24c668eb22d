"""WARC archives: written as one gzip member per record, read back sequentially.

Writing.  Pages with the same payload are found by its SHA-256 (counts and largest ids are combined before the
shuffle; a popular payload's rows spread by salt in the join).  Each page becomes a `response` record, or a
`revisit` that refers to the response with that payload and repeats its HTTP header, with the payload's
length and digest, but not its bytes.  A task compresses its records one by one and joins them to segments
of about SEGMENT_BYTES; a segment ends with a small `metadata` record that tells the number of its records.
Files hold SEGMENTS of them.  They are written by Spark's own text sink, so a folder in any file system of the
cluster will do and a task that is run again replaces its file: the last byte of a gzip member is the highest
byte of its size, which is zero for that small record, and zero is the sink's line separator.  The files are
plain concatenations of gzip members as other readers expect them.

Reading.  `Reader` takes the bytes of an archive in pieces, inflates one member at a time, frames the block
by Content-Length and hashes it as it comes, so that what it holds does not depend on the size of a
record unless the payload is asked for.  It raises ValueError on a broken member, header or frame, on a
digest that differs, on a wrong count of records and on an archive that ends early.

Defined results: a null payload is empty.  Only payloads of at least `least` bytes are revisited.  Among the
rows of a payload the largest page_id is the response; rows that share it are all responses, a null id is smaller
than all others.  An address that is null or empty is replaced by the record's own name, and
characters that a header cannot hold are percent-encoded.  An empty table gives no archive and no rows.
Columns besides id, url and payload are not stored.
"""

from __future__ import annotations

import hashlib
import re
import urllib.parse
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chatterscope.session import fresh_path

LEAST_BYTES = 1_000
SEGMENT_BYTES = 8 << 20
SEGMENTS = 4
SALTS = 16
PIECE = 1 << 16
DATE = "1970-01-01T00:00:00Z"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_END = b"\r\n\r\n"
_NAME = re.compile(r"<urn:page:(-?\d*)>")
#: Most bytes of the header lines of a record or of HTTP.
MOST_HEADER = 1 << 20


def name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def page_of(name_: str) -> int | None:
    found = _NAME.fullmatch(name_)
    if not found:
        raise ValueError(f"not the name of a page: {name_}")
    return int(found[1]) if found[1] else None


def record(kind: str, fields: list[tuple[str, str]], block: bytes, level: int = 6) -> bytes:
    """One record as a gzip member."""
    digest = hashlib.sha1(block).hexdigest()
    lines = [VERSION, f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields), f"WARC-Date: {DATE}"]
    lines += [f"WARC-Block-Digest: sha1:{digest}", f"Content-Length: {len(block)}"]
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress("\r\n".join(lines).encode() + _END) + packer.compress(block + _END) + packer.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, revisit: bool = False) -> bytes:
    """A response with its payload, or a revisit without."""
    own = name(page_id)
    target = urllib.parse.quote(url, safe=":/?#[]@!$&'()*+,;=%-._~") if url else own[1:-1]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}".encode() + _END
    fields = [("WARC-Record-ID", own), ("WARC-Target-URI", target), ("Content-Type", "application/http; msgtype=response")]
    fields.append(("WARC-Payload-Digest", f"sha1:{hashlib.sha1(payload).hexdigest()}"))
    if not revisit:
        return record("response", fields, http + payload)
    return record("revisit", [*fields, ("WARC-Profile", PROFILE), ("WARC-Refers-To", name(refers_to))], http)


def end_record(n: int) -> bytes:
    """The last record of a segment of n records."""
    return record("metadata", [("WARC-Record-ID", "<urn:segment-end>"), ("Content-Type", "application/warc-fields")], f"records: {n}\r\n".encode())


class Reader:
    """Records of an archive that comes in pieces.

    Iterating gives dictionaries: `type`, `fields` (names in lower case), `http` (the same of an HTTP
    block), `payload_bytes` (of the payload that is there), `payload_digest` (of it), and `payload` if `keep`.
    """

    def __init__(self, pieces: Iterator[bytes], keep: bool = False) -> None:
        self._pieces, self._keep = pieces, keep
        self._raw, self._data, self._member = b"", b"", None

    def _more(self) -> bool:
        """Inflate another piece of the open member; False at its end."""
        while not self._member.eof:
            if not self._raw:
                self._raw = next(self._pieces, b"")
                if not self._raw:
                    raise ValueError("the archive ends within a record")
            try:
                out = self._member.decompress(self._raw, PIECE)
            except zlib.error as e:
                raise ValueError(f"broken gzip member: {e}") from e
            self._raw = self._member.unused_data if self._member.eof else self._member.unconsumed_tail
            if out:
                self._data += out
                return True
        return False

    def _head(self, left: int = MOST_HEADER) -> list[str]:
        """Lines up to an empty one."""
        at = 0
        while (found := self._data.find(_END, at)) < 0:
            at = max(0, len(self._data) - 3)
            if len(self._data) > left or not self._more():
                raise ValueError("header without end")
        lines, self._data = self._data[:found].decode(), self._data[found + 4 :]
        return lines.split("\r\n")

    def _take(self, n: int) -> Iterator[bytes]:
        """The next n bytes of the member, in pieces."""
        while n:
            if not self._data and not self._more():
                raise ValueError("block shorter than its Content-Length")
            part, self._data = self._data[:n], self._data[n:]
            n -= len(part)
            yield part

    @staticmethod
    def _fields(lines: list[str]) -> dict[str, str]:
        pairs = [line.partition(":") for line in lines]
        if not all(mark for _, mark, _ in pairs):
            raise ValueError("header line without a colon")
        return {k.strip().lower(): v.strip() for k, _, v in pairs}

    @staticmethod
    def _same(stated: str | None, found: str, what: str) -> None:
        if stated is not None and stated != f"sha1:{found}":
            raise ValueError(f"{what} digest differs: {stated} stated, sha1:{found} found")

    def _record(self) -> dict:
        version, *lines = self._head()
        if not version.startswith("WARC/"):
            raise ValueError(f"not a record: {version[:20]!r}")
        fields = self._fields(lines)
        length = fields.get("content-length", "")
        if not (length.isascii() and length.isdigit()):
            raise ValueError("record without a Content-Length")
        out = {"type": fields.get("warc-type"), "fields": fields, "http": {}}
        block, payload, kept, head = hashlib.sha1(), hashlib.sha1(), [], None
        size, http = 0, fields.get("content-type", "").startswith("application/http")
        start = b""
        for part in self._take(int(length)):
            block.update(part)
            if http and head is None:
                start += part
                end = start.find(_END)
                if end < 0:
                    if len(start) > MOST_HEADER:
                        break
                    continue
                head = start[:end].decode()
                part = start[end + 4 :]
            size += len(part)
            payload.update(part)
            if self._keep:
                kept.append(part)
        if http:
            if head is None:
                raise ValueError("HTTP header without end")
            out["http"] = self._fields(head.split("\r\n")[1:])
        if b"".join(self._take(4)) != _END or self._data or self._more():
            raise ValueError("the member goes on after its record")
        self._same(fields.get("warc-block-digest"), block.hexdigest(), "block")
        if out["type"] != "revisit":
            self._same(fields.get("warc-payload-digest"), payload.hexdigest(), "payload")
        if self._keep:
            out["payload"] = b"".join(kept)
        return out | {"payload_bytes": size, "payload_digest": payload.hexdigest()}

    def __iter__(self) -> Iterator[dict]:
        while self._raw or (piece := next(self._pieces, b"")):
            self._raw = self._raw or piece
            self._member, self._data = zlib.decompressobj(31), b""
            yield self._record()


def records(pieces: Iterator[bytes], keep: bool = False) -> Iterator[dict]:
    """The records of pages, checked against the counts at the ends of segments."""
    n = 0
    for found in Reader(pieces, keep):
        if found["type"] == "metadata" and found["fields"].get("warc-record-id") == "<urn:segment-end>":
            if "content-length" not in found["fields"] or found["payload_digest"] != hashlib.sha1(f"records: {n}\r\n".encode()).hexdigest():
                raise ValueError(f"{n} records in a segment that tells another number")
            n = 0
            continue
        n += 1
        yield found
    if n:
        raise ValueError("the archive ends within a segment")


def with_targets(pages: DataFrame, least: int = LEAST_BYTES, salts: int = SALTS) -> DataFrame:
    """pages (page_id, url, payload) with `revisit` and `refers_to`."""
    key = F.sha2("payload", 256)
    sized = pages.withColumn("key", F.when(F.length("payload") >= least, key))
    # narrow rows for the counts: the payload itself is not shuffled here
    shared = sized.filter("key IS NOT NULL").groupBy("key").agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    shared = shared.filter("n > 1 AND largest IS NOT NULL").select("key", "largest", spread)
    # rows of a key, and those without one, are spread by their place of reading
    place = F.monotonically_increasing_id()
    own = sized.withColumn("salt", F.pmod(place, F.lit(salts)).cast("int")).withColumn("key", F.coalesce("key", place.cast("string")))
    joined = own.join(shared, ["key", "salt"], "left")
    revisit = F.coalesce(F.coalesce(F.col("page_id"), F.col("largest") - 1) < F.col("largest"), F.lit(False))
    return joined.select(
        "page_id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("largest")).alias("refers_to")
    )


def write(pages: DataFrame, path: str, least: int = LEAST_BYTES, segment: int = SEGMENT_BYTES) -> None:
    """Archives of pages (page_id, url, payload as binary) in a new folder."""

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size, n = [], 0, 0

        def whole() -> pa.RecordBatch:
            data = b"".join([*parts, end_record(n)])
            if data[-1]:
                raise ValueError("a segment's last record is too large")
            return pa.RecordBatch.from_arrays([pa.array([data[:-1]], pa.binary())], names=["data"])

        for batch in batches:
            columns = (batch.column(c) for c in ("page_id", "url", "payload", "revisit", "refers_to"))
            for page_id, url, payload, revisit, refers_to in zip(*columns, strict=True):
                made = page_record(page_id.as_py(), url.as_py(), payload.as_py(), refers_to.as_py(), revisit.as_py())
                parts.append(made)
                size, n = size + len(made), n + 1
                if size >= segment:
                    yield whole()
                    parts, size, n = [], 0, 0
        if parts:
            yield whole()

    own = pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url", F.coalesce("payload", F.lit(b"")).alias("payload"))
    rows = with_targets(own, least)
    segments = rows.mapInArrow(packed, "data binary").select(F.col("data").cast("string"))
    segments.write.option("lineSep", "\0").option("maxRecordsPerFile", SEGMENTS).text(path)


def read(spark: SparkSession, path: str, payload: bool = False) -> DataFrame:
    """(page_id, url, payload_bytes, payload_digest, record_type, refers_to) of all records, and the payload that
    is stored in a record if asked for; size and digest are those of the full payload."""

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column("content"):
                view = memoryview(content.as_buffer())
                pieces = (bytes(view[k : k + PIECE]) for k in range(0, len(view), PIECE))
                rows: list[tuple] = []
                held = 0
                for found in records(pieces, payload):
                    fields = found["fields"]
                    revisit = found["type"] == "revisit"
                    digest = fields["warc-payload-digest"].removeprefix("sha1:") if revisit else found["payload_digest"]
                    size = int(found["http"]["content-length"]) if revisit else found["payload_bytes"]
                    refers_to = page_of(fields["warc-refers-to"]) if revisit else None
                    own = page_of(fields["warc-record-id"])
                    rows.append((own, fields["warc-target-uri"], size, digest, found["type"], refers_to, *([found["payload"]] if payload else [])))
                    held += 200 + (found["payload_bytes"] if payload else 0)
                    if held > 4 << 20:
                        yield as_batch(rows)
                        rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), *([pa.binary()] if payload else [])]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", *(["payload"] if payload else [])]

    def as_batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    schema = "page_id bigint, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(opened, schema + (", payload binary" if payload else ""))


def round_trip(pages: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """What is read from archives of the pages, written below the shared folder."""
    path = fresh_path(pages.sparkSession, "warc")
    write(pages, path, least)
    return read(pages.sparkSession, path)
