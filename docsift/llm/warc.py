"""WARC archives: a writer and a salvage reader.

The writer makes record-wise compressed archives: each record is a gzip
member, followed by a fixed member that holds the record's closing
``CRLF CRLF``, so that unpacking a whole file gives a plain WARC file.

The salvage reader takes compressed, plain and mixed files. It checks every
record (member checksum, version line, header, length, closing lines, block
and payload digest). After a failed check it searches for the next gzip
member or version line *that passes the checks*, goes on there, and logs the
bytes in between as a gap. Records and gaps together cover the file, but for
closing lines between records.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bounded, read_files, write_records

# Fixed values of the WARC 1.1 and HTTP formats.
VERSION = b"WARC/1.1\r\n"
CLOSING = b"\r\n\r\n"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
GZIP_MAGIC = b"\x1f\x8b\x08"

RECORD_ID = "urn:x-page:"
CLOSING_MEMBER = gzip.compress(CLOSING, mtime=0)

_VERSION_LINE = re.compile(rb"WARC/(?:0\.1[78]|1\.[01])\r\n")
_NEXT = re.compile(rb"\x1f\x8b\x08|WARC/(?:0\.1[78]|1\.[01])\r\n")
_PIECE = 1 << 16


# ------------------------------------------------------------------ writing

def _header_text(value: str | None) -> str:
    """A header value on one line: control characters are percent-encoded."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def _sha1_32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page_id: int | None, url: str | None, payload: bytes, digest_hex: str, refers_to: int | None,
           date: str) -> bytes:
    """One plain record without its closing lines. With ``refers_to`` it is a
    revisit: the HTTP header (with the payload's length) and no payload."""
    block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
             f"Content-Length: {len(payload)}\r\n\r\n").encode()
    if refers_to is None:
        block += payload
    head = [("WARC-Type", "response" if refers_to is None else "revisit"),
            ("WARC-Record-ID", f"<{RECORD_ID}{'' if page_id is None else page_id}>"), ("WARC-Date", date),
            ("WARC-Target-URI", _header_text(url)),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest_hex)).decode()),
            ("WARC-Block-Digest", _sha1_32(block))]
    if refers_to is not None:
        head += [("WARC-Refers-To", f"<{RECORD_ID}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    head += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return VERSION + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n" + block


def mark_revisits(pages: DataFrame, *, id_col: str = "page_id", payload_col: str = "html",
                  url_col: str | None = "url", min_bytes: int = 1000) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: of rows with equal
    payloads of ``min_bytes`` at least, those with the largest id are
    responses (``refers_to`` NULL; repeated rows of that id all are), the
    others refer to it. A NULL payload is empty; a NULL id refers to the
    largest known id. Copies are counted by digest with partial sums, and the
    join back is on the digest, of which large groups are split by adaptive
    skew joins; short payloads join on nothing."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"").cast("binary"))
    url = F.col(url_col) if url_col else F.lit(None)
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), url.cast("string").alias("url"),
                        payload.alias("payload"), F.sha1(payload).alias("digest"))
    large = F.octet_length("payload") >= min_bytes
    copies = (rows.where(large).groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.max("page_id").alias("first"))
              .where("n > 1").select(F.col("digest").alias("key"), "first"))
    own = F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.col("digest")))  # matches no digest
    rows = rows.withColumn("key", F.when(large, F.col("digest")).otherwise(own))
    other = F.col("page_id").isNull() | (F.col("page_id") != F.col("first"))
    return rows.join(copies, "key", "left").select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("first")).alias("refers_to"))


def write_archives(pages: DataFrame, path: str, *, id_col: str = "page_id", payload_col: str = "html",
                   url_col: str | None = "url", min_bytes: int = 1000, file_bytes: int = 16 << 20,
                   compress: bool = True, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write a record per row (see :func:`mark_revisits`) under ``path``, in
    files of about ``file_bytes`` (one longer record stays whole). An empty
    table writes no record; further columns are not read."""
    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, size = [], 0
        for batch in bounded(batches, "payload"):
            for r in batch.to_pylist():
                data = record(r["page_id"], r["url"], r["payload"], r["digest"], r["refers_to"], date)
                data = gzip.compress(data, 6, mtime=0) if compress else data
                if made and size + len(data) > file_bytes:
                    yield pa.record_batch([pa.array([closing.join(made)], pa.binary())], ["file"])
                    made, size = [], 0
                made.append(data)
                size += len(data) + len(closing)
        if made:
            yield pa.record_batch([pa.array([closing.join(made)], pa.binary())], ["file"])

    closing = CLOSING_MEMBER if compress else CLOSING
    rows = mark_revisits(pages, id_col=id_col, payload_col=payload_col, url_col=url_col, min_bytes=min_bytes)
    write_records(rows.mapInArrow(files, "file binary"), "file", path, closing, records_per_file=1)


# ------------------------------------------------------------------ salvage

class Bad(Exception):
    """A failed check, with its reason."""


def _digest_hex(value: str | None) -> str | None:
    """Lower-case hex of a ``sha1:`` header value in base 32 or hex; None for
    other digests."""
    name, _, text = (value or "").partition(":")
    if name.strip().lower() != "sha1":
        return None
    text = text.strip()
    if re.fullmatch("[0-9a-fA-F]{40}", text):
        return text.lower()
    try:
        return base64.b32decode(text.upper()).hex()
    except ValueError:
        raise Bad("unreadable digest") from None


def _headers(lines: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    last = None
    for line in lines.split(b"\r\n"):
        if line[:1] in (b" ", b"\t") and last:
            out[last] += " " + line.strip().decode("utf-8", "replace")
            continue
        name, colon, value = line.partition(b":")
        if not colon or not re.fullmatch(rb"[!#$%&'*+\-.^_`|~0-9A-Za-z]+", name):
            raise Bad("malformed header")
        last = name.decode().lower()
        out[last] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes, at: int, in_member: bool = False) -> tuple[int, dict]:
    """The checked record that starts at ``at``, and the place after its
    closing lines. Raises :class:`Bad`. ``in_member``: the closing lines may
    be missing at the end of the data (they are a member of their own)."""
    first = _VERSION_LINE.match(data, at)
    if not first:
        raise Bad("no version line")
    # a header without fields ends at once; it then lacks its length
    end = data.find(CLOSING, first.end() - 2)
    if end < 0:
        raise Bad("header does not end")
    fields = _headers(data[first.end(): end]) if end > first.end() else {}
    if not re.fullmatch("[0-9]+", fields.get("content-length", "")):
        raise Bad("no length")
    if not fields.get("warc-type") or not fields.get("warc-record-id"):
        raise Bad("no type or record id")
    start = end + len(CLOSING)
    stop = start + int(fields["content-length"])
    if stop > len(data):
        raise Bad("truncated block")
    after = stop + len(CLOSING)
    if data[stop: after] != CLOSING:
        if not (in_member and stop == len(data)):
            raise Bad("no closing lines")
        after = stop
    block = data[start: stop]
    told = _digest_hex(fields.get("warc-block-digest"))
    if told and told != hashlib.sha1(block).hexdigest():
        raise Bad("block digest differs")
    payload, size = block, len(block)
    if fields.get("content-type", "").lower().startswith("application/http"):
        cut = block.find(CLOSING)
        if cut >= 0:
            payload = block[cut + len(CLOSING):]
            length = re.search(rb"\r\ncontent-length:[ \t]*([0-9]+)", block[:cut], re.I)
            size = len(payload)
            if fields["warc-type"] == "revisit" and length:
                size = int(length[1])
    told = _digest_hex(fields.get("warc-payload-digest"))
    if fields["warc-type"] == "revisit":
        digest = told
    else:
        digest = hashlib.sha1(payload).hexdigest()
        if told and told != digest:
            raise Bad("payload digest differs")
    return after, {"fields": fields, "payload": payload, "payload_bytes": size, "payload_digest": digest}


def _member(data: bytes, at: int) -> tuple[int, bytes]:
    """The unpacked member at ``at`` (its checksum and length hold) and the
    place after it. The input is fed in pieces, so a file is never copied for
    each member."""
    unpack = zlib.decompressobj(31)
    out, view = [], memoryview(data)
    while not unpack.eof:
        piece = view[at: at + _PIECE]
        if not piece:
            raise Bad("truncated member")
        try:
            out.append(unpack.decompress(piece))
        except zlib.error as e:
            raise Bad("damaged member") from e
        at += len(piece) - len(unpack.unused_data)
    return at, b"".join(out)


def _unit(data: bytes, at: int) -> tuple[int, list[dict]]:
    """Events of the member or plain record at ``at`` and the place after it."""
    if data.startswith(GZIP_MAGIC, at):
        after, inner = _member(data, at)
        if not inner.strip(b"\r\n"):
            return after, []
        if not _VERSION_LINE.match(inner):
            raise Bad("member holds no record")
        # a member with several records is searched like a file
        events = list(_events(inner, True))
        if not any(e["kind"] == "record" for e in events):
            raise Bad(events[0]["reason"])
        return after, [e | {"offset": at, "length": after - at, "inner": e["offset"]} for e in events]
    after, found = parse_record(data, at)
    return after, [found | {"kind": "record", "offset": at, "length": after - at, "inner": None, "reason": None}]


def _plain(data: bytes, at: int) -> tuple[int, list[dict]]:
    after, found = parse_record(data, at, in_member=True)
    return after, [found | {"kind": "record", "offset": at, "length": after - at, "inner": None, "reason": None}]


def _events(data: bytes, in_member: bool) -> Iterator[dict]:
    take = _plain if in_member else _unit
    at, gap, why = 0, None, None
    while at < len(data):
        if gap is None and data.startswith(b"\r\n", at):
            at += 2  # closing lines
            continue
        try:
            after, events = take(data, at)
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            found = _NEXT.search(data, at + 1)
            at = found.start() if found else len(data)
            continue
        if gap is not None:
            yield {"kind": "gap", "offset": gap, "length": at - gap, "inner": None, "reason": why}
            gap = None
        yield from events
        at = after
    if gap is not None:
        yield {"kind": "gap", "offset": gap, "length": len(data) - gap, "inner": None, "reason": why}


def salvage(data: bytes) -> Iterator[dict]:
    """Records and gaps of one file in order. ``kind`` is ``record`` or
    ``gap``; a gap has its ``offset``, ``length`` and the ``reason`` of the
    first failed check; events inside a member also have their ``inner``
    offset. A file without a single valid record is one gap; an empty file
    has no events."""
    return _events(data, False)


READ_SCHEMA = ("path string, kind string, offset long, length long, inner_offset long, reason string, "
               "warc_type string, record_id string, refers_to string, target_uri string, "
               "headers map<string,string>, payload_bytes long, payload_digest string, payload binary")


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """All records and gaps of the archives under ``path``
    (:data:`READ_SCHEMA`; ``payload`` is NULL unless asked for). One task
    holds one file at a time."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content")):
                made, size = [], 0
                for e in salvage(content.as_buffer().to_pybytes()):
                    f = e.get("fields", {})
                    made.append((name, e["kind"], e["offset"], e["length"], e["inner"], e["reason"], f.get("warc-type"),
                                 f.get("warc-record-id"), f.get("warc-refers-to"), f.get("warc-target-uri"),
                                 list(f.items()), e.get("payload_bytes"), e.get("payload_digest"),
                                 e.get("payload") if with_payload else None))
                    size += len(made[-1][-1] or b"") + 500
                    if size > 8 << 20:
                        yield table(made)
                        made, size = [], 0
                if made:
                    yield table(made)

    def table(made: list[tuple]) -> pa.RecordBatch:
        text, num = pa.string(), pa.int64()
        kinds = [text, text, num, num, num, text, text, text, text, text, pa.map_(text, text), num, text, pa.binary()]
        names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*made), kinds)], names)

    return read_files(spark, path).mapInArrow(rows, READ_SCHEMA)


def page_number(column: str):
    """The page id inside a record id of this module's writer."""
    return F.regexp_extract(column, f"<{RECORD_ID}(-?[0-9]+)>", 1)
