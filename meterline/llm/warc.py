"""WARC archives: pages written as records, and a reader that salvages damaged files.

Writing.  Every page is a ``response`` record (HTTP head and payload) or, where
an equal payload is kept elsewhere, a ``revisit`` record that names it.  Records
carry digests of payload and block.  Each is a gzip member of its own, or plain;
tasks fill archives of about ``archive_bytes`` and Spark's text writer commits
them, so a lost executor leaves no half archive.  (The writer ends every file
with a separator: a zero byte, which gzip takes as padding, or in plain files
the empty lines that end a record.)

Reading.  A member or record must be whole, well-formed and match its digests.
Where a check fails the reader looks for the next member or version line that
passes them all, goes on from there, and reports the bytes in between as a gap:
every byte of a file is in a record, in a gap, or padding.  A record inside the
payload of a damaged record cannot be told from a record of its own, and the
format has no digest of a plain record's head: gzip members do.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.llm.common import staged

# The WARC format.
VERSION = b"WARC/1.1"
END = b"\r\n"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
PAGE_URN = "urn:page:"

ARCHIVE_BYTES = 16 << 20
BATCH_BYTES = 16 << 20
WINDOW = 1 << 16  # bytes of a member inflated at a time

STARTS = re.compile(rb"\x1f\x8b\x08|WARC/1\.[0-9]\r\n")  # a gap may end within a line
PADDING = re.compile(rb"\0*")
ALGORITHMS = {"sha1": hashlib.sha1, "sha256": hashlib.sha256, "md5": hashlib.md5}

ARCHIVED = ("path string, offset long, length long, reason string, record_type string, record_id string, target_uri string, "
            "refers_to string, payload_bytes long, payload_digest string, payload binary")


def _head(fields: dict) -> bytes:
    return b"".join(f"{k}: {v}".encode() + END for k, v in fields.items() if v is not None)


def _uri(url: str | None) -> str | None:
    """Without characters that would end the header line."""
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda c: f"%{ord(c[0]):02X}", url)


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, date: str) -> bytes:
    """One record, with the empty lines that end it."""
    block = b"HTTP/1.1 200 OK" + END + _head({"Content-Type": "text/html; charset=utf-8", "Content-Length": len(payload)}) + END
    if refers_to is None:
        block += payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit", "WARC-Record-ID": f"<{PAGE_URN}{'' if page_id is None else page_id}>",
        "WARC-Date": date, "WARC-Target-URI": _uri(url), "WARC-Payload-Digest": f"sha256:{digest}",
        "WARC-Block-Digest": f"sha256:{hashlib.sha256(block).hexdigest()}", "Content-Type": "application/http; msgtype=response",
        "Content-Length": len(block)}
    if refers_to is not None:
        fields |= {"WARC-Refers-To": f"<{PAGE_URN}{refers_to}>", "WARC-Profile": IDENTICAL}
    return VERSION + END + _head(fields) + END + block + END + END


def with_originals(pages: DataFrame, *, least: int = 100, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> DataFrame:
    """(page_id, url, payload, digest, refers_to): ``refers_to`` is the smallest
    id among equal payloads of at least ``least`` bytes, where it is another one.

    A payload that is null is empty.  Rows that share the smallest id, and groups
    without any id, refer to nothing.  Payloads are compared by sha256; only
    payloads that occur again are joined, so copies of one page meet in no task."""
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    long, short = (rows.filter(F.octet_length("payload") >= least), rows.filter(F.octet_length("payload") < least))
    again = staged(long.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
                   .filter("n > 1").select("digest", "first"), "warc-originals")
    refers_to = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return (long.join(again, "digest", "left").select("page_id", "url", "payload", "digest", refers_to.alias("refers_to"))
            .unionAll(short.select("page_id", "url", "payload", "digest", F.lit(None).cast("long"))))


def write(records: DataFrame, path: str, *, compress: bool = True, archive_bytes: int = ARCHIVE_BYTES,
          date: str = "2000-01-01T00:00:00Z") -> None:
    """The rows of ``with_originals`` as archives under ``path`` (must not
    exist): gzip members or plain records, in files of ``archive_bytes`` and up
    to one record more.  No rows: no archive."""
    def archive(parts: list[bytes]) -> pa.RecordBatch:
        data = b"".join(parts)
        return pa.record_batch([pa.array([data if compress else data[:-4]], pa.binary())], ["archive"])

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*batch.columns):
                page_id, url, payload, digest, refers_to = (x.as_py() for x in row)
                one = record(page_id, url, payload, digest, refers_to, date)
                if compress:
                    z = zlib.compressobj(6, zlib.DEFLATED, 31)
                    one = z.compress(one) + z.flush()
                held.append(one)
                size += len(one)
                if size >= archive_bytes:
                    yield archive(held)
                    held, size = [], 0
        if held:
            yield archive(held)

    archives = records.select("page_id", "url", "payload", "digest", "refers_to").mapInArrow(fill, "archive binary")
    (archives.select(F.col("archive").cast("string").alias("value")).write.option("lineSep", "\0" if compress else "\r\n\r\n")
     .option("maxRecordsPerFile", 1).text(path))


class Damaged(Exception):
    pass


def _digest_fits(stated: str, data: bytes) -> bool:
    """A digest of an algorithm that is not known here is not held against the data."""
    name, _, value = stated.partition(":")
    if name.lower() not in ALGORITHMS:
        return True
    found = ALGORITHMS[name.lower()](data)
    return value.lower() == found.hexdigest() or value.upper() == base64.b32encode(found.digest()).decode()


def _fields(head: bytes) -> dict[str, str]:
    out = {}
    for line in head.split(END)[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            raise Damaged("header line")
        out[name.strip().lower().decode("utf-8", "replace")] = value.strip().decode("utf-8", "replace")
    return out


def parse_record(data: bytes, at: int) -> tuple[int, dict]:
    """End and content of the record at ``at``; ``Damaged`` if a check fails."""
    if not data.startswith(b"WARC/1.", at):
        raise Damaged("version line")
    head_end = data.find(END + END, at)
    if head_end < 0:
        raise Damaged("header")
    fields = _fields(data[at:head_end])
    if not fields.get("warc-type") or not fields.get("warc-record-id") or not re.fullmatch(r"[0-9]{1,18}", fields.get("content-length", "")):
        raise Damaged("header fields")
    start = head_end + 4
    end = start + int(fields["content-length"])
    if end + 4 > len(data):
        raise Damaged("truncated")
    if data[end:end + 4] != END + END:
        raise Damaged("record end")
    block = data[start:end]
    if not _digest_fits(fields.get("warc-block-digest", ""), block):
        raise Damaged("block digest")
    payload, size = block, len(block)
    if fields.get("content-type", "").startswith("application/http"):
        head, _, payload = block.partition(END + END)
        size = len(payload)
        if fields["warc-type"] == "revisit":
            stated = _fields(head).get("content-length", "")
            size = int(stated) if re.fullmatch(r"[0-9]{1,18}", stated) else None
    if fields["warc-type"] == "revisit":
        name, _, digest = fields.get("warc-payload-digest", "").partition(":")
        digest, payload = (digest.lower() if name == "sha256" else None), None
    else:
        if not _digest_fits(fields.get("warc-payload-digest", ""), payload):
            raise Damaged("payload digest")
        digest = hashlib.sha256(payload).hexdigest()
    return end + 4, {"record_type": fields["warc-type"], "record_id": fields["warc-record-id"].strip("<>"),
                     "target_uri": fields.get("warc-target-uri"), "refers_to": fields.get("warc-refers-to", "").strip("<>") or None,
                     "payload_bytes": size, "payload_digest": digest, "payload": payload}


def inflate(data: bytes, at: int) -> tuple[int, bytes]:
    """End and content of the gzip member at ``at``."""
    z, out, view = zlib.decompressobj(31), bytearray(), memoryview(data)
    try:
        for pos in range(at, len(data), WINDOW):
            piece = view[pos:pos + WINDOW]
            out += z.decompress(piece)
            if len(out) >= 7 and not out.startswith(b"WARC/1."):
                raise Damaged("version line")
            if z.eof:
                return pos + len(piece) - len(z.unused_data), bytes(out)
    except zlib.error:
        raise Damaged("gzip member") from None
    raise Damaged("truncated")


def salvage(data: bytes) -> Iterator[tuple[int, int, str | None, dict]]:
    """(offset, length, reason, content): records have no reason, gaps no
    content.  Records of one member have its offset and length."""
    at, gap = 0, None
    while at < len(data):
        padding = PADDING.match(data, at).end() if gap is None else at
        if padding > at:
            at = padding
            continue
        try:
            if data.startswith(b"\x1f\x8b\x08", at):
                end, content = inflate(data, at)
                found, inner = [], 0
                while inner < len(content):
                    inner, one = parse_record(content, inner)
                    found.append(one)
                if not found:
                    raise Damaged("empty member")
            else:
                end, one = parse_record(data, at)
                found = [one]
        except Damaged as e:
            gap = gap or (at, str(e))
            following = STARTS.search(data, at + 1)
            at = following.start() if following else len(data)
            continue
        if gap:
            yield gap[0], at - gap[0], gap[1], {}
            gap = None
        for one in found:
            yield at, end - at, None, one
        at = end
    if gap:
        yield gap[0], len(data) - gap[0], gap[1], {}


def read(spark: SparkSession, path: str, *, payload: bool = True) -> DataFrame:
    """``ARCHIVED`` rows of every file under ``path``: a row for each record, and
    one with a ``reason`` for each gap.  ``payload_bytes`` and ``payload_digest``
    (sha256) are of the full payload, for revisits as the record states them; a
    revisit has no ``payload``, nor has any row if ``payload`` is false.

    A file is one task's work and must be below 2 GB; all it holds is processed."""
    names = [c.split()[0] for c in ARCHIVED.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(n, {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[t])
                            for n, t in (c.split() for c in ARCHIVED.split(", "))])
        held, size = [], 0
        for batch in batches:
            for name, data in zip(batch.column(0), batch.column(1)):
                for offset, length, reason, one in salvage(data.as_py()):
                    if not payload:
                        one = one | {"payload": None}
                    held.append({"path": name.as_py(), "offset": offset, "length": length, "reason": reason} | one)
                    size += 300 + len(one.get("payload") or b"")
                    if size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, schema)

    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .schema("path string, modificationTime timestamp, length long, content binary").load(path))
    return files.select("path", "content").mapInArrow(rows, ARCHIVED).select(*names)


def page_of(uri: Column) -> Column:
    return F.nullif(F.substring(uri, len(PAGE_URN) + 1, 100), F.lit("")).cast("long")


def archived_pages(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every
    record under ``path``."""
    found = read(spark, path, payload=False).filter(F.col("reason").isNull())
    return found.select(page_of(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                        page_of(F.col("refers_to")).alias("refers_to"))
