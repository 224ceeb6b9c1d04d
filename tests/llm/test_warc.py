"""Round trips through WARC archives, and salvage of damaged ones."""

from __future__ import annotations

import glob
import gzip
import hashlib
import random
import zlib

import pytest

from meterline.llm import warc

SCHEMA = "page_id long, url string, html string, payload string, digest string, first long, n int, refers_to long, path string"
DATE = "2000-01-01T00:00:00Z"


def sha(b):
    return hashlib.sha256(b).hexdigest()


def member(b):
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(b) + z.flush()


def page_rows():
    long = "<p>" + "x" * 97
    html = [None, "", "short", "short", long, long, long, long[:-1], long[:-1], "é" * 50, "é" * 50, "é" * 49, "z" * 3_000_000, "z" * 3_000_000,
            "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, "a\r\n\r\nb" * 30, "\0" * 200, "\x1f\u008b\x08" * 80]
    rows = [(100 - k, f"http://h/{k}?q=ü x\r\nInjected: 1", h) for k, h in enumerate(html)]
    rows += [(7, None, long), (7, "http://again", long), (None, "http://none", long), (None, None, "w" * 100), (None, None, "w" * 100), rows[12]]
    return rows


def brute(rows):
    first = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        other = first.get(b, i)
        out.append((i, len(b), sha(b), "response" if other == i else "revisit", None if other == i else other))
    return sorted(out, key=repr)


@pytest.mark.parametrize("compress, archive_bytes", [(True, 1), (True, 1 << 24), (False, 1), (False, 1 << 24)])
def test_round_trip(spark, tmp_dir, compress, archive_bytes):
    rows = page_rows()
    pages = spark.createDataFrame([(*r, "p", "d", 1, 2, 3, "x") for r in rows], SCHEMA).repartition(3)
    path = f"{tmp_dir}/warc"
    warc.write(warc.with_originals(pages), path, compress=compress, archive_bytes=archive_bytes)
    assert sorted((tuple(r) for r in warc.archived_pages(spark, path).collect()), key=repr) == brute(rows)
    found = warc.read(spark, path).collect()
    assert not [r for r in found if r["reason"]]
    kept = {(r["page_id"], r["payload_digest"]): None for r in warc.archived_pages(spark, path).collect()}
    assert len(kept) and all(sha(bytes(r["payload"])) == r["payload_digest"] for r in found if r["record_type"] == "response")
    files = glob.glob(f"{path}/*.txt")
    data = [open(f, "rb").read() for f in files]
    plain = b"".join(gzip.decompress(d) if compress else d for d in data)  # any gzip reader takes the archives
    assert plain.count(b"WARC/1.1\r\nWARC-Type: re") >= len(rows)
    assert len(files) >= len(rows) if archive_bytes == 1 else len(files) <= 8


def test_empty(spark, tmp_dir):
    warc.write(warc.with_originals(spark.createDataFrame([], SCHEMA)), f"{tmp_dir}/warc")
    assert warc.archived_pages(spark, f"{tmp_dir}/warc").collect() == []


def parts(n=40, compress=True):
    rng = random.Random(5)
    out = []
    for i in range(n):
        p = bytes(rng.choices(b"abc \r\n\0", k=rng.randint(0, 3000)))
        one = warc.record(i, f"http://x/{i}", p, sha(p), None, DATE)
        out.append(member(one) if compress else one)
    return out


def ids(found):
    return [int(c["record_id"].rsplit(":", 1)[1]) for _, _, reason, c in found if reason is None]


@pytest.mark.parametrize("compress", [True, False])
@pytest.mark.parametrize("seed", range(12))
def test_damage_costs_only_what_it_touches(compress, seed):
    """Bytes flipped, cut out and put in: all untouched records are recovered,
    none is altered, and records, gaps and padding cover the file."""
    rng, records = random.Random(seed), parts(compress=compress)
    data, touched, whole = b"", set(), {}
    for i, p in enumerate(records):
        kind = rng.choice(["whole"] * 5 + ["flip", "cut", "junk", "zeros"])
        if kind == "flip":
            at = rng.randrange(0 if compress else p.index(b"\r\n\r\n"), len(p))  # plain heads have no digest
            p, touched = p[:at] + bytes([p[at] ^ (1 << rng.randrange(8))]) + p[at + 1:], touched | {i}
        elif kind == "cut":
            at = rng.randrange(len(p))
            p, touched = p[:at] + p[at + rng.randint(1, 200):], touched | {i}
        elif kind == "junk":
            data += rng.choice([b"junk", b"\x1f\x8b\x08\0junk", b"WARC/1.1\r\njunk\r\n\r\n", b"\nWARC/1.0\r\nContent-Length: 99999\r\n\r\n"])
        elif kind == "zeros":
            data += bytes(rng.randint(1, 50))
        whole[i] = len(data)
        data += p
    found = list(warc.salvage(data))
    got = ids(found)
    # A flip may fall where nothing is checked (gzip's time stamp, a date).
    assert set(range(len(records))) - touched <= set(got) and len(got) == len(set(got))
    payloads = {int(c["record_id"].rsplit(":", 1)[1]): sha(c["payload"]) for _, _, r, c in found if r is None}
    for i, p in enumerate(records):
        if i in payloads:
            plain = zlib.decompress(p, 31) if compress else p
            assert payloads[i] == sha(next(warc.salvage(plain))[3]["payload"])
    end = 0
    for offset, length, reason, _ in found:
        assert data[end:offset].strip(b"\0") == b"" and length > 0
        end = offset + length
    assert data[end:].strip(b"\0") == b""


@pytest.mark.parametrize("compress", [True, False])
def test_truncated_file(compress):
    records = parts(6, compress)
    data = b"".join(records)[:-5]
    found = list(warc.salvage(data))
    assert ids(found) == [0, 1, 2, 3, 4]
    assert found[-1][:3] == (sum(map(len, records[:5])), len(records[5]) - 5, "truncated")


@pytest.mark.parametrize("change, reason", [
    (lambda b: b.replace(b"Content-Length: ", b"Content-Length: 9", 2), "truncated"),
    (lambda b: b.replace(b"WARC-Type", b"WARC-Typo"), "header fields"),
    (lambda b: b.replace(b"payload", b"pAyload"), "block digest"),
    (lambda b: b.replace(b"sha256:", b"sha256:0", 1), "payload digest"),
    (lambda b: b.replace(b"WARC/1.1", b"WARC/2.1", 1), "version line"),
    (lambda b: b[:-2], "truncated"),
    (lambda b: b[:-1] + b"x", "record end"),
])
def test_every_check_is_made(change, reason):
    one = warc.record(1, "u", b"the payload", sha(b"the payload"), None, DATE)
    assert [r for _, _, r, _ in warc.salvage(one)] == [None]
    for data in (change(one), member(change(one))):
        assert [r for _, _, r, _ in warc.salvage(data)] == [reason]


def test_other_writers_members_and_digests():
    """Several records in one member, sha1 in base32, unknown digests, other types."""
    import base64
    block = b"anything"
    sha1 = base64.b32encode(hashlib.sha1(block).digest()).decode()
    one = lambda kind, digest: (f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:uuid:1>\r\nWARC-Block-Digest: {digest}\r\n"  # noqa: E731
                                f"Content-Type: text/plain\r\nContent-Length: {len(block)}\r\n\r\n").encode() + block + b"\r\n\r\n"
    data = member(one("warcinfo", f"sha1:{sha1}") + one("resource", "blake3:00")) + one("metadata", f"sha1:{sha1}")
    assert [c["record_type"] for _, _, r, c in warc.salvage(data) if r is None] == ["warcinfo", "resource", "metadata"]
    assert [r for _, _, r, _ in warc.salvage(one("resource", "sha1:AAAA"))] == ["block digest"]


def test_gaps_are_reported_by_file(spark, tmp_dir):
    import os
    os.makedirs(f"{tmp_dir}/a")
    records = parts(10)
    bad = records[3][:20] + b"????" + records[3][24:]
    open(f"{tmp_dir}/a/one.warc.gz", "wb").write(b"".join(records[:3]) + bad + b"".join(records[4:]))
    open(f"{tmp_dir}/a/two.warc.gz", "wb").write(b"".join(records))
    open(f"{tmp_dir}/a/none.warc.gz", "wb").write(b"")
    open(f"{tmp_dir}/a/other.txt", "wb").write(b"not an archive")
    rows = warc.read(spark, f"{tmp_dir}/a").collect()
    gaps = {(r["path"].rsplit("/", 1)[1], r["offset"], r["length"]) for r in rows if r["reason"]}
    assert gaps == {("one.warc.gz", sum(map(len, records[:3])), len(bad)), ("other.txt", 0, 14)}
    assert sum(r["reason"] is None for r in rows) == 19
