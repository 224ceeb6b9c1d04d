"""SimHash near-dedup by covering locality-sensitive hashing.

For radius r there are 2^(r+1) - 1 bit masks: bit i carries a fixed vector
a(i) in {0,1}^(r+1), and mask v keeps the bits with odd <a(i), v>.  Any r bits
are left out by some mask (r linear conditions on r+1 unknowns), so every pair
of fingerprints within r bits agrees on some mask: no pair is missed.

Candidates that share a masked value are verified without listing pairs.  Two
fingerprints differ in at most r bits exactly if the balls around them meet (a
common point, or for odd r a common edge of the cube), so each candidate names
the points of its ball over the bits its mask leaves out, and everyone at one
point is linked to the smallest id there.  A bucket of n candidates costs n
balls, not n * n pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import map_rows, staged, text_bytes
from meterline.llm.components import connected_components

SEED = 42


def fingerprint(text: bytes | None, shingle: int) -> int:
    """Bit b is 1 if it is set in over half of the shingles' XXH64 hashes."""
    words = (text or b"").lower().split()  # bytes.lower() touches A-Z only
    if not words:
        return 0
    line, ends, at = b" ".join(words), [], -1
    for w in words:
        at += len(w) + 1
        ends.append(at)
    starts = [0, *(e + 1 for e in ends[:-1])]
    n = max(1, len(words) - shingle + 1)
    last = ends[min(shingle, len(words)) - 1:]
    hashes = np.fromiter((xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts[:n], last)), "<u8", n)
    ones = np.zeros(64, np.int64)
    for k in range(0, n, 65536):  # unpacked bits take 64 bytes a hash
        ones += np.unpackbits(hashes[k:k + 65536].view("u1").reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp): the 64 bits as a signed long."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], "<u8").view("<i8")
        return pa.record_batch([batch.column(0), pa.array(fps)], names=["doc_id", "fp"])
    return map_rows(text_bytes(documents), run, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 masks; no a(i) is zero, so masks keep over half the bits."""
    space = (1 << radius + 1) - 1
    return [sum(1 << i for i in range(64) if ((1 + i % space) & v).bit_count() & 1) for v in range(1, space + 1)]


def ball(free: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """What to flip, and which edge it is then (-1: the point itself), for two
    fingerprints to meet exactly if they differ in at most ``radius`` of ``free``."""
    flips = [np.bitwise_or.reduce(np.array(c, np.uint64)) if c else np.uint64(0)
             for k in range(radius // 2 + 1) for c in combinations(free, k)]
    flips = np.array(flips, np.uint64)
    if radius % 2 == 0:
        return flips, np.full(len(flips), -1, np.int32)
    return np.repeat(flips, len(free)), np.tile(np.arange(len(free), dtype=np.int32), len(flips))


def near_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) between the ids of distinct fingerprints (id, fp) that
    connect exactly what lies within ``radius`` bits."""
    masks = covering_masks(radius)
    signed = np.array(masks, np.uint64).view(np.int64).tolist()
    tables = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                                 for k, m in enumerate(signed))))
    keyed = prints.select("id", "fp", tables.alias("x")).select("id", "fp", "x.t", "x.key")
    shared = staged(keyed.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n"), "simhash-buckets")
    candidates = staged(keyed.join(shared, ["t", "key"], "left_semi"), "simhash-candidates")
    frees = [np.array([1 << i for i in range(64) if not m >> i & 1], np.uint64) for m in masks]
    balls = [ball(f, radius) for f in frees]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        fps = batch.column(1).to_numpy().view(np.uint64)
        points, edges, ids = [], [], []
        for i, fp, t in zip(batch.column(0).to_pylist(), fps, batch.column(2).to_pylist()):
            flips, edge = balls[t]
            p = flips ^ fp
            if radius % 2:
                bits = frees[t][edge]
                edge = np.log2(bits).astype(np.int32)
                p = p & ~bits  # the edge's lower end
            points.append(p)
            edges.append(edge)
            ids.append(np.full(len(p), i))
        return pa.record_batch([pa.array(np.concatenate(points).view(np.int64)), pa.array(np.concatenate(edges)),
                                pa.array(np.concatenate(ids))], names=["point", "edge", "id"])

    met = map_rows(candidates.select("id", "fp", "t"), run, "point long, edge int, id long")
    first = staged(met.groupBy("point", "edge").agg(F.min("id").alias("b"), F.max("id").alias("top"))
                   .filter("top > b").drop("top"), "simhash-meetings")
    return met.join(first, ["point", "edge"]).filter("id > b").select(F.col("id").alias("a"), "b").distinct()


def simhash_components(documents: DataFrame, *, shingle: int = 3, max_bits: int = 2) -> DataFrame:
    """(doc_id, fingerprint, component_id): 16 hex digits, and the smallest
    doc_id reachable over links of at most ``max_bits`` differing bits.

    Null text and text without words have fingerprint zero and are linked like
    any other.  Fewer words than a shingle: the whole sequence is one shingle.
    Copies share a fingerprint and enter the search once.  Repeated rows give
    equal rows; an empty table gives none; other columns are never read.
    """
    rows = staged(fingerprints(documents, shingle), "simhash-prints", texts=True)
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("id")), "simhash-distinct")
    found = connected_components(near_links(prints, max_bits))
    named = staged(prints.join(found, "id", "left").select("fp", F.coalesce("component", "id").alias("component_id")),
                   "simhash-components")
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
