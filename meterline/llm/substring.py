"""Substring dedup by recompression.

Rounds of recompression name runs of equal tokens and then adjacent pairs (a
symbol is a left or a right one by its name; a left followed by a right become
one symbol).  A name is a hash of what it stands for, so all tasks everywhere
give equal runs and pairs equal names and no exchange is needed to agree.  What
a symbol inside a window becomes depends on the window alone but for the
window's borders, where a symbol could have joined a neighbour outside; without
those, equal windows hold equal symbols at equal places.  Each window takes the
first symbol that is sure in the highest round that has one as its anchor.

1. reveal: an anchor names a dozen words around it that all of its windows
   share; anchors whose name occurs once in the corpus cannot repeat;
2. verify: neighbouring windows with one anchor are a block, named by all its
   words.  Of equal blocks the earliest stays, and all windows of the others
   repeat.  Where one anchor name has different blocks, the earliest of each
   are compared window by window, by 128-bit digests of the words;
3. remove the words that repeated windows cover.

Counts combine map-side, and tables that occurrences are joined with are
written first, so a passage that a third of all documents share is split by
AQE.  The rows exchanged are anchors (about one per five or six words) of 16
to 30 bytes, and the texts twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import map_rows, staged, with_twin

ROUNDS = 6
CHUNK = 150_000  # bytes handled at once (a longer text is a chunk of its own)
LONG_WORD = 256  # bytes from which on a word is named by one call

_BASE = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def mix(x: np.ndarray) -> np.ndarray:
    """Spread a 64-bit number over all its bits."""
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ x >> np.uint64(33)) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ x >> np.uint64(33)


class Digest:
    """Names of spans of a token sequence, by position-free polynomials."""

    def __init__(self, names: np.ndarray, which: int = 0):
        base = _BASE[which]
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = len(names)
        powers, self.back = (np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, b)))) for b in (base, inverse))
        terms = mix(names + base) * powers[:n]
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)))

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.back[start] + (end - start).astype(np.uint64))


_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)  # keeps the first k of 8 bytes


def named(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words, and which word each text starts with (and the last
    ends at).  A word's name takes in its bytes eight at a time."""
    text = b"\n".join([b"", *texts, b"        "])
    data = np.frombuffer(text, np.uint8)
    space = (data == 32) | (data - np.uint8(9) < 5)  # unsigned: below 9 wraps
    edges = np.flatnonzero(space[1:] != space[:-1]) + 1
    start, length = edges[::2], edges[1::2] - edges[::2]
    eight = np.ndarray(len(text) - 7, "<u8", text, strides=1)  # the 8 bytes from each place on
    names = mix((eight[start] & _LOW[np.minimum(length, 8)]) * _BASE[0] + length.astype(np.uint64) * _BASE[1])
    more, k = np.flatnonzero((length > 8) & (length <= LONG_WORD)), 8
    while len(more):
        rest = length[more] - k
        names[more] = mix(names[more] * _BASE[1] + (eight[start[more] + k] & _LOW[np.minimum(rest, 8)]) * _BASE[0])
        more, k = more[rest > 8], k + 8
    for i in np.flatnonzero(length > LONG_WORD):
        names[i] = xxhash.xxh64_intdigest(text[start[i]:start[i] + length[i]])
    at = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return names, np.searchsorted(start, at)


def merged(sym: np.ndarray, beg: np.ndarray, first: np.ndarray, name: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sequence with only the symbols ``first`` (named ``name``), and each old symbol's new place."""
    place = np.append(np.cumsum(first) - 1, int(first.sum()))
    return name[first], beg[first], place


def anchors(names: np.ndarray, at: np.ndarray, windows: np.ndarray, window: int) -> np.ndarray:
    """The anchor's first word for each window (given by its first word)."""
    sym, beg = names, np.arange(len(names))
    ends = np.zeros(len(names) + 1, bool)
    ends[at] = True  # a document starts at this word
    lo, hi = windows.copy(), windows + window
    anchor = windows.copy()
    for number in range(ROUNDS):
        if number == 0:  # runs
            first = np.ones(len(sym), bool)
            first[1:] = (sym[1:] != sym[:-1]) | ends[beg[1:]]
            starts = np.flatnonzero(first)
            length = np.diff(np.append(starts, len(sym))).astype(np.uint64)
            name = sym.copy()
            name[starts] = np.where(length > 1, mix(sym[starts] + length * _BASE[1]), sym[starts])
            sym, beg, place = merged(sym, beg, first, name)
            # A run at a border may go on outside.
            lo, hi = place[lo] + 1, place[hi - 1]
        # pairs
        left = (mix(sym + np.uint64(number + 1)) & np.uint64(1)) == 0
        joins = np.zeros(len(sym), bool)
        joins[:-1] = left[:-1] & ~left[1:] & ~ends[beg[1:]]
        name = sym.copy()
        i = np.flatnonzero(joins)
        name[i] = mix(sym[i] * _BASE[0] + mix(sym[i + 1]))
        first = np.ones(len(sym), bool)
        first[i + 1] = False
        # A right symbol at the left border, or a left one at the right border, may join one outside.
        some = lo < hi
        safe_lo, safe_hi = np.where(some, lo, 0), np.where(some, hi, 1)
        lo, hi = lo + ~left[safe_lo], hi - left[safe_hi - 1]
        sym, beg, place = merged(sym, beg, first, name)
        some &= lo < hi
        lo, hi = np.where(some, place[np.where(some, lo, 0)], 1), np.where(some, place[np.where(some, hi, 0)], 0)
        anchor[some] = beg[lo[some]]
        if not some.any():
            break
    return anchor


def chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield start, texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield start, texts[start:]


def blocks(texts: list[bytes], window: int) -> dict[str, np.ndarray]:
    """Blocks of neighbouring windows with one anchor: the anchor's name, the
    block's, its document (by number), first window and number of windows."""
    names, at = named(texts)
    doc = np.repeat(np.arange(len(texts)), np.maximum(np.diff(at) - window + 1, 0))
    many = np.bincount(doc, minlength=len(texts))
    windows = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many) + at[doc]
    if not len(windows):
        return {}
    p = anchors(names, at, windows, window)
    # The shared words: after the anchor, about it or before it, whichever lies in the window.
    m = 3 * window // 5
    kind = np.where(p - windows <= window - m, 0, np.where(p - windows < m, 1, 2))
    start = p - np.array([0, 2 * m // 3, m])[kind]
    new = np.ones(len(windows), bool)
    new[1:] = (p[1:] != p[:-1]) | (kind[1:] != kind[:-1]) | (doc[1:] != doc[:-1])
    i = np.flatnonzero(new)
    n = np.diff(np.append(i, len(windows)))
    span = Digest(names)
    first = windows[i]
    shape = ((p[i] - first) * 64 + n).astype(np.uint64)
    return {"key": mix(span.of(start[i], start[i] + m) + kind[i].astype(np.uint64)).view(np.int64),
            "block": mix(span.of(first, first + n + window - 1) + shape * _BASE[1]).view(np.int64),
            "doc": doc[i], "start": first - at[doc[i]], "n": n}


def split(text: bytes | None) -> list[bytes]:
    return (text or b"").split()


# Texts without an id sort last.
LAST_ID = (1 << 63) - 1


def whole_texts(documents: DataFrame) -> DataFrame:
    """(doc_id, text, twin, id): ``id`` is the id itself; ``doc_id`` (null last) and ``twin`` name a text."""
    return with_twin(documents.select(F.col("doc_id").cast("long").alias("id"), "text"), "substring-twins", id_col="id").select(
        F.coalesce("id", F.lit(LAST_ID)).alias("doc_id"), F.col("text").cast("binary").alias("text"), F.col("_twin").alias("twin"), "id")


def block_rows(texts: DataFrame, window: int, only_keys: bool) -> DataFrame:
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, twins, out = batch.column(0).to_numpy(zero_copy_only=False), batch.column(2).to_numpy(zero_copy_only=False), []
        for start, part in chunks([t.as_py() or b"" for t in batch.column(1)]):
            if found := blocks(part, window):
                doc = start + found.pop("doc")
                found |= {"doc_id": ids[doc], "twin": twins[doc]}
                out.append(found)
        cols = ["key"] if only_keys else ["key", "block", "doc_id", "twin", "start", "n"]
        return pa.record_batch({c: pa.array(np.concatenate([x[c] for x in out]).astype(np.int32 if c in ("start", "n") else np.int64))
                                for c in cols}) if out else None
    schema = "key long" if only_keys else "key long, block long, doc_id long, twin long, start int, n int"
    return map_rows(texts.select("doc_id", "text", "twin"), run, schema)


def window_rows(texts: DataFrame, window: int) -> DataFrame:
    """(d0, d1, doc_id, twin, start): digests of the windows in each text's ``spans``."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        ids, twins, out = batch.column(0).to_pylist(), batch.column(2).to_pylist(), []
        texts = [t.as_py() or b"" for t in batch.column(1)]
        spans = batch.column(3).to_pylist()
        for first, part in chunks(texts):
            names, at = named(part)
            both = [Digest(names, k) for k in (0, 1)]
            for j in range(len(part)):
                w = np.concatenate([np.arange(s["start"], s["start"] + s["n"]) for s in spans[first + j]])
                w = w[w + window <= at[j + 1] - at[j]] + at[j]
                out.append([d.of(w, w + window).view(np.int64) for d in both]
                           + [np.full(len(w), ids[first + j]), np.full(len(w), twins[first + j]), (w - at[j]).astype(np.int32)])
        cols = [np.concatenate(c) for c in zip(*out)]
        return pa.record_batch([pa.array(c) for c in cols], names=["d0", "d1", "doc_id", "twin", "start"]) if out else None
    return map_rows(texts.select("doc_id", "text", "twin", "spans"), run, "d0 long, d1 long, doc_id long, twin long, start int")


def repeated_windows(texts: DataFrame, window: int = 20) -> DataFrame:
    """(doc_id, twin, start, n): n consecutive windows from word ``start`` on that
    each also start earlier (an earlier document, or the same one further on);
    ``texts`` are ``whole_texts``."""
    shared = (block_rows(texts, window, True).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
              .filter("n > 1").select("key"))
    shared = staged(shared, "substring-shared")
    seen = staged(block_rows(texts, window, False).join(shared, "key", "left_semi"), "substring-anchors")
    here = F.struct("doc_id", "twin", "start", "n")
    first = staged(seen.groupBy("key", "block").agg(F.min(here).alias("first")), "substring-blocks")
    later = (seen.join(first, ["key", "block"]).filter(F.struct("doc_id", "twin", "start") > F.struct("first.doc_id", "first.twin", "first.start"))
             .select("doc_id", "twin", "start", "n"))

    several = staged(first.groupBy("key").agg(F.count(F.lit(1)).alias("blocks")).filter("blocks > 1").select("key"), "substring-several")
    spans = (first.join(several, "key", "left_semi").select("first.doc_id", "first.twin", F.struct("first.start", "first.n").alias("span"))
             .groupBy("doc_id", "twin").agg(F.collect_set("span").alias("spans")))
    found = staged(window_rows(texts.join(spans, ["doc_id", "twin"]), window)
                   .distinct(), "substring-windows")
    least = staged(found.groupBy("d0", "d1").agg(F.min(F.struct("doc_id", "twin", "start")).alias("first"), F.count(F.lit(1)).alias("n"))
                   .filter("n > 1").drop("n"), "substring-first")
    single = (found.join(least, ["d0", "d1"]).filter(F.struct("doc_id", "twin", "start") > F.col("first"))
              .select("doc_id", "twin", "start", F.lit(1).alias("n")))
    return later.unionByName(single)


def remove_repeats(documents: DataFrame, *, window: int = 20) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_text): each document without the words
    that repeated windows of ``window`` words cover; kept words are joined by
    one space.

    Windows are judged on the input.  Null and empty texts have no words, and
    texts shorter than a window lose none.  Different texts of one id are
    documents of their own, and so are texts without an id, which come last.
    Equal rows are one document, so they are no repeats of each other and give
    equal rows.  Other columns are never read; an empty table gives no rows.
    """
    if window < 8:
        raise ValueError("a window has 8 words at least")
    texts = whole_texts(documents)
    spans = (repeated_windows(texts, window).groupBy("doc_id", "twin")
             .agg(F.collect_list(F.struct("start", "n")).alias("spans")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for doc, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            words = split(text.as_py())
            gone = 0
            kept = words
            if spans.is_valid and words:
                s = spans.values
                start = s.field(0).to_numpy()
                change = (np.bincount(start, minlength=len(words) + 1)
                          - np.bincount(np.minimum(start + s.field(1).to_numpy() + window - 1, len(words)), minlength=len(words) + 1))
                covered = np.cumsum(change)[:len(words)] > 0
                gone = int(covered.sum())
                kept = [w for w, c in zip(words, covered.tolist()) if not c]
            rows.append((doc, len(words), gone, b" ".join(kept).decode()))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                               names=["doc_id", "n_words", "n_removed", "kept_text"])

    texts = texts.join(spans, ["doc_id", "twin"], "left").select("id", "text", "spans")
    return map_rows(texts, run, "doc_id long, n_words long, n_removed long, kept_text string")
