"""Best-fit packing of tokenised documents in bulk-synchronous rounds.

Documents become pieces of at most ``capacity`` tokens.  Pieces and gaps are
ordered by size; sizes are whole numbers up to ``capacity``, so the order is a
counting sort: how many pieces, and which runs of sequences, have each size.
A round sweeps both orders from the largest size down and matches every piece
with its successor, the smallest free gap that holds it; of pieces that want
the same gaps the longer go first, and among equals the rank decides.  A gap
takes one piece a round.  Then the gaps are updated and the next round starts;
what finds no gap opens new sequences, as many as its tokens need at least.
Rounds take the pieces over half the capacity first, then those over a quarter,
and so on, so that short pieces fill what long ones leave.

The sweep works on runs (at most ``capacity`` sizes of pieces), so its state
depends on the capacity and the rounds and not on the number of documents.
Spark does what grows with the data: tokenising, counting, ranking the pieces
within their size (in salted parts with running offsets, so that a size that a
third of all pieces has is not one task), and placing each by its rank.
"""

from __future__ import annotations

import codecs
import os
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from meterline.llm.common import bucket_of, map_rows, staged, text_bytes

CAPACITY = 2048
SALTS = 64

# Letters that have one lower-case letter each and are never composed anew.
LETTER = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]"

# ASCII marks that are cut off a word's end; no apostrophe, which can begin a contraction.
MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")

# Bytes of text handled at once (a longer text is a chunk of its own).  A word
# is looked up once a chunk, so small chunks look up common words over and over.
CHUNK = 2_000_000

# At so many words a worker forgets those that it did not meet again.
WORD_CACHE = 250_000


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers from each ``first`` on, ``size`` of them, one after another."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(first - (ends - size), size)


def cut_marks(words: pa.StringArray) -> tuple[pa.StringArray, pa.StringArray]:
    """The words without the ASCII marks after a last letter, and these marks
    (empty where there are none).  The tokenizer never joins the two, and far
    fewer words are left."""
    start = pc.ascii_rtrim(words, MARKS)
    cut = pc.and_(pc.match_substring_regex(start, LETTER + "$"), pc.invert(pc.match_substring(words, "<|")))
    start = pc.if_else(cut, start, words)
    whole, size = (pc.binary_length(x).to_numpy().astype(np.int64) for x in (words, start))
    _, offsets, data = words.buffers()
    first = np.frombuffer(offsets, np.int32)[words.offset:words.offset + len(words)].astype(np.int64)
    marks = np.frombuffer(data or b"", np.uint8)[spans(first + size, whole - size)]
    ends = np.concatenate(([0], np.cumsum(whole - size))).astype(np.int32)
    return start, pa.StringArray.from_buffers(len(words), pa.py_buffer(ends), pa.py_buffer(marks))


def strings(words: pa.StringArray) -> list[str]:
    return words.to_numpy(zero_copy_only=False).tolist()


class WordTokenizer:
    """Ids of texts as little-endian unsigned 32-bit bytes.  This tokenizer
    lowers case, drops white space and never joins across it, so a text's ids
    are its lower-cased words' ids in order, and a word is encoded once.

    ``known`` are the words so far and ``number`` their places; word i has
    ``size[i]`` of ``all_ids`` from ``first[i]`` on, and ``met[i]`` tells if it
    came again."""

    def __init__(self, path: str):
        self.path, self.model = path, None
        self.forget()

    def forget(self) -> None:
        self.known, self.all_ids, self.met = pa.array([""]), np.empty(0, "<u4"), np.ones(1, bool)
        self.first, self.size = np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.number = {"": 0}

    def keep_met(self) -> None:
        """Forget the words that did not come again; all, if too many did."""
        if self.met.sum() > WORD_CACHE // 2:
            return self.forget()
        self.met[0] = True  # the empty word stays the first
        self.all_ids = self.all_ids[spans(self.first[self.met], self.size[self.met])]
        self.known, self.size = self.known.filter(pa.array(self.met)), self.size[self.met]
        self.first, self.met = np.cumsum(self.size) - self.size, np.zeros(len(self.size), bool)
        self.number = dict(zip(strings(self.known), range(len(self.known))))

    def load(self) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
        from tokenizers import Tokenizer, pre_tokenizers
        self.model = Tokenizer.from_file(self.path)
        self.mark, self.mark_text = next((i, t.content) for i, t in sorted(self.model.get_added_tokens_decoder().items()) if t.special)
        # Ids that end a run of letters, marks or a digit.
        self.ends = np.zeros(self.model.get_vocab_size(), bool)
        self.ends[[i for t, i in self.model.get_vocab().items() if t.endswith("</w>")]] = True
        # How the model spells each byte of letters: ASCII as it is, the others by a letter a byte.
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        letters = [chr(c) for c in range(128, 256) if re.fullmatch(LETTER, chr(c))]
        spelt = {b: s for c in letters for b, s in zip(c.encode(), spell(c)[0][0], strict=True)}
        self.spelling = "".join(chr(b) if b < 128 else spelt.get(b, "\ufffe") for b in range(256))

    def numbers(self, words: pa.StringArray) -> np.ndarray:
        """Where distinct words are among the known, after learning the new."""
        if len(self.known) > WORD_CACHE:
            self.keep_met()
        # A dictionary that lives on: a search in an array would hash all known words each time.
        at = np.fromiter(map(self.number.get, strings(words), repeat(-1)), np.int64, len(words))
        missing = at < 0
        self.met[at[~missing]] = True
        new = words.filter(pa.array(missing))
        if len(new):
            at[missing] = len(self.known) + np.arange(len(new))
            plain = pc.match_substring_regex(new, f"^{LETTER}+$")
            letters, others = new.filter(plain), new.filter(pc.invert(plain))
            order = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")
            found = [self.encode_letters(letters), *self.encode_words(others)]
            size = np.empty(len(new), np.int64)
            size[order] = np.concatenate([s for _, s in found])
            first = np.empty(len(new), np.int64)
            first[order] = np.cumsum(size[order]) - size[order] + len(self.all_ids)
            self.all_ids = np.concatenate([self.all_ids, *(ids for ids, _ in found)])
            self.first, self.size = np.concatenate((self.first, first)), np.concatenate((self.size, size))
            self.number.update(zip(strings(new), at[missing].tolist()))
            self.known = pa.concat_arrays([self.known, new])
            self.met = np.concatenate((self.met, np.zeros(len(new), bool)))
        return at

    def encode_letters(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of ``LETTER``, and how many each has.  Such a word is
        one run, and nothing but its case is normalised: the model's merges
        alone make its ids."""
        if self.model is None:
            self.load()
        lower = "\n".join(strings(words)).lower().encode()
        spelt = codecs.charmap_decode(lower, "strict", self.spelling)[0].split("\n")
        tokenize = self.model.model.tokenize
        ids = np.array([t.id for w in spelt for t in tokenize(w)], "<u4")
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def encode_words(self, words: pa.StringArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of many words in one call.  Between them stands a special
        token, which splits a text before anything else is done with it."""
        for k in range(0, len(words), 1024):
            part = words[k:k + 1024].to_pylist()
            ids = self.encode(self.mark_text.join(part))
            marks = ids == self.mark
            cuts = np.flatnonzero(marks)
            if len(cuts) == len(part) - 1:
                yield ids[~marks], np.diff(cuts, prepend=-1, append=len(ids)) - 1
            else:  # a word that holds the special token itself
                for word in part:
                    ids = self.encode(word)
                    yield ids, np.array([len(ids)])

    def encode(self, text: str) -> np.ndarray:
        return np.array(self.model.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        texts = pa.array(texts, pa.binary()).cast(pa.string())
        # Special tokens are matched before case is lowered.
        docs = pc.ascii_split_whitespace(pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts)))
        words = docs.flatten().dictionary_encode()
        parts = pa.concat_arrays(cut_marks(words.dictionary)).dictionary_encode()
        # Each word as its number without marks and that of its marks; then the texts' words.
        at = self.numbers(parts.dictionary)[parts.indices.to_numpy()].reshape(2, -1).T
        own = self.all_ids[spans(self.first[at.ravel()], self.size[at.ravel()])]
        ends = 4 * np.concatenate(([0], np.cumsum(self.size[at].sum(1))))
        own = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(ends), pa.py_buffer(own)])
        _, ends, ids = own.take(words.indices).buffers()
        ends = np.frombuffer(ends, np.int64)[docs.offsets.to_numpy()].tolist()
        ids = memoryview(ids or b"")
        for start, end in zip(ends[:-1], ends[1:]):
            yield bytes(ids[start:end])


def chunks(texts: list[bytes]) -> Iterator[list[bytes]]:
    """Texts of about ``CHUNK`` bytes at a time."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield texts[start:i]
            start, size = i, 0
        size += len(t)
    if texts:
        yield texts[start:]


_workers: dict[str, WordTokenizer] = {}

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """Every document's ids and a closing id 0, cut after each ``capacity`` tokens."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = _workers.setdefault(path, WordTokenizer(path))
        rows = []
        texts = [t or b"" for t in batch.column(1).to_pylist()]
        each = (ids for part in chunks(texts) for ids in model.ids(part))
        for doc, ids in zip(batch.column(0).to_pylist(), each):
            ids += b"\0\0\0\0"
            for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                rows.append((doc, piece, at // 4, len(part) // 4, zlib.crc32(part)))
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                               names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return map_rows(text_bytes(documents, without_id=True), run, PIECE)


def plan_rounds(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Place ``counts[length]`` pieces of each length: (length, first rank,
    pieces, first sequence, offset) for runs of pieces with consecutive ranks
    that go to consecutive sequences at one offset."""
    left = {n: c for n, c in counts.items() if c}
    placed = dict.fromkeys(left, 0)
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> runs (first sequence, sequences)
    plan, sequences = [], 0

    def put(length: int, first: int, many: int, gap: int, into: dict) -> None:
        plan.append((length, placed[length], many, first, capacity - gap))
        placed[length] += many
        left[length] -= many
        if gap > length:
            into.setdefault(gap - length, []).append((first, many))

    floor = capacity
    while any(left.values()):
        # Longer pieces first: those over half the last bound, until none is left.
        floor //= 2
        band = sorted((n for n in left if n > floor), reverse=True)
        while any(left[n] for n in band):
            # One sweep: successors of the free gaps, every gap used once.
            after: dict[int, list[tuple[int, int]]] = {}
            free: list[tuple[int, int, int]] = []  # smallest gap last
            matched = False
            for size in sorted({*gaps, *band}, reverse=True):
                free += [(size, *run) for run in gaps.pop(size, ())]
                while left.get(size) and free and size > floor:
                    gap, first, many = free.pop()
                    now = min(many, left[size])
                    if now < many:
                        free.append((gap, first + now, many - now))
                    put(size, first, now, gap, after)
                    matched = True
            for gap, first, many in free:
                after.setdefault(gap, []).append((first, many))
            gaps = after
            if not matched:
                # No gap holds any of these: the longest open new sequences.
                need = -(-sum(n * left[n] for n in band) // capacity)
                for size in band:
                    now = left[size] if 2 * size > capacity else min(need, left[size])
                    if now > 0:
                        put(size, sequences, now, capacity, gaps)
                        sequences += now
                        need -= now
    return plan


def pack(documents: DataFrame, *, path: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset), one row
    per piece of a document.

    Null and empty text are the closing id alone.  Only documents longer than
    ``capacity`` are cut.  Repeated rows are packed each on its own (their
    pieces are alike, and so are their rows but for the place), and so are rows
    without an id, which keep the null.  Other columns
    are never read; an empty table gives no rows.
    """
    spark = documents.sparkSession
    found = staged(pieces(documents, path or tokenizer_path(), capacity)
                   .withColumn("salt", bucket_of(SALTS, F.col("doc_id"), F.col("piece"), F.col("ids_crc32"))), "pack-pieces", texts=True)
    parts = found.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    parts = staged(parts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))), "pack-parts")
    # At most ``capacity`` rows come to the driver.
    counts = {r["length"]: r["n"] for r in parts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = spark.createDataFrame(plan_rounds(counts, capacity),
                                 "length long, first long, many long, sequence long, offset long")
    place = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32"))
    ranked = (found.withColumn("place", place).join(F.broadcast(parts.drop("n")), ["length", "salt"])
              .withColumn("rank", F.col("place") - 1 + F.col("base")))
    within = (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("first") + F.col("many"))
    runs = runs.withColumnRenamed("length", "size")
    return (ranked.join(F.broadcast(runs), (F.col("length") == F.col("size")) & within)
            .select("doc_id", "piece", "start", "length", "ids_crc32",
                    (F.col("sequence") + F.col("rank") - F.col("first")).alias("sequence_id"), "offset"))
