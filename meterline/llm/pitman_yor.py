"""LM scoring with a hierarchical Pitman-Yor model of bigrams.

Two levels of Chinese restaurants.  A token's context is the token before it
(the end of a text before its first): every token that precedes another is a
restaurant whose dishes are the tokens that followed, and all share one parent,
the root restaurant, over a uniform base.  Seating is sampled by Gibbs: a sweep
draws every dish's table count from its law given the parent's probabilities
and the table totals of the last sweep, and a new table sends a customer to the
parent.  Sweeps are bulk-synchronous; a pair seen once has one table and takes
no part.  Scores use the predictive probabilities averaged over the sweeps
after the burn-in.

Counts cover all training text.  Words go by 64-bit names, the most frequent by
short numbers, whose tables (of fixed size) every task holds.  Pairs lie in
buckets by a hash of both words, packed: any pair is whole in one, a frequent
word in none.  Pairs of two short numbers are seated bucket by bucket, all others
by joins with their words and contexts.  The most frequent pairs go to every task
as a cache; other tokens are sent to the bucket of their pair.
"""

from __future__ import annotations

import functools
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from meterline.llm.common import SLICE_ROWS, staged, text_bytes
from meterline.llm.substring import CHUNK, mix, named
from meterline.session import scratch_path

END = np.uint64(0)  # the name of the end of a text

# Tokens a task holds before it counts them or their pairs and sends them on.
FLUSH = 1_000_000


def tokens(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Names of all words, A-Z lower-cased, each text with an end; and where
    each text starts (and the last ends)."""
    names, at = named([(t or b"").lower() for t in texts])
    return np.insert(names, at[1:], END), at + np.arange(len(at))


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about ``CHUNK`` bytes of text at a time."""
    for batch in batches:
        size = np.cumsum(pa.compute.fill_null(pa.compute.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(size, (size[start - 1] if start else 0) + CHUNK)) + 1
            end = min(end, start + SLICE_ROWS, batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def pair_key(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix(mix(ctx + np.uint64(1)) + word)


def signed(x: np.ndarray) -> pa.Array:
    return pa.array(np.ascontiguousarray(x).view(np.int64))


def held_out(doc_id: Column, modulus: int = 7, remainder: int = 2) -> Column:
    return F.crc32(doc_id.cast("string")) % modulus == remainder


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """The tokens of whole texts, about ``FLUSH`` at a time."""
    parts, size = [], 0
    for batch in chunks(batches):
        parts.append(tokens(batch.column(1).to_pylist())[0])
        size += len(parts[-1])
        if size > FLUSH:
            yield np.concatenate(parts)
            parts, size = [], 0
    if parts:
        yield np.concatenate(parts)
    # What Arrow freed goes back to the system, as the worker lives on for other stages.
    pa.default_memory_pool().release_unused()


def word_table(train: DataFrame) -> DataFrame:
    """(name, n): how often each token occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for names in gathered(batches):
            name, n = np.unique(names, return_counts=True)
            yield pa.record_batch({"name": signed(name), "n": pa.array(n.astype(np.int64))})

    return train.mapInArrow(run, "name long, n long").groupBy("name").agg(F.sum("n").alias("n"))


class Lookup:
    """Where 64-bit keys are in ``keys``, by open addressing."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys

    def __getstate__(self) -> dict:
        return {"keys": self.keys}

    def start(self, keys: np.ndarray) -> np.ndarray:
        return (mix(keys) & np.uint64(len(self.slots) - 1)).astype(np.int64)

    @functools.cached_property
    def slots(self) -> np.ndarray:
        self.slots = slots = np.full(2 << len(self.keys).bit_length(), -1, np.int32)
        left, at = np.arange(len(self.keys), dtype=np.int32), self.start(self.keys)
        while len(left):
            free = slots[at] < 0
            slots[at[free]] = left[free]
            more = slots[at] != left
            left, at = left[more], (at[more] + 1) & (len(slots) - 1)
        return slots

    def find(self, asked: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for one that is not there."""
        slots = self.slots
        at = self.start(asked)
        place = slots[at].astype(np.int64)
        open_ = np.flatnonzero(place >= 0)
        while len(open_ := open_[self.keys[place[open_]] != asked[open_]]):
            at[open_] = (at[open_] + 1) & (len(slots) - 1)
            place[open_] = slots[at[open_]]
            open_ = open_[place[open_] >= 0]
        return place

    def ids(self, names: np.ndarray) -> np.ndarray:
        """Short numbers for the words in ``keys``, the name itself (as a signed
        number that is no short one) for all others."""
        own, place = names.view(np.int64), self.find(names)
        return np.where(place >= 0, place, np.where((own >= 0) & (own < SHORT), own + SHORT, own))


SHORT = 1 << 40


def pack(*columns: np.ndarray) -> bytes:
    """64-bit columns, the first by differences, byte plane by byte plane, compressed."""
    cols = np.stack([np.diff(columns[0], prepend=np.int64(0)), *columns[1:]])
    planes = cols.view(np.uint8).reshape(len(cols), -1, 8).transpose(0, 2, 1).tobytes()
    return len(planes).to_bytes(8, "little") + pa.compress(planes, codec="zstd", asbytes=True)


def unpack(blobs: list[bytes], n: int) -> list[np.ndarray]:
    """The ``n`` columns of several packed tables, one after the other."""
    out = [[np.zeros(0, np.int64)] for _ in range(n)]
    for blob in blobs:
        planes = pa.decompress(blob[8:], int.from_bytes(blob[:8], "little"), codec="zstd", asbytes=True)
        cols = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(n, 8, -1).transpose(0, 2, 1)).view(np.int64)[:, :, 0]
        for k, x in enumerate(cols):
            out[k].append(np.cumsum(x) if k == 0 else x)
    return [np.concatenate(x) for x in out]


def hashed(ctx: np.ndarray, word: np.ndarray) -> np.ndarray:
    return pair_key(ctx.view(np.uint64), word.view(np.uint64))


def short(ctx: np.ndarray, word: np.ndarray, head: int) -> np.ndarray:
    """Pairs of two words with short numbers."""
    return (ctx >= 0) & (ctx < head) & (word >= 0) & (word < head)


def deal(ctx: np.ndarray, word: np.ndarray, *more: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """Packed rows by the bucket of their pair: any pair, but no word, is whole in one."""
    bucket = (hashed(ctx, word) % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for k in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[k]:cuts[k + 1]]
        yield k, pack(ctx[own], word[own], *(x[own] for x in more))


def in_order(ctx: np.ndarray, word: np.ndarray, *more: np.ndarray, head: int) -> Iterator[list[np.ndarray]]:
    """The pairs of two short numbers, then the others, each sorted."""
    inside = short(ctx, word, head)
    for own in (np.flatnonzero(inside), np.flatnonzero(~inside)):
        u, w = ctx[own], word[own]
        order = np.argsort(u * head + w) if inside[own].any() else np.lexsort((w, u))
        yield [u[order], w[order], *(x[own][order] for x in more)]


def summed(ctx: np.ndarray, word: np.ndarray, c: np.ndarray, head: int) -> Iterator[list[np.ndarray]]:
    """Each pair once, as ``in_order`` has them."""
    for u, w, k in in_order(ctx, word, c, head=head):
        at = np.flatnonzero(np.concatenate((np.ones(min(1, len(u)), bool), (u[1:] != u[:-1]) | (w[1:] != w[:-1]))))
        yield [u[at], w[at], np.add.reduceat(k, at) if len(at) else k]


# Bytes of training and other text to a bucket of pairs: what a task holds.
BUCKET = 12_000_000

# What a packed table holds.  Pairs of two short numbers: those seen once (ctx,
# word) and the others (ctx, word, c, t, kept).  All other pairs: counts (ctx,
# word, c) and for those seen again (ctx, word, c, kept).  Tokens to look up:
# (ctx, word, row).
ONCE, STATE, TAIL, TAIL_KEPT, ASKED = range(5)


def pair_table(train: DataFrame, known: Broadcast, buckets: int) -> DataFrame:
    """(bucket, kind, n, ones, twos, blob): how often each token follows each
    other, packed; and how many pairs there are, and once and twice."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = known.value
        end = lookup.ids(np.array([END]))
        for names in gathered(batches):
            word = lookup.ids(names)
            for pairs in summed(np.concatenate((end, word[:-1])), word, np.ones(len(word), np.int64), len(lookup.keys)):
                for bucket, blob in deal(*pairs, buckets=buckets):
                    yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "blob": pa.array([blob], pa.binary())})

    def merge(group: pa.Table) -> pa.Table:
        out = []
        inside, outside = summed(*unpack(group["blob"].to_pylist(), 3), len(known.value.keys))
        for kind, (u, w, c) in ((ONCE, [x[inside[2] == 1] for x in inside]), (STATE, [x[inside[2] > 1] for x in inside]), (TAIL, outside)):
            more = {ONCE: (), STATE: (c, np.ones_like(c), np.zeros_like(c)), TAIL: (c,)}[kind]
            if len(u):
                out.append((group["bucket"][0].as_py(), kind, len(u), int((c == 1).sum()), int((c == 2).sum()), pack(u, w, *more)))
        return pa.table([pa.array(x, t) for x, t in zip(zip(*out), (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
                        names=["bucket", "kind", "n", "ones", "twos", "blob"])

    return train.mapInArrow(count, "bucket int, blob binary").groupBy("bucket").applyInArrow(
        merge, "bucket int, kind int, n long, ones long, twos long, blob binary")


class Tally:
    """Sums by token, those of short numbers over a whole task."""

    def __init__(self, head: int, columns: int):
        self.dense, self.rest = np.zeros((columns, head), np.int64), []

    def add(self, column: int, ids: np.ndarray, weights: np.ndarray) -> None:
        inside = (ids >= 0) & (ids < self.dense.shape[1])
        if inside.any():
            self.dense[column] += np.bincount(ids[inside], weights[inside], self.dense.shape[1]).astype(np.int64)
        if not inside.all():
            values = np.zeros((len(self.dense), int((~inside).sum())), np.int64)
            values[column] = weights[~inside]
            self.rest.append(self.batch(ids[~inside], values))

    def batch(self, ids: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(ids), *(pa.array(x) for x in values)], names=["id", *(f"s{k}" for k in range(len(values)))])

    def others(self) -> Iterator[pa.RecordBatch]:
        out, self.rest = self.rest, []
        yield from out

    def end(self) -> Iterator[pa.RecordBatch]:
        ids = np.flatnonzero(self.dense.any(axis=0))
        for own in np.array_split(ids, len(ids) // 100_000 + 1):
            yield self.batch(own, self.dense[:, own])


def pair_stats(pairs: DataFrame, head: int) -> DataFrame:
    """(id, at_root, of, once, once_ctx): different pairs with each token as word
    and as context, and those seen once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(head, 4)
        for batch in batches:
            for kind, blob in zip(batch["kind"].to_pylist(), batch["blob"]):
                u, w, *c = unpack([blob.as_py()], {ONCE: 2, STATE: 5, TAIL: 3}[kind])
                once = {ONCE: np.ones, STATE: np.zeros}[kind](len(u), np.int64) if kind != TAIL else (c[0] == 1).astype(np.int64)
                for k, (ids, n) in enumerate(((w, np.ones_like(u)), (u, np.ones_like(u)), (w, once), (u, once))):
                    tally.add(k, ids, n)
                yield from tally.others()
        yield from tally.end()

    sums = pairs.select("kind", "blob").mapInArrow(run, "id long, s0 long, s1 long, s2 long, s3 long").groupBy("id")
    return sums.agg(*(F.sum(f"s{k}").alias(x) for k, x in enumerate(("at_root", "of", "once", "once_ctx"))))


def table_sums(state: DataFrame, tail: DataFrame, head: int) -> DataFrame:
    """(id, as_word, as_ctx): tables of all pairs seen again, by word and by context."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = Tally(head, 2)
        for batch in batches:
            for blob in batch["blob"]:
                u, w, _, t, _ = unpack([blob.as_py()], 5)
                tally.add(0, w, t)
                tally.add(1, u, t)
        yield from tally.end()

    zero = F.lit(0).cast("long")
    return (state.select("blob").mapInArrow(run, "id long, s0 long, s1 long")
            .unionAll(tail.select("word", "t", zero)).unionAll(tail.select("ctx", zero, "t"))
            .groupBy("id").agg(F.sum("s0").alias("as_word"), F.sum("s1").alias("as_ctx")))


def seat(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish after its customers sat down one by one.  With i
    seated at t tables the next opens a table with probability
    strength / (i - discount * t + strength); how many join the old tables
    before that is beta-geometric, so a dish costs a draw per table."""
    tables, seated = np.ones(len(customers), np.int64), np.ones(len(customers))
    open_ = np.flatnonzero(customers > 1)
    while len(open_):
        q = rng.beta(strength[open_], seated[open_] - discount * tables[open_])
        q = np.clip(q, 1e-15, 1 - 1e-15)
        seated[open_] += np.ceil(np.log(1 - rng.random(len(open_))) / np.log1p(-q)).clip(1)
        open_ = open_[seated[open_] <= customers[open_]]
        tables[open_] += 1
    return tables


# Up to so many customers the law of the table count is held as it is.
EXACT = 1024


@functools.lru_cache(2)
def table_law(discount: float) -> np.ndarray:
    """[c, t]: log probability of t tables after c customers at strength 0,
    which is discount^(t-1) (t-1)! S(c, t) / (c-1)! with the generalised
    Stirling number S."""
    with np.errstate(divide="ignore"):
        law, t = np.full((EXACT + 1, EXACT + 1), -np.inf), np.arange(EXACT + 1)
        law[1, 1] = 0
        for n in range(1, EXACT):
            law[n + 1, 1:] = np.logaddexp(law[n, :-1] + np.log(discount * t[:-1] / n),
                                          law[n, 1:] + np.log(np.maximum(1 - discount * t[1:] / n, 0)))
    return law


def draw_tables(customers: np.ndarray, strength: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables of each dish given all other dishes: t has the weight
    strength^t * S(customers, t).  Above ``EXACT`` customers the law of EXACT
    customers is taken with t scaled by (customers / EXACT)^discount, its
    limit form; what strength does to t is as it is at any count."""
    out, law = np.ones(len(customers), np.int64), table_law(discount)
    mean = strength / discount
    # Beyond this the weights are nothing: t - 1 is near to Poisson(mean) at most.
    most = np.minimum(customers, np.ceil(30 + 2 * mean + 10 * np.sqrt(mean)))
    width = np.exp2(np.ceil(np.log2(np.maximum(most, 1)))).astype(np.int64)
    log_mean = np.log(np.maximum(mean, 1e-300))
    for w in np.unique(width[customers > 1]).tolist():
        t = np.arange(1, w + 1)
        factorial = np.concatenate(([0.0], np.cumsum(np.log(t[:-1]))))
        of = np.flatnonzero((width == w) & (customers > 1))
        for own in np.array_split(of, -(-len(of) * w // 2_000_000)):
            c = customers[own]
            if w <= EXACT:
                weight = law[np.minimum(c, EXACT), 1:w + 1]
            else:
                weight = np.empty((len(own), w))
            for i in np.flatnonzero(c > EXACT):
                x = 1 + (t - 1) * (EXACT / c[i]) ** discount
                weight[i] = np.interp(x, np.arange(1, EXACT + 1), law[EXACT, 1:], right=-np.inf)
            weight = weight + log_mean[own][:, None] * t - factorial
            share = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
            out[own] = 1 + (share < (rng.random(len(own)) * share[:, -1])[:, None]).sum(axis=1)
    return out


class Restaurants:
    """What all dishes share: discounts, strength and totals.  ``c`` and ``t``
    are customers and tables of each context, ``t0`` tables of the root."""

    def __init__(self, discount: float, root_discount: float, strength: float, words: int, c: np.ndarray, t: np.ndarray, t0: int):
        self.d, self.d0, self.theta, self.words, self.c, self.t, self.t0 = discount, root_discount, strength, words, c, t, t0

    def root(self, customers: np.ndarray, tables: np.ndarray) -> np.ndarray:
        """The root's probability of a word with so many customers and tables there."""
        new = (self.theta + self.d0 * self.t0) / (self.words + 1)
        return (customers - self.d0 * tables + new) / (self.theta + self.t.sum())

    def new_table(self) -> np.ndarray:
        return self.theta + self.d * self.t

    def draw(self, c: np.ndarray, t: np.ndarray, at_root: np.ndarray, t0: np.ndarray, of: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """New tables of pairs, given the tables of their words and contexts."""
        # A dish's own tables are not there while it is seated.
        parent = np.maximum(self.root(at_root - t, np.minimum(t0, at_root - t)), 1e-300)
        return draw_tables(c, (self.theta + self.d * (of - t)) * parent, self.d, rng)

    def seat_pairs(self, state: DataFrame, words: Broadcast, number: int, keep: bool, path: str) -> DataFrame:
        """Draw the tables of every pair of two short numbers anew; ``kept`` sums them over kept sweeps."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at_root, t0, of = words.value
            for batch in batches:
                for bucket, blob in zip(batch["bucket"].to_pylist(), batch["blob"]):
                    u, w, c, t, kept = unpack([blob.as_py()], 5)
                    t = self.draw(c, t, at_root[w].astype(np.int64), t0[w].astype(np.int64), of[u].astype(np.int64),
                                  np.random.default_rng([number, bucket]))
                    yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "t": pa.array([int(t.sum())]),
                                           "blob": pa.array([pack(u, w, c, t, kept + t if keep else kept)], pa.binary())})
        return staged(state.select("bucket", "blob").mapInArrow(run, "bucket int, t long, blob binary"), f"lm-pairs-{number}", path=path)

    def seat_tail(self, tail: DataFrame, words: DataFrame, number: int, keep: bool, path: str) -> DataFrame:
        """The same for the other pairs, which find their words and contexts by joins."""
        joined = (tail.join(words.select(F.col("id").alias("word"), "at_root", "t0"), "word")
                  .join(words.select(F.col("id").alias("ctx"), "of"), "ctx"))

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            c, t, kept, at_root, t0, of = (batch.column(n).to_numpy() for n in ("c", "t", "kept", "at_root", "t0", "of"))
            rng = np.random.default_rng([number, len(c), *(batch.column(n)[0].as_py() & (2**64 - 1) for n in ("ctx", "word"))])
            t = self.draw(c, t, at_root, t0, of, rng)
            return pa.record_batch({"ctx": batch.column("ctx"), "word": batch.column("word"), "c": batch.column("c"),
                                    "t": pa.array(t), "kept": pa.array(kept + t if keep else kept)})
        return staged(joined.mapInArrow(lambda bs: (run(b) for b in bs if b.num_rows),
                                        "ctx long, word long, c long, t long, kept long"), f"lm-tail-{number}", path=path)

    def seat_root(self, words: DataFrame, sums: DataFrame, number: int, keep: bool, path: str) -> DataFrame:
        """Draw the root's tables anew, with the pairs' new tables as customers;
        ``p0`` sums each word's own part of the root's probability over kept
        sweeps and ``of_kept`` each context's tables."""
        joined = words.join(sums, "id", "left").withColumns({
            "at_root": F.col("once") + F.coalesce("as_word", F.lit(0)), "of": F.col("once_ctx") + F.coalesce("as_ctx", F.lit(0))}).select(*words.columns)

        def run(batch: pa.RecordBatch) -> pa.RecordBatch:
            at_root, of, t0, p0, of_kept = (batch.column(n).to_numpy() for n in ("at_root", "of", "t0", "p0", "of_kept"))
            rng = np.random.default_rng([number, len(t0), batch.column("id")[0].as_py() & (2**64 - 1)])
            t0 = draw_tables(at_root, (self.theta + self.d0 * (self.t0 - t0)) / (self.words + 1), self.d0, rng)
            if keep:
                p0, of_kept = p0 + (at_root - self.d0 * t0) / (self.theta + self.t.sum()), of_kept + of
            new = {"t0": t0, "p0": p0, "of_kept": of_kept}
            return pa.record_batch({n: pa.array(new[n]) if n in new else batch.column(n) for n in batch.schema.names})
        return staged(joined.mapInArrow(lambda bs: (run(b) for b in bs if b.num_rows), words.schema), f"lm-words-{number}", path=path)


def least_level(sizes: Iterable[tuple[int, int]], most: int) -> int:
    """From which level on there are at most ``most`` rows: ``sizes`` has how many each level has."""
    least = 2**31
    for level, n in sorted(sizes, reverse=True):
        most -= n
        if most < 0:
            break
        least = level
    return least


def most_frequent(table: DataFrame, column: str, most: int) -> DataFrame:
    """The rows above some count, at most ``most``."""
    level = F.floor(F.log2(column) * 8)
    sizes = table.groupBy(level.alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    return table.filter(level >= least_level(((r["level"], r["n"]) for r in sizes), most))


def level_of(c: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(c) * 8).astype(np.int64)


def frequent_pairs(state: DataFrame, most: int, log_prob: Callable[..., np.ndarray], head: int) -> tuple[Lookup, np.ndarray]:
    """The most frequent pairs of two short numbers, and ``p``, their log probabilities."""
    def levels(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["blob"]:
                level, n = np.unique(level_of(unpack([blob.as_py()], 5)[2]), return_counts=True)
                yield pa.record_batch({"level": pa.array(level), "n": pa.array(n.astype(np.int64))})

    sizes = state.select("blob").mapInArrow(levels, "level long, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    least = least_level(((r["level"], r["n"]) for r in sizes), most)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch["blob"]:
                u, w, c, _, kept = (cols := unpack([blob.as_py()], 5))
                u, w, c, kept = (x[level_of(c) >= least] for x in (u, w, c, kept))
                yield pa.record_batch({"key": pa.array(u * head + w), "p": pa.array(log_prob(u, w, c, kept))})

    top = state.select("blob").mapInArrow(rows, "key long, p double").toArrow()
    return Lookup(top["key"].to_numpy().view(np.uint64)), top["p"].to_numpy()


def of_head(table: DataFrame, head: int, **columns: float) -> list[np.ndarray]:
    """Columns of the words with short numbers, as arrays; with defaults."""
    own = table.filter(F.col("id").between(0, head - 1)).select("id", *columns).toArrow()
    out = []
    for name, default in columns.items():
        x = np.full(head, default)
        x[own["id"].to_numpy()] = own[name].to_numpy()
        # As few bytes as hold them.
        out.append(x.astype(np.min_scalar_type(int(x.max()))) if x.dtype.kind == "i" and head else x)
    return out


def discount_of(ones: int, twos: int) -> float:
    return min(0.95, max(0.1, ones / max(1, ones + 2 * twos)))


def score(documents: DataFrame, out: Column, *, head: int = 200_000, burn_in: int = 2, samples: int = 3,
          strength: float = 1.0) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Learns from the rows where ``out`` is not true and scores every row's whole
    text: its words, A-Z lower-cased, and one end.  ``base_score`` is add-one
    unigram smoothing.  An unseen token has the model's probability of a new
    word; after an unseen token the root's probabilities hold.  Null and empty
    texts are the end alone.  Nothing to learn from: both scores are 0 for the
    one (unseen) kind of token.  Repeated rows count as often as they occur and
    give equal rows; other columns are never read.
    """
    rows = documents.withColumn("held_out", F.coalesce(out, F.lit(False)))
    train, spark = text_bytes(rows.filter(~F.col("held_out"))), documents.sparkSession
    names = staged(word_table(train), "lm-names", texts=True)
    size = names.agg(F.count(F.lit(1)).alias("v"), F.sum("n").alias("n"), F.count_if(F.col("n") == 1).alias("a"),
                     F.count_if(F.col("n") == 2).alias("b")).first()
    v, n = size["v"], size["n"] or 0
    # Short numbers for the most frequent words, the most frequent first.
    top = most_frequent(names, "n", 5 * head).toArrow()
    top = top["name"].to_numpy().view(np.uint64)[np.argsort(-top["n"].to_numpy(), kind="stable")]
    known, short_ids = spark.sparkContext.broadcast(Lookup(top)), len(top)
    buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // BUCKET

    pairs = staged(pair_table(train, known, buckets), "lm-pairs", texts=True)
    few = pairs.agg(*(F.coalesce(F.sum(x), F.lit(0)).alias(y) for x, y in (("ones", "a"), ("twos", "b"), ("n", "t")))).first()
    d, d0 = discount_of(few["a"], few["b"]), discount_of(size["a"], size["b"])

    def with_id(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch({"id": pa.array(known.value.ids(batch["name"].to_numpy().view(np.uint64))), "n": batch["n"]})

    names = names.mapInArrow(lambda bs: (with_id(b) for b in bs), "id long, n long")

    # What is seen once has one table; the others start with one and are sampled.
    none, one = F.lit(0).cast("long"), F.lit(1).cast("long")
    words = staged(names.filter("n > 1").join(pair_stats(pairs, short_ids), "id").select(
        "*", one.alias("t0"), F.lit(0.0).alias("p0"), none.alias("of_kept")), "lm-words")
    state = pairs.filter(F.col("kind") == STATE).select("bucket", F.col("n").alias("t"), "blob")

    def again(batch: pa.RecordBatch) -> pa.RecordBatch:
        u, w, c = (x for x in unpack(batch["blob"].to_pylist(), 3))
        own = c > 1
        return pa.record_batch({"ctx": pa.array(u[own]), "word": pa.array(w[own]), "c": pa.array(c[own])})

    tail = pairs.filter(F.col("kind") == TAIL).select("blob").mapInArrow(
        lambda bs: (again(b.slice(k, 1)) for b in bs for k in range(b.num_rows)), "ctx long, word long, c long").select(
        "*", one.alias("t"), none.alias("kept"))
    customers = np.array([n], float)
    here = Restaurants(d, d0, strength, v, customers, np.array([few["t"]], float), v)
    own_once, p_new = 0.0, 0.0
    # A sweep's tables take the place of those of the last but one.
    paths = [[scratch_path(spark, f"llm-lm-{x}") for x in ("words", "pairs", "tail")] for _ in range(2)]
    for number in range(burn_in + samples):
        keep = number >= burn_in
        to_words, to_pairs, to_tail = paths[number % 2]
        now = spark.sparkContext.broadcast(of_head(words, short_ids, at_root=1, t0=1, of=1))
        state = here.seat_pairs(state, now, number, keep, to_pairs)
        tail = here.seat_tail(tail, words, number, keep, to_tail)
        now.destroy()
        t = few["a"] + sum(x.agg(F.sum("t").alias("t")).first()["t"] or 0 for x in (state, tail))
        here = Restaurants(d, d0, strength, v, customers, np.array([t], float), here.t0)
        words = here.seat_root(words, table_sums(state, tail, short_ids), number, keep, to_words)
        t0 = size["a"] + (words.agg(F.sum("t0").alias("t")).first()["t"] or 0)
        here = Restaurants(d, d0, strength, v, customers, here.t, t0)
        if keep:
            own_once += (1 - d0) / (strength + t) / samples
            p_new += float(here.root(np.array([0]), np.array([0]))[0]) / samples

    # The predictive probability is kept / total + back * p0.  A token precedes
    # another as often as it occurs, so n counts it as a context, too.
    tables = F.col("of_kept") / samples
    model = words.select("id", "n", (F.col("p0") / samples + p_new).alias("p0"),
                         ((strength + d * tables) / (strength + F.col("n"))).alias("back")).unionByName(
        names.filter("n = 1").select("id", "n", F.lit(own_once + p_new).alias("p0"), F.lit((strength + d) / (strength + 1)).alias("back")))
    smooth = float(n + v + 1)
    heads = spark.sparkContext.broadcast(of_head(model, short_ids, n=1, p0=0.0, back=1.0))

    def kept_of(c: np.ndarray, kept: np.ndarray) -> np.ndarray:
        return c - kept * d / samples

    def log_prob(u: np.ndarray, w: np.ndarray, kept: np.ndarray) -> np.ndarray:
        many, p0, back = heads.value
        return np.log10(kept / (strength + many[u].astype(float)) + back[u] * p0[w])

    def log_base(w: np.ndarray) -> np.ndarray:
        return np.log10((heads.value[0][w].astype(float) + 1) / smooth)

    cache = spark.sparkContext.broadcast(frequent_pairs(state, 5 * head, lambda u, w, c, kept: log_prob(u, w, kept_of(c, kept)), short_ids))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Scores of the tokens in the cache by row, and the others packed by the bucket of their pair."""
        lookup, (pairs, log_p) = known.value, cache.value
        end, row = lookup.ids(np.array([END])), TaskContext.get().partitionId() << 33
        waiting, many = [], 0

        def rest() -> Iterator[pa.RecordBatch]:
            for part in in_order(*(np.concatenate(x) for x in zip(*waiting)), head=short_ids):
                for bucket, blob in deal(*part, buckets=buckets):
                    yield pa.record_batch([pa.nulls(1, f.type) for f in scores] + [pa.array([bucket], pa.int32()), pa.array([blob], pa.binary())],
                                          names=[*scores.names, "bucket", "blob"])

        for batch in chunks(batches):
            names, at = tokens(batch.column(1).to_pylist())
            w = lookup.ids(names)
            u = np.concatenate((end, w[:-1]))
            inside = np.flatnonzero(short(u, w, short_ids))
            place = pairs.find((u[inside] * short_ids + w[inside]).view(np.uint64))
            hit = inside[place >= 0]
            found, score, base = np.zeros(len(w), np.int64), np.zeros(len(w)), np.zeros(len(w))
            found[hit], score[hit], base[hit] = 1, log_p[place[place >= 0]], log_base(w[hit])
            # Each row of the input has a number of its own, as doc_id may repeat.
            # Every text has a token: its end.
            of = row + np.arange(batch.num_rows)
            row += batch.num_rows
            values = (of, batch.column(0), batch.column(2), np.diff(at), *(np.add.reduceat(x, at[:-1]) for x in (found, score, base)))
            yield pa.record_batch([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(values, scores)]
                                  + [pa.nulls(batch.num_rows, pa.int32()), pa.nulls(batch.num_rows, pa.binary())],
                                  names=[*scores.names, "bucket", "blob"])
            more = found == 0
            waiting.append((u[more], w[more], np.repeat(of, np.diff(at))[more]))
            many += len(waiting[-1][0])
            if many > FLUSH // 2:
                yield from rest()
                waiting, many = [], 0
        if waiting:
            yield from rest()
        # What Arrow freed goes back to the system, as the worker lives on for other stages.
        pa.default_memory_pool().release_unused()

    scores = pa.schema([("row", pa.int64()), ("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                        ("n_head", pa.int64()), ("head_score", pa.float64()), ("head_base", pa.float64())])
    seen = staged(text_bytes(rows, "held_out").mapInArrow(
        first, "row long, doc_id long, held_out boolean, n_tokens long, n_head long, head_score double, head_base double, "
        "bucket int, blob binary"), "lm-head-scores", texts=True)
    cache.destroy()

    def pack_tail(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for bucket, blob in deal(*(batch[x].to_numpy() for x in ("ctx", "word", "c", "kept")), buckets=buckets):
            yield pa.record_batch({"bucket": pa.array([bucket], pa.int32()), "kind": pa.array([TAIL_KEPT], pa.int32()), "blob": pa.array([blob], pa.binary())})

    kind = lambda k: F.lit(k).cast("int").alias("kind")
    dealt = (seen.filter("bucket is not null").select("bucket", kind(ASKED), "blob")
             .unionAll(pairs.filter(F.col("kind").isin(ONCE, TAIL)).select("bucket", "kind", "blob"))
             .unionAll(state.select("bucket", kind(STATE), "blob"))
             .unionAll(tail.mapInArrow(lambda bs: (x for b in bs if b.num_rows for x in pack_tail(b)), "bucket int, kind int, blob binary")))

    def second(group: pa.Table) -> pa.Table:
        """Scores by row of the pairs of two short numbers; the other tokens go on with their pair's part."""
        own = {k: [] for k in (ONCE, STATE, TAIL, TAIL_KEPT, ASKED)}
        for k, blob in zip(group["kind"].to_pylist(), group["blob"].to_pylist()):
            own[k].append(blob)
        keys, values = [], []
        for k, columns in ((ONCE, 2), (STATE, 5), (TAIL, 3), (TAIL_KEPT, 4)) if own[ASKED] else ():
            u, w, *more = unpack(own.pop(k), columns)
            if k == TAIL:  # the others come with their tables
                u, w = u[more[0] == 1], w[more[0] == 1]
            keys.append(hashed(u, w))
            values.append(kept_of(more[0], more[-1]) if k in (STATE, TAIL_KEPT) else np.full(len(u), 1 - d))
        u, w, row = unpack(own[ASKED], 3)
        kept = np.zeros(len(u))
        if len(u):
            place = Lookup(np.concatenate(keys)).find(hashed(u, w))
            kept[place >= 0] = np.concatenate(values)[place[place >= 0]]
        inside = short(u, w, short_ids)
        rows, at, many = np.unique(row[inside], return_inverse=True, return_counts=True)
        score, base = (np.bincount(at, x, len(rows)) for x in (log_prob(u[inside], w[inside], kept[inside]), log_base(w[inside])))
        others = np.flatnonzero(~inside)
        return pa.table([pa.concat_arrays([pa.array(x, t) if x is not None else pa.nulls(len(rows), t),
                                           pa.array(y, t) if y is not None else pa.nulls(len(others), t)])
                         for x, y, t in ((rows, row[others], pa.int64()), (many, None, pa.int64()), (score, None, pa.float64()), (base, None, pa.float64()),
                                         (None, u[others], pa.int64()), (None, w[others], pa.int64()), (None, kept[others], pa.float64()))],
                        names=["row", "known", "score", "base", "ctx", "word", "kept"])

    found = staged(dealt.groupBy("bucket").applyInArrow(
        second, "row long, known long, score double, base double, ctx long, word long, kept double"), "lm-found")
    done = found.filter(F.col("known").isNotNull()).select("row", "score", "base", "known")
    prob = (F.coalesce(F.col("kept") / (strength + F.col("many")), F.lit(0.0))
            + F.coalesce("back", F.lit(1.0)) * F.coalesce("p0", F.lit(p_new)))
    others = (found.filter(F.col("known").isNull()).select("row", "ctx", "word", "kept")
              .join(model.select(F.col("id").alias("word"), "n", "p0"), "word", "left")
              .join(model.select(F.col("id").alias("ctx"), F.col("n").alias("many"), "back"), "ctx", "left")
              .select("row", F.log10(prob).alias("score"), F.log10((F.coalesce("n", F.lit(0)) + 1) / F.lit(smooth)).alias("base"),
                      F.col("n").isNotNull().cast("long").alias("known")))
    rare = done.unionByName(others).groupBy("row").agg(
        F.sum("known").alias("n_rare"), F.sum("score").alias("rare_score"), F.sum("base").alias("rare_base"))
    zero = lambda c, z: F.coalesce(c, F.lit(z))
    return seen.filter("bucket is null").drop("bucket", "blob").join(rare, "row", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_head") + zero("n_rare", 0)).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"), (F.col("head_base") + zero("rare_base", 0.0)).alias("base_score"),
        (F.col("head_score") + zero("rare_score", 0.0)).alias("score"))
