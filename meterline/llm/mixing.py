"""Mixing sources to target weights by the cube method.

Every source gets a target share of all words.  A document is taken
``floor(r)`` times for its source's rate ``r`` = target / size of the source,
and once more with probability ``r - floor(r)``.  The cube method draws these
extra copies: inclusion probabilities move inside the null-space of the two
balance constraints (words, documents) until at most two of them per block are
still fractional, so the drawn words and documents equal their expectation but
for the small landing problem.

The flight runs in blocks of a source (a block is a hash range of its
documents, so a source with a third of all rows is as many tasks as it needs);
what stays fractional, at most two documents a block, flies again in the next
round.  The last round has one block a source and ends with the landing.
Blocks and draws depend on the ids only, so reruns agree on any cluster.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import WORD_PATTERN, bucket_of, staged

EPS = 1e-9


# Fractional documents of a source that the landing decides at once.
LANDING = 14


def flight(pi: np.ndarray, size: np.ndarray, rng: np.random.Generator, leave: int = 2) -> np.ndarray:
    """Move ``pi`` through the null-space of (documents, words) until at most
    ``leave`` (two at least) entries are fractional.  Three entries are active
    at a time, taken in order."""
    pi, words = pi.tolist(), size.tolist()
    waiting = [i for i, p in enumerate(pi) if EPS < p < 1 - EPS]
    waiting.reverse()
    draws, active = iter(rng.random(len(waiting) + 1).tolist()), []
    while True:
        while len(active) < 3 and waiting:
            active.append(waiting.pop())
        if len(active) < 3 or len(active) + len(waiting) <= leave:
            return np.array(pi)
        a, b, c = active
        # u with u.1 = 0 and u.words = 0; any shift if all three are as long.
        u = (words[b] - words[c], words[c] - words[a], words[a] - words[b])
        if u == (0, 0, 0):
            u = (1, -1, 0)
        up = min((1 - pi[k]) / x if x > 0 else -pi[k] / x for k, x in zip(active, u) if x)
        down = min(pi[k] / x if x > 0 else (pi[k] - 1) / x for k, x in zip(active, u) if x)
        step = up if next(draws) * (up + down) < down else -down
        for k, x in zip(active, u):
            pi[k] += step * x
            if pi[k] <= EPS or pi[k] >= 1 - EPS:
                pi[k] = float(pi[k] >= 0.5)
        active = [k for k in active if 0 < pi[k] < 1]


def landing(pi: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Round the last fractional entries, ``LANDING`` at most: of all choices
    with a document count within one of its expectation, the one whose words
    come nearest to theirs."""
    left = np.flatnonzero((pi > EPS) & (pi < 1 - EPS))
    picks = np.arange(1 << len(left))[:, None] >> np.arange(len(left)) & 1
    off = np.abs(picks @ size[left] - pi[left] @ size[left])
    off[np.abs(picks.sum(1) - pi[left].sum()) > 1] = np.inf
    pi[left] = picks[off.argmin()]
    return np.round(pi)


def fly(last: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        # Short documents fly first: a choice among the longest few can come
        # near any sum, so they are what the landing is left with.
        rows = rows.drop(columns="b").sort_values(["size", "draw", "unit"])
        rng = np.random.default_rng(int(rows["draw"].iloc[0]) & (2**63 - 1))
        size = rows["size"].to_numpy(np.int64)
        pi = flight(rows["pi"].to_numpy(float), size, rng, LANDING if last else 2)
        return rows.assign(pi=landing(pi, size) if last else pi)
    return run


def source_targets(sizes: DataFrame, weights: tuple = (5, 2, 1), max_copies: int = 3) -> DataFrame:
    """(source, n, source_size, target) from (source, size) rows.  Sources by
    code point, null last, weigh ``weights`` in turn and share all words; a
    target stops at ``max_copies`` times its source's size and the excess is
    shared again by weight.  That fixed point is min(cap, level * weight) for
    one level, found with running sums over the sources by cap per weight."""
    per = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    cycle = F.array(*(F.lit(float(w)) for w in weights))
    per = (per.withColumn("w", F.element_at(cycle, (place % len(weights) + 1).cast("int")))
           .withColumn("cap", F.col("source_size") * float(max_copies)))
    by_ratio = Window.orderBy((F.col("cap") / F.col("w")), F.col("source").asc_nulls_last())
    below = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    per = (per.withColumn("capped", F.coalesce(F.sum("cap").over(below), F.lit(0.0)))
           .withColumn("free_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(below), F.lit(0.0)))
           .withColumn("all", F.sum("source_size").over(every)))
    # The level if exactly the sources below are capped; the right one is the
    # first, by cap per weight, that leaves its own source uncapped.
    per = (per.withColumn("level", (F.col("all") - F.col("capped")) / F.col("free_w"))
           .withColumn("at", F.row_number().over(by_ratio)))
    fits = F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct("at", "level"))
    level = F.min(fits).over(every)["level"]
    return per.select("source", "n", "source_size",
                      F.least(F.col("cap"), F.coalesce(level * F.col("w"), F.col("cap"))).alias("target"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def mix(documents: DataFrame, *, weights: tuple = (5, 2, 1), max_copies: int = 3,
        block: int = 4096, keep: tuple = ()) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken): how often the mix
    takes each document, 0 to ``max_copies`` times.

    Null text and empty text have size 0 and are taken with their source's
    rate in documents.  Null sources are one source, the last.  Repeated rows
    count and are drawn each on its own.  A source without words has target
    0 and takes nothing.  Rows without an id take no part, other columns are
    never read, and an empty table gives no rows.  Columns in ``keep`` follow.
    """
    rows = documents.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
                            word_count(F.col("text")).alias("size"), *keep)
    # Repeated rows of one id are told apart by their place among equals.
    rows = staged(rows.withColumn("unit", F.row_number().over(
        Window.partitionBy("doc_id").orderBy("source", "size"))), "mix-sizes")
    targets = staged(source_targets(rows, weights, max_copies), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(max_copies)))).otherwise(0.0)
    same = rows["source"].eqNullSafe(targets["source"])
    rated = rows.join(targets, same).select(rows["*"], "n", "source_size", "target", rate.alias("rate"))
    units = rated.select(
        "doc_id", "unit", "source", "size", "n", (F.col("rate") - F.floor("rate")).alias("pi"),
        F.xxhash64("doc_id", "unit").alias("draw"))
    units = units.filter((F.col("pi") > EPS) & (F.col("pi") < 1 - EPS))
    largest = targets.agg(F.max("n")).first()[0] or 0
    settled = []
    fields = "doc_id long, unit int, source string, size long, n long, pi double, draw long"
    while True:
        last = largest <= block
        blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long")
        dealt = units.withColumn("b", F.pmod(F.xxhash64("draw", F.lit(len(settled))), blocks))
        flown = staged(dealt.groupBy("source", "b").applyInPandas(fly(last), fields), f"mix-flight-{len(settled)}")
        open_ = (F.col("pi") > 0) & (F.col("pi") < 1)
        settled.append(flown.filter(~open_).filter(F.col("pi") == 1).select("doc_id", "unit"))
        if last:
            break
        # At most two units a block are left: the source's new size bound.
        units = flown.filter(open_).withColumn("n", F.ceil(F.col("n") / block) * 2)
        largest = -(-largest // block) * 2
    extra = settled[0]
    for more in settled[1:]:
        extra = extra.unionByName(more)
    extra = extra.withColumn("more", F.lit(1))
    whole = F.floor(F.col("rate") + EPS).cast("int")
    out = rated.join(extra, ["doc_id", "unit"], "left").withColumn(
        "copies", F.least(whole + F.coalesce("more", F.lit(0)), F.lit(max_copies)))
    return out.select("doc_id", "size", "source_size", "target", "copies",
                      (F.col("copies") * F.col("size")).cast("long").alias("taken"), *keep)
