"""Hard-negative mining by integer inner product over an STR-packed R-tree.

Rows are cut into tiles by Spark: slabs of equal count by label, each slab by
the first component, each of these by the second (sort, tile, recurse), and a
tile that ties leave too large by row hash.  A tile is packed the same way in
one task into leaves of ``LEAF`` rows, written once, a row each.  Boxes hold the
least and greatest value of every component and of the label.  A box bounds each
component's part of an inner product, and the sum of these intervals bounds the
scores of everything inside.

A search asks the directory of tile boxes which tiles an anchor must see, and
brings anchors and leaves together by tile.  In a tile a best-first queue takes
the box with the highest upper bound; a box is left out when it lies outside all
score windows or strictly below the k-th score of each.  Positives are searched
first; the anchor's own tile gives the k-th score that keeps it out of others.

No task holds more than a tile and ``ANCHORS`` anchors, or ``DIRECTORY`` boxes
and ``ANCHORS`` anchors; a tile that more anchors see is dealt out once for each
so many.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import staged

# Rows of a leaf, boxes of an inner node, rows of a tile; anchors that one task
# takes through a tile, and tiles of a directory block.
LEAF, FAN, TILE = 256, 16, 16384
ANCHORS, DIRECTORY = 4096, 1024

LEAST, MOST = -(1 << 63), (1 << 63) - 1
# Sums of absolute products below this are exact in double arithmetic.
EXACT = float(1 << 52)

LEAF_ROWS = ("tile string, dim int, leaf int, ids binary, labels binary, vectors binary, "
             "low array<double>, high array<double>, label_low long, label_high long")


def quantised(vector: Column, scale: int) -> Column:
    """floor(scale * x) of each component, as whole numbers in doubles; null if
    the vector is null or empty or holds null or non-finite components."""
    whole = lambda x: F.when(F.abs(x) < EXACT, F.floor(x).cast("double")).otherwise(x)  # noqa: E731  above, doubles are whole
    v = F.transform(vector.cast("array<double>"), lambda x: whole(x * scale))
    return F.when(F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))) & (F.size(v) > 0), v)


def scores(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers; beyond a long the nearest long."""
    if np.abs(vectors).max(0) @ np.abs(query) < EXACT:
        return (vectors @ query).astype(np.int64)
    q = [int(x) for x in query.tolist()]
    exact = (sum(int(x) * y for x, y in zip(v, q)) for v in vectors.tolist())
    return np.array([min(max(s, LEAST), MOST) for s in exact], np.int64)


def bounds(low: np.ndarray, high: np.ndarray, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest inner product within boxes: each component's interval,
    summed.  Where doubles round, the bounds are widened by more than that."""
    with np.errstate(all="ignore"):
        up, down = np.maximum(query, 0), np.minimum(query, 0)
        least, most = low @ up + high @ down, high @ up + low @ down
        size = np.maximum(np.abs(low), np.abs(high)) @ np.abs(query)
        slack = np.where(size < EXACT, 0, 1e-9 * size)
        return np.nan_to_num(least - slack, nan=-np.inf, neginf=-np.inf), np.nan_to_num(most + slack, nan=np.inf, posinf=np.inf)


def str_order(keys: np.ndarray, size: int) -> np.ndarray:
    """Row order of sort-tile-recursive packing by the columns of ``keys``:
    sorted by the first, cut into slabs of whole leaves, each packed by the rest."""
    n, depth = keys.shape
    if depth == 0 or n <= size:
        return np.arange(n)
    order, leaves = np.argsort(keys[:, 0], kind="stable"), -(-n // size)
    step = n if depth == 1 else -(-leaves // max(1, round(leaves ** (1 / depth)))) * size
    return np.concatenate([order[s:s + step][str_order(keys[order[s:s + step], 1:], size)] for s in range(0, n, step)])


class Tree:
    """Boxes over leaves of (ids, labels, vectors) in packed order, ``FAN`` to a node."""

    def __init__(self, leaves: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.leaves = leaves
        boxes = (np.array([v.min(0) for _, _, v in leaves]), np.array([v.max(0) for _, _, v in leaves]),
                 np.array([x.min() for _, x, _ in leaves]), np.array([x.max() for _, x, _ in leaves]))
        self.levels = [boxes]
        while len(boxes[0]) > 1:
            cuts = np.arange(0, len(boxes[0]), FAN)
            boxes = tuple(f.reduceat(b, cuts) for f, b in zip((np.minimum, np.maximum) * 2, boxes))
            self.levels.append(boxes)

    def search(self, query: np.ndarray, own: int, label: int, same: bool, windows: list[tuple[int, int]], k: int,
               least: int = LEAST) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each window (lowest and highest score): ids and scores of its
        ``k`` best rows, ties to the smaller id, of the same or of other labels,
        without id ``own`` and without scores below ``least``."""
        need = [max(least, first) for first, _ in windows]
        last = np.array([w[1] for w in windows], float)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
        queue = [(-np.inf, len(self.levels) - 1, 0)]
        while queue and -queue[0][0] >= min(need):
            _, level, at = heapq.heappop(queue)
            if level:
                children = slice(at * FAN, (at + 1) * FAN)
                low, high, label_low, label_high = (b[children] for b in self.levels[level - 1])
                lower, upper = bounds(low, high, query)
                fits = (label_low <= label) & (label <= label_high) if same else (label_low != label) | (label_high != label)
                wanted = (upper[:, None] >= np.array(need, float)) & (lower[:, None] <= last)
                for b in np.flatnonzero(fits & wanted.any(1)):
                    heapq.heappush(queue, (-upper[b], level - 1, children.start + int(b)))
                continue
            ids, labels, vectors = self.leaves[at]
            score = scores(vectors, query)
            ok = ((labels == label) if same else (labels != label)) & (ids != own)
            for w, (_, highest) in enumerate(windows):
                take = ok & (score >= need[w]) & (score <= highest)
                if take.any():
                    i, s = np.concatenate((found[w][0], ids[take])), np.concatenate((found[w][1], score[take]))
                    best = np.lexsort((i, ~s))[:k]  # ~s falls as s grows, at any size
                    found[w] = i[best], s[best]
                    if len(best) == k:
                        need[w] = max(need[w], int(s[best[-1]]))
        return found


def _tiled(rows: DataFrame) -> DataFrame:
    """``rows`` (vec_id, label, v, dim, ..) with their ``tile``."""
    slabs = round((-(-rows.count() // TILE)) ** (1 / 3) + 0.499)
    out = rows.withColumn("tile", F.col("dim").cast("string"))
    for key in (F.col("label"), F.get("v", F.lit(0)), F.coalesce(F.get("v", F.lit(1)), F.lit(0.0))):
        if slabs > 1:
            cuts = out.groupBy("tile").agg(F.percentile_approx(key, [s / slabs for s in range(1, slabs)]).alias("cuts"))
            slab = F.size(F.filter("cuts", lambda c, key=key: c < key))
            out = out.join(cuts, "tile").withColumn("tile", F.concat_ws("/", "tile", slab)).drop("cuts")
    parts = out.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("parts"))
    part = F.pmod(F.xxhash64("vec_id"), F.col("parts"))
    return out.join(parts, "tile").withColumn("tile", F.concat_ws("/", "tile", part)).drop("parts")


def _packed(tile: pd.DataFrame) -> pd.DataFrame:
    vectors = np.array(tile["v"].tolist(), float)
    ids, labels = tile["vec_id"].to_numpy(np.int64), tile["label"].to_numpy(np.int64)
    widest = np.argmax(vectors.max(0) / 2 - vectors.min(0) / 2)
    # The queue's order on ties must not depend on the order of arrival.
    order = np.argsort(ids, kind="stable")
    order = order[str_order(np.stack((labels.astype(float), vectors[:, widest]), 1)[order], LEAF)]
    out = []
    for leaf, s in enumerate(range(0, len(order), LEAF)):
        at = order[s:s + LEAF]
        out.append((tile["tile"].iat[0], int(tile["dim"].iat[0]), leaf, ids[at].tobytes(), labels[at].tobytes(), vectors[at].tobytes(),
                    *((vectors.min(0), vectors.max(0), int(labels.min()), int(labels.max())) if leaf == 0 else (None,) * 4)))
    return pd.DataFrame(out, columns=[c.split()[0] for c in LEAF_ROWS.split(", ")])


def _blocks(n: int, size: int) -> int:
    return max(1, -(-n // size))


def _tiles_to_see(leaves: DataFrame, asked: DataFrame, same: bool) -> DataFrame:
    """(anchor_id, tile): the tiles whose box may hold one of the wanted rows.
    ``asked`` has (anchor_id, dim, label, v, firsts, lasts): score windows."""
    boxes = leaves.filter("leaf = 0").select("tile", "dim", "low", "high", "label_low", "label_high")
    blocks, parts = _blocks(boxes.count(), DIRECTORY), _blocks(asked.count(), ANCHORS)
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    boxes = boxes.withColumns({"block": F.pmod(F.xxhash64("tile"), F.lit(blocks)).cast("int"), "part": every(parts)})
    asked = asked.withColumns({"part": F.pmod(F.xxhash64("anchor_id"), F.lit(parts)).cast("int"), "block": every(blocks)})

    def cell(right: pd.DataFrame, left: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"anchor_id": np.empty(0, np.int64), "tile": np.empty(0, object)})]
        if len(left) and len(right):
            low, high = np.array(right["low"].tolist(), float), np.array(right["high"].tolist(), float)
            label_low, label_high = right["label_low"].to_numpy(), right["label_high"].to_numpy()
            for anchor, label, v, firsts, lasts in zip(left["anchor_id"], left["label"], left["v"], left["firsts"], left["lasts"]):
                lower, upper = bounds(low, high, np.array(v, float))
                fits = (label_low <= label) & (label <= label_high) if same else (label_low != label) | (label_high != label)
                wanted = (upper[:, None] >= np.array(firsts, float)) & (lower[:, None] <= np.array(lasts, float))
                out.append(pd.DataFrame({"anchor_id": anchor, "tile": right["tile"][fits & wanted.any(1)]}))
        return pd.concat(out)

    key = ("dim", "block", "part")
    return boxes.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(cell, "anchor_id long, tile string")


def _search(leaves: DataFrame, asked: DataFrame, same: bool, k: int) -> DataFrame:
    """(anchor_id, last, id, score): for each anchor, tile and window of
    ``asked`` (.., tile, firsts, lasts) the ``k`` best rows of the tile."""
    asked = staged(asked, "rtree-asked")
    parts = asked.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / ANCHORS).alias("parts"))
    asked = asked.join(parts, "tile").withColumn("part", F.pmod(F.xxhash64("anchor_id"), F.col("parts"))).drop("parts")
    leaves = (leaves.select("tile", "dim", "leaf", "ids", "labels", "vectors").join(parts, "tile")
              .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts"))

    def cell(right: pd.DataFrame, left: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({c: np.empty(0, np.int64) for c in ("anchor_id", "last", "id", "score")})]
        if len(left) and len(right):
            right, dim = right.sort_values("leaf"), int(right["dim"].iat[0])
            tree = Tree([(np.frombuffer(i, np.int64), np.frombuffer(x, np.int64), np.frombuffer(v).reshape(-1, dim))
                         for i, x, v in zip(right["ids"], right["labels"], right["vectors"])])
            for anchor, label, v, firsts, lasts in zip(left["anchor_id"], left["label"], left["v"], left["firsts"], left["lasts"]):
                windows = list(zip(map(int, firsts), map(int, lasts)))
                for (_, last), (ids, score) in zip(windows, tree.search(np.array(v, float), int(anchor), int(label), same, windows, k)):
                    out.append(pd.DataFrame({"anchor_id": anchor, "last": last, "id": ids, "score": score}))
        return pd.concat(out)

    key = ("tile", "part")
    return leaves.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(cell, "anchor_id long, last long, id long, score long")


def _best(found: DataFrame, by: list[str], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(F.col("score").desc(), "id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def mine(vectors: DataFrame, anchors: Column, label: Column, *, positives: int = 5, negatives: int = 5, low: int = 80,
         scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score): for each row that fits ``anchors`` its ``positives``
    highest-scoring other rows of the same ``label``, and for each of these the
    ``negatives`` highest-scoring rows of other labels whose score is between
    ``low`` percent of the positive's and the positive's.  Scores are integer
    inner products; ties go to the smaller id.

    Rows without an id or label, and vectors that are null or empty or hold null
    or non-finite components, take no part.  Of rows that share an id the one
    with the smallest (label, vector) counts.  Vectors of different lengths have
    no product.  A score that no long holds counts as the nearest long.  A
    negative positive score has an empty window.  Other columns are never read;
    an empty table, no anchor or a single label gives no rows.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                           quantised(F.col(vector_col), scale).alias("v"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
            .groupBy("vec_id").agg(F.min(F.struct("label", "v")).alias("row"), F.max("is_anchor").alias("is_anchor"))
            .select("vec_id", "row.label", "row.v", "is_anchor", F.size("row.v").alias("dim")))
    tiled = staged(_tiled(staged(rows, "rtree-rows")), "rtree-tiled")
    leaves = staged(tiled.groupBy("tile").applyInPandas(_packed, LEAF_ROWS), "rtree-leaves")
    asked = tiled.filter("is_anchor").select(F.col("vec_id").alias("anchor_id"), "label", "v", "dim", "tile")

    long = lambda n: F.lit(n).cast("long")
    at_home = staged(_search(leaves, asked.withColumns({"firsts": F.array(long(LEAST)), "lasts": F.array(long(MOST))}), True, positives),
                     "rtree-home")
    kth = at_home.groupBy("anchor_id").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("kth"))
    kth = kth.select("anchor_id", F.when(F.col("n") == positives, F.col("kth")).alias("kth"))
    wanted = (asked.withColumnRenamed("tile", "home").join(kth, "anchor_id", "left")
              .withColumns({"firsts": F.array(F.coalesce("kth", long(LEAST))), "lasts": F.array(long(MOST))}).drop("kth"))
    away = wanted.join(_tiles_to_see(leaves, wanted, True), "anchor_id").filter(F.col("tile") != F.col("home")).drop("home")
    pairs = staged(_best(at_home.unionByName(_search(leaves, away, True, positives)), ["anchor_id"], positives)
                   .select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "rtree-positives")

    # ceil(low / 100 * score) without leaving the longs
    s = F.col("positive_score")
    first = F.expr("positive_score div 100") * low + F.ceil((s % 100) * low / 100)
    windows = (pairs.filter(s >= 0).select("anchor_id", first.alias("first"), s.alias("last")).distinct()
               .groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("last", "first"))).alias("w"))
               .select("anchor_id", F.col("w.first").alias("firsts"), F.col("w.last").alias("lasts")))
    wanted = asked.drop("tile").join(windows, "anchor_id")
    found = _search(leaves, wanted.join(_tiles_to_see(leaves, wanted, False), "anchor_id"), False, negatives)
    best = _best(found.withColumnRenamed("last", "positive_score"), ["anchor_id", "positive_score"], negatives)
    return (pairs.join(best, ["anchor_id", "positive_score"])
            .select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score",
                    F.col("score").alias("negative_score")))
