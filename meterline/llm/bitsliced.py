"""Exact top-k by integer inner product over bit-sliced indexes.

Rows are dealt into blocks.  In a block every attribute is kept as bit slices:
one bitmap over the rows for each bit of its offset from the block's minimum
(or from its maximum, for negative query components, so that all terms are
non-negative).  A query's scores are the sum of its components' set bits times
the slices, added column by column with carry-save bitmap adders; the result
is again bit-sliced.  The top k are selected from the most significant slice
downward: rows with a 1 stay as long as there are more than k of them.  What
still ties at the last slice has equal scores and is resolved by row id.

Every (row block, query block) cell is a task group of its own; no cell holds
more than a block of each side, and a cell returns k rows a query.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import bucket_of

ROW_BLOCK, QUERY_BLOCK = 16384, 512

# Components must stay below this, quantised, so that an attribute's range fits a long.
LARGEST = float(1 << 62)


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if the vector is null or holds
    null, non-finite or too large components (``LARGEST``)."""
    v = vector.cast("array<double>")
    fine = F.forall(v, lambda x: F.coalesce(F.abs(x) * scale < LARGEST, F.lit(False)))
    return F.when(fine, F.transform(v, lambda x: F.floor(x * scale)))


def bitmaps(values: np.ndarray) -> np.ndarray:
    """(bits, words) of one non-negative attribute: bit r of slice b is bit b of row r."""
    bits = max(1, int(values.max()).bit_length())
    rows = (values[None, :] >> np.arange(bits)[:, None] & 1).astype(np.uint8)
    packed = np.packbits(rows, axis=1, bitorder="little")
    return np.pad(packed, ((0, 0), (0, -packed.shape[1] % 8))).view("<u8")


class BitSlicedIndex:
    def __init__(self, ids: np.ndarray, values: np.ndarray):
        """Rows in id order; ``values`` is (rows, attributes) of int64."""
        self.ids = ids
        self.low, self.high = values.min(0), values.max(0)
        self.up = [bitmaps(c) for c in (values - self.low).T]
        self.down = [bitmaps(c) for c in (self.high - values).T]
        alive = np.packbits(np.ones(len(ids), np.uint8), bitorder="little")
        self.alive = np.pad(alive, (0, -len(alive) % 8)).view("<u8")

    def scores(self, query: np.ndarray) -> tuple[list[np.ndarray], int]:
        """Slices of every row's score, least significant first, and what to add to it."""
        columns: dict[int, list[np.ndarray]] = {}
        ends = np.where(query > 0, self.low, self.high)
        base = sum(q * v for q, v in zip(query.tolist(), ends.tolist()))
        for q, up, down in zip(query.tolist(), self.up, self.down):
            maps = up if q > 0 else down
            for c in range(abs(q).bit_length()):
                if abs(q) >> c & 1:
                    for b in range(len(maps)):
                        columns.setdefault(c + b, []).append(maps[b])
        out, carried, last = [], [], max(columns, default=-1)
        while len(out) <= last or carried:
            maps = columns.pop(len(out), None)
            parts = carried + ([np.stack(maps)] if maps else [])
            col, carried = np.concatenate(parts) if parts else self.alive[None] ^ self.alive, []
            while len(col) > 1:
                if len(col) == 2:
                    carried.append(col[:1] & col[1:])
                    col = col[:1] ^ col[1:]
                else:  # full adders: three bitmaps become a sum and a carry
                    m = len(col) // 3
                    a, b, c = col[:m], col[m:2 * m], col[2 * m:3 * m]
                    half = a ^ b
                    carried.append(a & b | half & c)
                    col = np.concatenate((half ^ c, col[3 * m:]))
            out.append(col[0])
        return out, base

    def top(self, query: np.ndarray, k: int, own: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of the ``k`` best rows but those with id ``own``."""
        slices, base = self.scores(query)
        taken, tied = np.zeros_like(self.alive), self.alive.copy()
        for r in range(*np.searchsorted(self.ids, [own, own + 1])):
            tied[r // 64] &= ~(np.uint64(1) << np.uint64(r % 64))
        for s in reversed(slices):
            ones = tied & s
            n = int(np.bitwise_count(taken | ones).sum())
            if n > k:
                tied = ones
            else:
                taken |= ones
                tied &= ~s
        rows = [np.flatnonzero(np.unpackbits(m.view(np.uint8), bitorder="little")) for m in (taken, tied)]
        rows = np.concatenate((rows[0], rows[1][:max(0, k - len(rows[0]))]))  # ids are in row order
        small = len(slices) < 62 and abs(base) < 1 << 62
        score = np.full(len(rows), base, np.int64 if small else object)  # else Python's integers
        for e, s in enumerate(slices):
            score += (s[rows // 64] >> (rows % 64).astype(np.uint64) & np.uint64(1)).astype(score.dtype) << e
        if not small:
            score = np.array([min(max(int(x), -(1 << 63)), (1 << 63) - 1) for x in score], np.int64)
        return self.ids[rows], score


def top_k(vectors: DataFrame, queries: Column, *, k: int = 5, scale: int = 256, id_col: str = "vec_id",
          vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that fits ``queries`` its
    ``k`` highest integer inner products with all other rows, ties to the
    smaller id; fewer rows than ``k``: all of them.

    Vectors that are null, empty, or hold null, non-finite or too large
    components (2^54 or more at the default scale) take no part.  A score that
    no long holds is given as the nearest long.  Vectors of different lengths have no product.
    Of repeated ids the first vector in array order counts.  Other columns are
    never read; an empty table or no query gives no rows.
    """
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col), scale).alias("v"),
                           F.coalesce(queries, F.lit(False)).alias("is_query"))
            .filter(F.col("vec_id").isNotNull() & (F.size("v") > 0)).withColumn("dim", F.size("v")))
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if("is_query").alias("q")).first()
    row_blocks, query_blocks = (max(1, -(-n // b)) for n, b in ((size["n"], ROW_BLOCK), (size["q"], QUERY_BLOCK)))
    of = lambda n: F.array(*(F.lit(i) for i in range(n))) if n < 64 else F.sequence(F.lit(0), F.lit(n - 1))
    dealt = rows.select("vec_id", "v", "dim", bucket_of(row_blocks, F.col("vec_id")).cast("int").alias("rb"),
                        F.explode(of(query_blocks)).alias("qb"))
    asked = rows.filter("is_query").select(F.col("vec_id").alias("query_id"), "v", "dim",
                                           bucket_of(query_blocks, F.col("vec_id")).cast("int").alias("qb"),
                                           F.explode(of(row_blocks)).alias("rb"))

    def cell(right: pd.DataFrame, left: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(left) and len(right):
            def first(df: pd.DataFrame, key: str) -> tuple[np.ndarray, np.ndarray]:
                df = df.assign(v=df["v"].map(tuple)).sort_values([key, "v"]).drop_duplicates(key)
                return df[key].to_numpy(np.int64), np.array(df["v"].tolist(), np.int64)
            index = BitSlicedIndex(*first(right, "vec_id"))
            for own, query in zip(*first(left, "query_id")):
                ids, score = index.top(query, k, int(own))
                out.append(pd.DataFrame({"query_id": own, "vec_id": ids, "score": score}))
        return pd.concat(out) if out else pd.DataFrame({c: np.empty(0, np.int64) for c in ("query_id", "vec_id", "score")})

    key = ("dim", "rb", "qb")
    found = (dealt.groupBy(*key).cogroup(asked.groupBy(*key))
             .applyInPandas(cell, "query_id long, vec_id long, score long"))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", best).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
