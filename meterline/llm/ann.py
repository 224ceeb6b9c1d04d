"""Approximate nearest neighbours by cross-polytope hashing.

A table's hash turns the unit vector with a pseudo-rotation (three rounds of
random signs and a fast Hadamard transform) and takes the nearest signed axis,
the largest coordinate's place and sign.  A query also probes the next nearest
axes.  Rows and probing queries meet in their (table, axis) bucket, where the
exact distances to the original vectors are computed and each query's nearest
are kept; the best of all buckets are the answer.  Large buckets are split
into parts of at most ``PART`` rows (expected), each met by all its queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from meterline.llm.common import bucket_of, map_rows, staged

PART = 8192


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of each row; the width is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack((y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]), 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def axis_scores(x: np.ndarray, table: int) -> np.ndarray:
    """(rows, 2 * width): the rotated unit vectors' nearness to each signed axis."""
    width = 1 << max(0, x.shape[1] - 1).bit_length()
    y = np.zeros((len(x), width))
    y[:, :x.shape[1]] = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the norm
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    rng = np.random.default_rng([table, width])
    for _ in range(3):
        y = hadamard(y * rng.choice((-1.0, 1.0), width))
    return np.concatenate((y, -y), axis=1)


def hashed(rows: DataFrame, tables: int, probes: int) -> DataFrame:
    """Each row once per table and probed axis, with its vector."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = {c: batch.column(i) for i, c in enumerate(("vec_id", "v"))}
        lists = at["v"].to_pylist()
        dims = np.array([len(v) for v in lists])
        takes, out = [], {"dim": [], "t": [], "axis": []}
        for dim in np.unique(dims):
            own = np.flatnonzero(dims == dim)
            x = np.array([lists[i] for i in own], float)
            for t in range(tables):
                near = np.argsort(-axis_scores(x, t), axis=1, kind="stable")[:, :probes]
                takes.append(np.repeat(own, near.shape[1]))
                out["axis"].append(near.ravel().astype(np.int32))
                out["t"].append(np.full(near.size, t, np.int32))
                out["dim"].append(np.full(near.size, dim, np.int32))
        take = pa.array(np.concatenate(takes))
        return pa.record_batch({c: x.take(take) for c, x in at.items()} | {c: pa.array(np.concatenate(x)) for c, x in out.items()})
    kind = dict(rows.dtypes)["v"]
    return map_rows(rows.select("vec_id", "v"), run, f"vec_id long, v {kind}, dim int, t int, axis int")


def nearest(vectors: DataFrame, queries: Column, *, k: int = 10, tables: int = 12, probes: int = 6,
            id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each row that fits ``queries`` the
    ``k`` rows of smallest Euclidean distance found, its own id excluded, ties
    to the smaller id; the distance is exact, in double precision.

    Vectors that are null, empty, zero, or hold null or non-finite components
    take no part.  Vectors of different lengths never meet.  Rows of one id
    count as one, at its nearest.  Other columns are never read; an empty
    table or no query gives no rows.  A query whose probes meet fewer than
    ``k`` rows is compared with every row, so that it too gets ``k``.
    """
    v = F.col(vector_col)
    finite = F.forall(v, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = (vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"),
                           F.coalesce(queries, F.lit(False)).alias("is_query"))
            .filter(F.col("vec_id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0)))
    index = staged(hashed(rows, tables, 1), "ann-index")
    bucket = ("dim", "t", "axis")
    # One row per table and axis.
    parts = staged(index.groupBy(*bucket).agg(F.ceil(F.count(F.lit(1)) / PART).cast("int").alias("parts")), "ann-buckets")
    asked = hashed(rows.filter("is_query"), tables, probes).join(F.broadcast(parts), list(bucket))
    asked = asked.withColumnRenamed("vec_id", "query_id").withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = index.join(F.broadcast(parts), list(bucket)).withColumn(
        "part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))

    def local(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return compare(left, right, k)

    key = (*bucket, "part")
    found = (asked.select("query_id", "v", *key).groupBy(*key)
             .cogroup(dealt.select("vec_id", "v", *key).groupBy(*key)).applyInPandas(local, FOUND))
    found = staged(found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score")), "ann-found")

    # Queries that met too few rows (small or odd tables) look at every part.
    met = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("met"))
    short = rows.filter("is_query").select(F.col("vec_id").alias("query_id"), "v").join(met, "query_id", "left")
    short = staged(short.filter(F.coalesce("met", F.lit(0)) < k).drop("met"), "ann-short")
    if not short.isEmpty():
        n = max(1, -(-rows.count() // PART))
        everywhere = short.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("dim", F.size("v"))
        every = rows.select("vec_id", "v", bucket_of(n, F.col("vec_id")).cast("int").alias("part"), F.size("v").alias("dim"))
        more = everywhere.groupBy("dim", "part").cogroup(every.groupBy("dim", "part")).applyInPandas(local, FOUND)
        found = found.unionByName(more).groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    place = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", place).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


FOUND = "query_id long, vec_id long, score double"


def compare(left: pd.DataFrame, right: pd.DataFrame, k: int) -> pd.DataFrame:
    """Each query's ``k`` nearest of the rows, by exact distance."""
    out = {"query_id": [], "vec_id": [], "score": []}
    if len(left) and len(right):
        ids, x = right["vec_id"].to_numpy(np.int64), np.array(right["v"].tolist(), float)
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], x[order]
        for own, q in zip(left["query_id"], left["v"]):
            off = x - np.asarray(q, float)
            away = np.sqrt(np.einsum("ij,ij->i", off, off))
            away[ids == own] = np.inf
            # Repeated ids may take places, so keep k distinct ones.
            best = np.argsort(away, kind="stable")
            best = best[np.isfinite(away[best])]
            best = best[np.sort(np.unique(ids[best], return_index=True)[1])][:k] if len(np.unique(ids)) < len(ids) else best[:k]
            out["query_id"].append(np.full(len(best), own))
            out["vec_id"].append(ids[best])
            out["score"].append(away[best])
    return pd.DataFrame({c: np.concatenate(x) if x else np.empty(0, float if c == "score" else np.int64) for c, x in out.items()})
