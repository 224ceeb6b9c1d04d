"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.llm.common import staged


def connected_components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in ``links`` (a, b): the smallest id
    reachable.  Ids without links are not returned.

    Each half round hangs a node's larger (or smaller) neighbours on the
    smallest neighbour; nodes end as stars around their component's minimum.
    Minima are aggregates with map-side combine and are written before they
    are joined, so a hub with very many links is split by AQE; no neighbour
    list is ever built.  Edges never outnumber the input's.
    """
    edges = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                   .filter("a <> b").distinct(), "links")
    seen = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
        if state == seen or state["n"] == 0:
            return edges.select(F.col("a").alias("id"), F.col("b").alias("component")).unionByName(
                edges.select(F.col("b").alias("id"), F.col("b").alias("component"))).distinct()
        seen = state
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "star-min")
        large = staged(both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .distinct(), "large-star")
        least = staged(large.groupBy("a").agg(F.min("b").alias("m")), "star-min")
        small = large.join(least, "a")
        edges = staged(small.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                       .unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "small-star")
