"""Duplicate trips: removal and the duplicate-group report.

Both are aggregations on the dedup key, so Spark combines map-side before the
shuffle: a key holding a third of all rows leaves each map task as one row,
instead of landing whole in one reducer as a ``row_number`` window would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# The columns that identify one trip.
DEDUP_KEYS = ("tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance")


def drop_duplicate_trips(df: DataFrame, keys=DEDUP_KEYS, survivor: str = "smallest") -> DataFrame:
    """One row per key.

    ``survivor="smallest"`` (default) keeps, among rows sharing a key, the one
    whose remaining columns are smallest in column order (nulls first), so the
    result is reproducible on any partitioning.  ``survivor="any"`` is
    ``dropDuplicates``: any row of the group, cheaper but not reproducible
    when rows differ outside the key.  Null key values group together.
    """
    keys = list(keys)
    if survivor == "any":
        return df.dropDuplicates(keys)
    if survivor != "smallest":
        raise ValueError(f"unknown survivor rule: {survivor}")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct().select(*df.columns)
    kept = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def duplicate_groups(df: DataFrame, keys=DEDUP_KEYS) -> DataFrame:
    """Each key that occurs more than once, with ``dup_count``."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("dup_count"))
            .filter(F.col("dup_count") > 1))
