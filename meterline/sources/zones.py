"""Zone dimension: one ``(LocationID, zone)`` row per id, joined by size."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

# Largest dimension broadcast to every executor (the real taxi-zone table has
# 265 rows).  Above this the lookup falls back to a shuffle join.
BROADCAST_MAX_ROWS = 200_000


def zone_dimension(zones: DataFrame) -> DataFrame:
    """One row per LocationID; when an id repeats, the row read last wins.

    "Last" is file order: a ``_pos`` column when the source provides one
    (``sources.fixture.raw_zones`` takes file path and row index from the
    Parquet scan, which is deterministic, so Spark can reuse the dimension's
    broadcast), else ``monotonically_increasing_id`` (partition index in the
    high bits, row position in the low bits).  No id can fan out a join.  Null
    ids are dropped: they can never match a trip.
    """
    position = F.col("_pos") if "_pos" in zones.columns else F.monotonically_increasing_id()
    ordered = zones.select("LocationID", "zone", position.alias("_pos"))
    return (ordered.filter(F.col("LocationID").isNotNull())
            .groupBy("LocationID")
            .agg(F.max_by("zone", "_pos").alias("zone")))


_ROW_BOUNDS: dict = {}


def _row_bound(df: DataFrame) -> int:
    """Row count of ``df``, remembered per application and exact set of input
    files (a rewritten table has new file names, so it is counted again);
    frames not read from files are always counted."""
    files = tuple(sorted(df.inputFiles()))
    if not files:
        return df.count()
    sc = df.sparkSession.sparkContext
    key = (sc.applicationId, files, df.schema.json())
    if key not in _ROW_BOUNDS:
        _ROW_BOUNDS[key] = df.count()
    return _ROW_BOUNDS[key]


class SizedDimension:
    """A dimension table whose size is bounded once, so every join on it knows
    whether broadcasting is safe.

    ``bound`` is a frame with at least as many rows as ``df`` (the rows before
    the one-per-id reduction); counting it needs no shuffle, and for a Parquet
    scan Spark answers from file footers."""

    def __init__(self, df: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS,
                 bound: DataFrame | None = None):
        self.df = df
        self.rows_bound = _row_bound(df if bound is None else bound)
        self.broadcastable = self.rows_bound <= max_broadcast_rows

    def side(self) -> DataFrame:
        return F.broadcast(self.df) if self.broadcastable else self.df


def sized_zones(zones: DataFrame, max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> SizedDimension:
    return SizedDimension(zone_dimension(zones), max_broadcast_rows, bound=zones)
