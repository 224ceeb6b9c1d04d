"""Location-id lookups against the zone dimension.

The dimension is joined, never shipped as a literal map or an id list: a
broadcast hash join when its measured size allows, a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from meterline.sources.zones import SizedDimension

LOCATION_COLUMNS = ("PUlocationID", "DOlocationID")


def _dimension_as(zones: SizedDimension, role: str) -> DataFrame:
    side = zones.df.select(F.col("LocationID").alias(f"_id_{role}"), F.col("zone").alias(f"_zone_{role}"))
    return F.broadcast(side) if zones.broadcastable else side


def map_location_to_zone(df: DataFrame, zones: SizedDimension, columns=LOCATION_COLUMNS) -> DataFrame:
    """Replace each location id column by its zone name (null when the id is
    null or not in the dimension), keeping the column order.

    Both lookups join the same dimension frame under different aliases, so
    Spark builds and ships its broadcast once (``ReusedExchange``)."""
    side = zones.side()
    out = df
    for column in columns:
        role = f"_zone_of_{column}"
        out = out.join(side.alias(role), out[column] == F.col(f"{role}.LocationID"), "left")
    names = {c: F.col(f"_zone_of_{c}.zone").alias(c) for c in columns}
    return out.select(*[names.get(c, df[c]) for c in df.columns])


def flag_unknown_zones(df: DataFrame, zones: SizedDimension, columns=LOCATION_COLUMNS) -> DataFrame:
    """Add ``_unknown_zone``: true when any location id is null or absent from
    the dimension (null-safe, unlike ``NOT IN``)."""
    out = df
    matched = []
    for column in columns:
        side = _dimension_as(zones, column).select(f"_id_{column}")
        out = out.join(side, out[column] == side[f"_id_{column}"], "left")
        matched.append(F.col(f"_id_{column}").isNull())
    unknown = matched[0]
    for m in matched[1:]:
        unknown = unknown | m
    return out.select(*[F.col(c) for c in df.columns], unknown.alias("_unknown_zone"))


def invalid_zones(df: DataFrame, zones: SizedDimension, columns=LOCATION_COLUMNS) -> DataFrame:
    """Rows whose pickup or dropoff id is null or not a known zone."""
    return flag_unknown_zones(df, zones, columns).filter("_unknown_zone").drop("_unknown_zone")


def invalid_zone_count(df: DataFrame, zones: SizedDimension, columns=LOCATION_COLUMNS) -> DataFrame:
    return invalid_zones(df, zones, columns).agg(F.count(F.lit(1)).alias("invalid_zones"))


def known_zones_only(df: DataFrame, zones: SizedDimension, columns=LOCATION_COLUMNS) -> DataFrame:
    """Rows whose ids all exist in the dimension (``left_semi`` per column)."""
    out = df
    for column in columns:
        side = _dimension_as(zones, column).select(f"_id_{column}")
        out = out.join(side, out[column] == side[f"_id_{column}"], "left_semi")
    return out
