"""Row-level cleaning operators: fills, casts, derived columns, labels.

All are narrow projections (no shuffle) made of built-in expressions, so a
chain of them collapses into one codegen'd ``Project`` over the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions import (
    calendar_columns, distance_band, month_label, payment_label, ratecode_label, rounded_minutes,
    vendor_label, weekday_label,
)
from meterline.functions.calendar import check_period
from meterline.functions.reuse import per_application
from meterline.functions.labels import UNKNOWN_ZONE
from meterline.schema import CAST_TYPES

# ---------------------------------------------------------------------------
# Default for each missing value (VendorID, distance and the
# timestamps are deliberately left null).
FILL_VALUES = {
    "RatecodeID": 99,
    "PUlocationID": 999,
    "DOlocationID": 999,
    "payment_type": 5,
    "fare_amount": 0,
    "tolls_amount": 0,
    "tip_amount": 0,
    "extra": 0,
    "mta_tax": 0,
    "airport_fee": 0,
    "improvement_surcharge": 0,
    "congestion_surcharge": 0,
    "total_amount": 0,
    "passenger_count": 0,
}
# ---------------------------------------------------------------------------


_FILL_BY_LOWER = {k.lower(): v for k, v in FILL_VALUES.items()}
_CAST_BY_LOWER = {k.lower(): (k, v) for k, v in CAST_TYPES.items()}


def filled(name: str, dtype: str) -> Column:
    """Column ``name`` with its default filled in (NaN counts as missing in a
    floating-point column, as ``fillna`` does).  Names match case-insensitively."""
    c = F.col(name)
    value = _FILL_BY_LOWER.get(name.lower())
    if value is None:
        return c
    if dtype in ("double", "float"):
        return F.coalesce(F.nanvl(c, F.lit(None)), F.lit(float(value)))
    return F.coalesce(c, F.lit(value))


def fill_missing(df: DataFrame) -> DataFrame:
    """Per-column defaults; a NaN in a double column is filled like a null."""
    return df.fillna(FILL_VALUES)


def typed_columns(df: DataFrame, with_minutes: bool = True) -> list[Column]:
    """fill -> cast (-> trip minutes) for every column of a raw frame, as ONE
    projection list (one analyzer pass, one codegen'd Project)."""
    return _typed_columns(tuple(df.dtypes), with_minutes)


@per_application
def _typed_columns(dtypes: tuple, with_minutes: bool) -> list[Column]:
    cols = []
    for c, t in dtypes:
        known = _CAST_BY_LOWER.get(c.lower())
        # contract columns take the contract's spelling (files say PULocationID)
        cols.append(filled(c, t).cast(known[1]).alias(known[0]) if known else filled(c, t).alias(c))
    if with_minutes:
        pickup = filled("tpep_pickup_datetime", "").cast("timestamp")
        dropoff = filled("tpep_dropoff_datetime", "").cast("timestamp")
        cols.append(rounded_minutes(pickup, dropoff).alias("trip_time_minutes"))
    return cols


def fill_all_numeric(df: DataFrame, value: int = 0) -> DataFrame:
    """Every null (and NaN) in a numeric column becomes ``value``."""
    return df.fillna(value)


def fill_unknown_zones(df: DataFrame, columns=("PUlocationID", "DOlocationID")) -> DataFrame:
    """After zone mapping: an id with no zone name reads ``"Unknown"``."""
    return df.fillna({c: UNKNOWN_ZONE for c in columns})


def cast_columns(df: DataFrame, types: dict = CAST_TYPES) -> DataFrame:
    """Cast every contract column in one projection; other columns pass through.

    ``timestamp_ntz -> timestamp`` reads wall-clock values in the session zone
    (UTC, see ``meterline.session``).
    """
    by_lower = {k.lower(): (k, v) for k, v in types.items()}
    out = []
    for c in df.columns:
        known = by_lower.get(c.lower())
        out.append(F.col(c).cast(known[1]).alias(known[0]) if known else F.col(c))
    return df.select(*out)


def trip_minutes(df: DataFrame) -> Column:
    return rounded_minutes(F.col("tpep_pickup_datetime"), F.col("tpep_dropoff_datetime"))


def add_trip_time(df: DataFrame) -> DataFrame:
    """``trip_time_minutes``: whole minutes, HALF_UP."""
    return df.withColumn("trip_time_minutes", trip_minutes(df))


def speed_mph(distance: Column, minutes: Column) -> Column:
    """Average speed, 2 decimals; null when the trip lasted 0 minutes."""
    return F.round(F.when(minutes != 0, distance / (minutes / 60.0)), 2)


@per_application
def avg_speed_column() -> Column:
    return speed_mph(F.col("trip_distance"), F.col("trip_time_minutes"))


def add_avg_speed(df: DataFrame) -> DataFrame:
    return df.withColumn("avg_speed", avg_speed_column())


@per_application
def code_labels() -> dict[str, Column]:
    return {
        "RatecodeID": ratecode_label("RatecodeID"),
        "payment_type": payment_label("payment_type"),
        "VendorID": vendor_label("VendorID"),
    }


def map_codes(df: DataFrame) -> DataFrame:
    """Rate code, payment type and vendor codes become their labels, in place."""
    labelled = code_labels()
    return df.select(*[labelled[c].alias(c) if c in labelled else F.col(c) for c in df.columns])


def map_ratecode(df: DataFrame) -> DataFrame:
    return df.withColumn("RatecodeID", ratecode_label("RatecodeID"))


def map_payment(df: DataFrame) -> DataFrame:
    return df.withColumn("payment_type", payment_label("payment_type"))


def map_vendor(df: DataFrame) -> DataFrame:
    return df.withColumn("VendorID", vendor_label("VendorID"))


def add_distance_band(df: DataFrame, column: str = "trip_distance", name: str = "distance_bucket") -> DataFrame:
    return df.withColumn(name, distance_band(column))


def add_calendar_keys(df: DataFrame, period: str = "day", ts: str = "tpep_pickup_datetime") -> DataFrame:
    """pickup_year, pickup_month and pickup_<period> as numbers."""
    check_period(period)
    return df.withColumns(calendar_columns(F.col(ts), period))


def label_month(df: DataFrame, column: str = "pickup_month") -> DataFrame:
    return df.withColumn(column, month_label(column))


def label_day(df: DataFrame, column: str = "pickup_day") -> DataFrame:
    return df.withColumn(column, weekday_label(column))
