"""Entry points with the call signatures of the source pipeline, so existing
callers can switch without changes.  Each one delegates to the operator that
implements it here; see the README table for the mapping."""

from __future__ import annotations

from pyspark.sql import DataFrame

from meterline import operators as O
from meterline.operators import gold as G
from meterline.operators.quantiles import remove_outliers_iqr as _remove_outliers_iqr
from meterline.plans.silver import typed_trips
from meterline.sources.zones import SizedDimension, sized_zones


def fill_missing_values(df: DataFrame) -> DataFrame:
    return O.fill_missing(df)


def cast_columns(df: DataFrame) -> DataFrame:
    return O.cast_columns(df)


def add_trip_time(df: DataFrame) -> DataFrame:
    return O.add_trip_time(df)


def apply_consistency_filters(df: DataFrame, valid_ids=None) -> DataFrame:
    """``valid_ids`` is accepted and unused, as in the source (the known-zone
    rule is off); pass ``zones=`` to ``operators.consistency_filter`` to use it."""
    return O.consistency_filter(df)


def validate_financials(df: DataFrame, tolerance_pct: float = 0.03) -> DataFrame:
    return O.validate_financials(df, tolerance_pct)


def drop_duplicate_trips(df: DataFrame) -> DataFrame:
    return O.drop_duplicate_trips(df)


def map_ratecode_description(df: DataFrame) -> DataFrame:
    return O.map_ratecode(df)


def map_payment_type_description(df: DataFrame) -> DataFrame:
    return O.map_payment(df)


def map_vendor_id_description(df: DataFrame) -> DataFrame:
    return O.map_vendor(df)


def map_location_to_zone(df: DataFrame, location_col: str, zones) -> DataFrame:
    """``zones``: a zone DataFrame ``(LocationID, zone)``, a ``SizedDimension``,
    or the ``{id: name}`` dict callers already hold on the driver."""
    if isinstance(zones, dict):
        frame = df.sparkSession.createDataFrame([(int(k), str(v)) for k, v in zones.items()],
                                                "LocationID int, zone string")
        zones = sized_zones(frame)
    elif not isinstance(zones, SizedDimension):
        zones = sized_zones(zones)
    return O.map_location_to_zone(df, zones, (location_col,))


def transform_month(df: DataFrame) -> DataFrame:
    return O.label_month(df)


def transform_day(df: DataFrame) -> DataFrame:
    return O.label_day(df)


def aggregated_values(df: DataFrame, time_stamp: str = "day", location_col=()) -> DataFrame:
    return G.trip_metrics(df, time_stamp, list(location_col))


def aggregate_values_by_bucket(df: DataFrame, time_stamp: str = "day", location_col=()) -> DataFrame:
    return G.bucket_metrics(df, time_stamp, list(location_col))


def aggregate_values_by_passengers(df: DataFrame, time_stamp: str = "day", location_col=()) -> DataFrame:
    return G.passenger_metrics(df, time_stamp, list(location_col))


def remove_outliers_iqr(df: DataFrame, numeric_cols) -> DataFrame:
    """Sequential IQR removal; exact quartiles (``operators.remove_outliers_iqr``
    with ``exact=False`` gives the approximate variant)."""
    return _remove_outliers_iqr(df, tuple(numeric_cols))


__all__ = [
    "fill_missing_values", "cast_columns", "add_trip_time", "apply_consistency_filters", "validate_financials",
    "drop_duplicate_trips", "map_ratecode_description", "map_payment_type_description",
    "map_vendor_id_description", "map_location_to_zone", "transform_month", "transform_day",
    "aggregated_values", "aggregate_values_by_bucket", "aggregate_values_by_passengers",
    "remove_outliers_iqr", "typed_trips",
]
