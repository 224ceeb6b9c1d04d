"""Validity rules as data: one list of named predicates feeds both the row
filter and the violation counts, so the two can never drift apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.reuse import per_application
from meterline.operators.zones import known_zones_only
from meterline.sources.zones import SizedDimension

# ---------------------------------------------------------------------------
# Bounds of the cleaning rules.
START_DATE = "2023-01-01"          # pickups and dropoffs from this date on
ANALYSIS_START = "2024-01-01"      # profiling period: pickups strictly after
MAX_DISTANCE = 150                 # miles, inclusive
MIN_MINUTES, MAX_MINUTES = 3, 180  # exclusive, inclusive (on rounded minutes)
MAX_TOTAL = 500                    # inclusive; total must also be > 0
VALID_RATECODES = (1, 2, 3, 4, 5, 6, 99)
VALID_PAYMENTS = (0, 1, 2, 3, 4, 5, 6)
VALID_VENDORS = (1, 2, 6, 7)                  # opt-in rule
PASSENGERS_OPEN_RANGE = (0, 7)                # opt-in rule: 0 < n < 7
MONEY_TOLERANCE = 0.03                        # |components - total| / total
# Components of total_amount, added in this order.
TOTAL_COMPONENTS = ("fare_amount", "tolls_amount", "tip_amount", "extra", "mta_tax",
                    "airport_fee", "improvement_surcharge", "congestion_surcharge")
# ---------------------------------------------------------------------------


def _c(name: str) -> Column:
    return F.col(name)


def _start() -> Column:
    return F.to_date(F.lit(START_DATE))


@per_application
def keep_rules() -> list[tuple[str, Column]]:
    """The rules a clean trip satisfies (on filled, cast columns with minutes)."""
    return [
        ("pickup_from_start", _c("tpep_pickup_datetime") >= _start()),
        ("dropoff_from_start", _c("tpep_dropoff_datetime") >= _start()),
        ("dropoff_after_pickup", _c("tpep_dropoff_datetime") > _c("tpep_pickup_datetime")),
        ("distance_in_range", (_c("trip_distance") > 0) & (_c("trip_distance") <= MAX_DISTANCE)),
        ("known_ratecode", _c("RatecodeID").isin(list(VALID_RATECODES))),
        ("known_payment", _c("payment_type").isin(list(VALID_PAYMENTS))),
        ("minutes_in_range", (_c("trip_time_minutes") > MIN_MINUTES) & (_c("trip_time_minutes") <= MAX_MINUTES)),
        ("total_in_range", (_c("total_amount") > 0) & (_c("total_amount") <= MAX_TOTAL)),
        ("fare_not_negative", _c("fare_amount") >= 0),
        ("tip_not_negative", _c("tip_amount") >= 0),
        ("tolls_not_negative", _c("tolls_amount") >= 0),
    ]


def optional_rules(passengers: bool = False, vendors: bool = False) -> list[tuple[str, Column]]:
    """Rules that exist but are off by default."""
    rules = []
    if passengers:
        lo, hi = PASSENGERS_OPEN_RANGE
        rules.append(("passengers_in_range", (_c("passenger_count") > lo) & (_c("passenger_count") < hi)))
    if vendors:
        rules.append(("known_vendor", _c("VendorID").isin(list(VALID_VENDORS))))
    return rules


@per_application
def valid_condition(passengers: bool = False, vendors: bool = False, tolerance: float | None = None) -> Column:
    """All keep rules (plus the opt-in ones) as one predicate; with
    ``tolerance`` also the money check."""
    cond = all_of(keep_rules() + optional_rules(passengers, vendors))
    return cond if tolerance is None else cond & money_consistent(tolerance)


def all_of(rules: list[tuple[str, Column]]) -> Column:
    cond = F.lit(True)
    for _, predicate in rules:
        cond = cond & predicate
    return cond


def consistency_filter(df: DataFrame, *, passengers: bool = False, vendors: bool = False,
                       zones: SizedDimension | None = None) -> DataFrame:
    """Keep rows passing every rule (one ``Filter``; Catalyst pushes the
    timestamp and distance bounds into the Parquet scan).

    ``zones`` turns on the known-zone rule: both location ids must exist in the
    dimension, checked with two ``left_semi`` joins (no id list on the driver).
    """
    out = df.filter(valid_condition(passengers, vendors))
    if zones is not None:
        out = known_zones_only(out, zones)
    return out


def total_from_components() -> Column:
    total = None
    for name in TOTAL_COMPONENTS:
        total = _c(name) if total is None else total + _c(name)
    return total


@per_application
def money_consistent(tolerance: float = MONEY_TOLERANCE) -> Column:
    """True when the components add up to total within ``tolerance``.

    A zero or null total is never consistent; a negative total always is (its
    ratio is negative), which is why the range rule runs first.
    """
    total = _c("total_amount")
    ratio = F.abs(total_from_components() - total) / total
    return (F.when(total == 0, F.lit(False))
            .when(ratio <= tolerance, F.lit(True))
            .otherwise(F.lit(False)))


def validate_financials(df: DataFrame, tolerance: float = MONEY_TOLERANCE) -> DataFrame:
    return df.filter(money_consistent(tolerance))


def period_filter(df: DataFrame, start: str = ANALYSIS_START) -> DataFrame:
    """Pickups strictly after ``start``."""
    return df.filter(_c("tpep_pickup_datetime") > F.to_date(F.lit(start)))


@per_application
def violation_rules() -> list[tuple[str, Column]]:
    """The 14 profiling checks: a row counts when the predicate is true (a
    null comparison does not count).  These differ from ``keep_rules`` on
    purpose: equal pickup/dropoff is allowed, passengers up to 7 are allowed,
    and negative surcharges are counted although no filter removes them."""
    start = _start()
    rules = [
        ("pickup_before_start", _c("tpep_pickup_datetime") < start),
        ("dropoff_before_start", _c("tpep_dropoff_datetime") < start),
        ("dropoff_before_pickup", _c("tpep_dropoff_datetime") < _c("tpep_pickup_datetime")),
        ("passengers_out_of_range", (_c("passenger_count") <= 0) | (_c("passenger_count") > 7)),
        ("distance_not_positive", _c("trip_distance") <= 0),
    ]
    for name in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                 "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount"):
        rules.append((f"negative_{name}", _c(name) < 0))
    return rules
