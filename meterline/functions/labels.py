"""Code dictionaries of the trip data, as CASE WHEN column expressions.

Labels are built after aggregation or per row with plain ``when`` chains, so
they stay inside whole-stage codegen and need no lookup table or UDF.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from meterline.functions.reuse import per_application

# ---------------------------------------------------------------------------
# These labels, codes and band edges must equal the source's
# data dictionary exactly, in this order.
RATECODE_LABELS = {
    1: "Standard rate",
    2: "JFK",
    3: "Newark",
    4: "Nassau or Westchester",
    5: "Negotiated fare",
    6: "Group ride",
    99: "Null/Unknown",
}
RATECODE_DEFAULT = None

PAYMENT_LABELS = {
    0: "Flex Fare trip",
    1: "Credit card",
    2: "Cash",
    3: "No charge",
    4: "Dispute",
    5: "Unknown",
    6: "Voided trip",
}
PAYMENT_DEFAULT = "Other"

VENDOR_LABELS = {
    1: "Creative Mobile Technologies, LLC",
    2: "Curb Mobility, LLC",
    6: "Myle Technologies Inc",
    7: "Helix",
}
VENDOR_DEFAULT = "Other"

MONTH_LABELS = {
    1: "Jan", 2: "Feb", 3: "Mar", 4: "Apr", 5: "May", 6: "Jun",
    7: "Jul", 8: "Aug", 9: "Sep", 10: "Oct", 11: "Nov", 12: "Dec",
}
WEEKDAY_LABELS = {  # Spark dayofweek: 1 = Sunday
    1: "Sunday", 2: "Monday", 3: "Tuesday", 4: "Wednesday",
    5: "Thursday", 6: "Friday", 7: "Saturday",
}
CALENDAR_DEFAULT = "N/A"

# Upper edge (inclusive, miles) and label of each distance band; anything
# above the last edge, or null, falls in the open band.
DISTANCE_BANDS = (
    (2, "0-2 miles"),
    (5, "2-5 miles"),
    (10, "5-10 miles"),
    (25, "10-25 miles"),
    (50, "25-50 miles"),
    (100, "50-100 miles"),
)
DISTANCE_OPEN_BAND = ">100 miles"

UNKNOWN_ZONE = "Unknown"
# ---------------------------------------------------------------------------


def code_label(code: Column, labels: dict, default: str | None = None) -> Column:
    """CASE code WHEN k THEN label ... ELSE default END."""
    expr = None
    for key, label in labels.items():
        expr = F.when(code == key, label) if expr is None else expr.when(code == key, label)
    return expr.otherwise(F.lit(default).cast("string"))


# The label columns below take the NAME of the code column and are built once
# per application (see ``functions.reuse``).

@per_application
def ratecode_label(column: str = "RatecodeID") -> Column:
    return code_label(F.col(column), RATECODE_LABELS, RATECODE_DEFAULT)


@per_application
def payment_label(column: str = "payment_type") -> Column:
    return code_label(F.col(column), PAYMENT_LABELS, PAYMENT_DEFAULT)


@per_application
def vendor_label(column: str = "VendorID") -> Column:
    return code_label(F.col(column), VENDOR_LABELS, VENDOR_DEFAULT)


@per_application
def month_label(column: str = "pickup_month") -> Column:
    return code_label(F.col(column), MONTH_LABELS, CALENDAR_DEFAULT)


@per_application
def weekday_label(column: str = "pickup_day") -> Column:
    return code_label(F.col(column), WEEKDAY_LABELS, CALENDAR_DEFAULT)


@per_application
def distance_band(column: str = "trip_distance") -> Column:
    distance = F.col(column)
    expr = None
    for edge, label in DISTANCE_BANDS:
        expr = F.when(distance <= edge, label) if expr is None else expr.when(distance <= edge, label)
    return expr.otherwise(DISTANCE_OPEN_BAND)
