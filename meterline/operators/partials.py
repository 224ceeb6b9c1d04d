"""Aggregate tables as sums that can be added and taken back.

A table is kept as partial rows: for each group the signed count of trips and,
for each measure, the signed sum of its whole ten-thousandths and the signed
counts of its finite, NaN and infinite values.  Rows of a new batch come in with
sign +1, rows they replace with sign -1; partials of any number of runs merge by
plain sums of longs, in any order, and the finished table equals the one built
from all rows at once, to the bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions import distance_band, ratio_pct, round_half_up
from meterline.functions.exact import SCALE, units
from meterline.operators.gold import _grouped, _labelled

SIGN = "_sign"

# Finished columns of each table: name, kind, measure.
TABLES = {
    "gold_trips": [("total_revenue", "sum", "total_amount"), ("total_fare", "sum", "fare_amount"), ("total_tips", "sum", "tip_amount"),
                   ("total_tolls", "sum", "tolls_amount"), ("avg_distance", "avg", "trip_distance"),
                   ("avg_trip_time", "avg", "trip_time_minutes"), ("tip_percentage", "pct", "tip_amount")],
    "gold_bucket": [("total_revenue", "sum", "total_amount"), ("avg_trip_time", "avg", "trip_time_minutes"), ("avg_tips", "avg", "tip_amount")],
    "gold_passengers": [("total_revenue", "sum", "total_amount"), ("avg_tips", "avg", "tip_amount"), ("avg_trip_time", "avg", "trip_time_minutes")],
}

_PARTS = ("units", "finite", "nan", "up", "down")


def _extra_keys(table: str) -> dict[str, Column]:
    return {"gold_bucket": {"distance_bucket": distance_band("trip_distance")},
            "gold_passengers": {"passenger_count": F.col("passenger_count")}}.get(table, {})


def measures(table: str) -> list[str]:
    return sorted({m for _, _, m in TABLES[table]} | ({"total_amount"} if table == "gold_trips" else set()))


def partial_columns(table: str) -> list[str]:
    return ["_trips", *(f"{m}_{p}" for m in measures(table) for p in _PARTS)]


def partial_sums(df: DataFrame, table: str, period: str, locations) -> DataFrame:
    """Group keys (unlabelled) and ``partial_columns`` of the signed rows of ``df``."""
    grouped, _ = _grouped(df, period, locations, _extra_keys(table))
    sign = F.col(SIGN).cast("long")
    out = [F.sum(sign).alias("_trips")]
    for m in measures(table):
        v = F.col(m).cast("double")
        finite = v.isNotNull() & ~F.isnan(v - v)
        out.append(F.coalesce(F.sum(F.when(finite, sign * units(v))), F.lit(0)).alias(f"{m}_units"))
        for name, fits in (("finite", finite), ("nan", F.isnan(v)), ("up", v == float("inf")), ("down", v == float("-inf"))):
            out.append(F.sum(F.when(F.coalesce(fits, F.lit(False)), sign).otherwise(0)).alias(f"{m}_{name}"))
    return grouped.agg(*out)


def merged(partials: DataFrame, table: str) -> DataFrame:
    """One partial row for each group that still has trips."""
    columns = partial_columns(table)
    keys = [c for c in partials.columns if c not in columns]
    return partials.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in columns)).filter("_trips > 0")


def _total(m: str) -> Column:
    c = lambda p: F.col(f"{m}_{p}")
    return (F.when((c("nan") > 0) | ((c("up") > 0) & (c("down") > 0)), float("nan")).when(c("up") > 0, float("inf"))
            .when(c("down") > 0, float("-inf")).when(c("finite") > 0, c("units") / (10 ** SCALE)))


def finished(partials: DataFrame, table: str, period: str) -> DataFrame:
    """The aggregate table, as ``operators.gold`` builds it from rows."""
    rows = merged(partials, table)
    keys = [c for c in rows.columns if c not in partial_columns(table)]
    out = [F.col("_trips").alias("total_trips")]
    for name, kind, m in TABLES[table]:
        if kind == "sum":
            value = _total(m)
        elif kind == "avg":
            value = round_half_up(_total(m) / F.nullif(sum((F.col(f"{m}_{p}") for p in _PARTS[2:]), F.col(f"{m}_finite")), F.lit(0)))
        else:
            value = round_half_up(ratio_pct(_total(m), _total("total_amount")))
        out.append(value.alias(name))
    return _labelled(rows.select(*keys, *out), period)
