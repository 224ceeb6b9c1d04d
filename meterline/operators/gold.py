"""Aggregate tables: trip metrics by location, calendar period, distance band
and passenger count.

One core builds all shapes: calendar keys -> ``groupBy`` on small keys ->
metrics -> labels.  The group keys are low-cardinality (zones x calendar), so
Spark's partial aggregation shrinks every map task to at most one row per
group before the shuffle; a hot zone costs nothing extra.  Labels are applied
after aggregation, to the few result rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions.reuse import per_application
from meterline.functions import (
    calendar_columns, check_period, distance_band, exact_avg, exact_sum, month_label, ratio_pct,
    round_half_up, weekday_label,
)

PICKUP = "tpep_pickup_datetime"


@per_application
def _metric(kind: str, column: str, exact: bool) -> Column:
    value = F.col(column)
    if kind == "sum":
        return exact_sum(value) if exact else F.round(F.sum(value), 2)
    if kind == "avg":
        return round_half_up(exact_avg(value)) if exact else F.round(F.avg(value), 2)
    raise ValueError(kind)


@per_application
def _calendar(period: str) -> dict:
    return calendar_columns(F.col(PICKUP), period)


def _grouped(df: DataFrame, period: str, locations, extra_keys: dict, after_calendar: dict | None = None):
    check_period(period)
    calendar = _calendar(period)
    keyed = df.withColumns({**extra_keys, **calendar, **(after_calendar or {})})
    keys = [*locations, *extra_keys, *calendar, *(after_calendar or {})]
    return keyed.groupBy(*keys), keys


def _labelled(agg: DataFrame, period: str) -> DataFrame:
    out = agg.withColumn("pickup_month", month_label("pickup_month"))
    if period == "day":
        out = out.withColumn("pickup_day", weekday_label("pickup_day"))
    return out


def trip_metrics(df: DataFrame, period: str = "day", locations=(), exact: bool = True) -> DataFrame:
    """Trips, revenue, fare, tips, tolls, average distance and minutes, tip %.

    ``period``: ``day`` (weekday, 1 = Sunday, labelled), ``week`` (ISO week) or
    ``month`` (emitted once).  ``exact`` sums whole cents (reproducible on any
    partitioning); ``exact=False`` is the plain double formula.
    """
    grouped, keys = _grouped(df, period, locations, {})
    agg = grouped.agg(
        F.count(F.lit(1)).alias("total_trips"),
        _metric("sum", "total_amount", exact).alias("total_revenue"),
        _metric("sum", "fare_amount", exact).alias("total_fare"),
        _metric("sum", "tip_amount", exact).alias("total_tips"),
        _metric("sum", "tolls_amount", exact).alias("total_tolls"),
        _metric("avg", "trip_distance", exact).alias("avg_distance"),
        _metric("avg", "trip_time_minutes", exact).alias("avg_trip_time"),
        # tip % from unrounded sums, then rounded
        (_metric("sum", "tip_amount", True) if exact else F.sum("tip_amount")).alias("_tips"),
        (_metric("sum", "total_amount", True) if exact else F.sum("total_amount")).alias("_revenue"),
    )
    pct = ratio_pct(F.col("_tips"), F.col("_revenue"))
    agg = agg.withColumn("tip_percentage", round_half_up(pct) if exact else F.round(pct, 2)).drop("_tips", "_revenue")
    return _labelled(agg, period)


def bucket_metrics(df: DataFrame, period: str = "day", locations=(), exact: bool = True) -> DataFrame:
    """Trips, revenue, average minutes and tips by distance band."""
    grouped, _ = _grouped(df, period, locations, {"distance_bucket": distance_band("trip_distance")})
    agg = grouped.agg(
        F.count(F.lit(1)).alias("total_trips"),
        _metric("sum", "total_amount", exact).alias("total_revenue"),
        _metric("avg", "trip_time_minutes", exact).alias("avg_trip_time"),
        _metric("avg", "tip_amount", exact).alias("avg_tips"),
    )
    return _labelled(agg, period)


def passenger_metrics(df: DataFrame, period: str = "day", locations=(), exact: bool = True,
                      by_hour: bool = False) -> DataFrame:
    """Trips, revenue, average tips and minutes by passenger count; with
    ``by_hour`` also by pickup hour (0-23)."""
    hour = {"pickup_hour": F.hour(F.col(PICKUP))} if by_hour else None
    grouped, _ = _grouped(df, period, locations, {"passenger_count": F.col("passenger_count")}, hour)
    agg = grouped.agg(
        F.count(F.lit(1)).alias("total_trips"),
        _metric("sum", "total_amount", exact).alias("total_revenue"),
        _metric("avg", "tip_amount", exact).alias("avg_tips"),
        _metric("avg", "trip_time_minutes", exact).alias("avg_trip_time"),
    )
    return _labelled(agg, period)


def tip_share(df: DataFrame, keys=("payment_type",)) -> DataFrame:
    """Tips as a percentage of revenue per group (0 when revenue is 0)."""
    agg = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_trips"),
        _metric("sum", "tip_amount", True).alias("total_tips"),
        _metric("sum", "total_amount", True).alias("total_revenue"),
    )
    return agg.withColumn("tip_percentage", round_half_up(ratio_pct(F.col("total_tips"), F.col("total_revenue"))))


def period_comparison(df: DataFrame, period: str = "week", locations=("PUlocationID",)) -> DataFrame:
    """Trips and revenue per calendar week (Monday start) or month, with the
    calendar period right before for the same location and the change in
    percent; both are null when that period has no trips.

    Every aggregated row is dealt out twice, under its own period and as the
    predecessor of the next one, and a second small aggregation brings the two
    together (no window, so no task holds all periods).
    """
    if period not in ("week", "month"):
        raise ValueError(f"Invalid comparison period: {period}")
    start = F.date_trunc(period, F.col(PICKUP)).cast("date").alias("period_start")
    agg = (df.groupBy(*locations, start).agg(
        F.count(F.lit(1)).alias("total_trips"),
        exact_sum(F.col("total_amount")).alias("total_revenue"),
    ))
    following = F.date_add("period_start", 7) if period == "week" else F.add_months("period_start", 1)
    values = ("total_trips", "total_revenue")
    own = F.struct("period_start", *values, *[F.lit(None).alias(f"prev_{c}") for c in values])
    ahead = F.struct(following.alias("period_start"), *[F.lit(None).alias(c) for c in values],
                     *[F.col(c).alias(f"prev_{c}") for c in values])
    dealt = agg.select(*locations, F.inline(F.array(own, ahead)))
    dealt = dealt.filter(F.col("period_start").isNotNull() | F.col("total_trips").isNotNull())
    columns = [*values, *[f"prev_{c}" for c in values]]
    return dealt.groupBy(*locations, "period_start").agg(
        *[F.max(c).alias(c) for c in columns],
    ).filter(F.col("total_trips").isNotNull()).withColumns({
        "trips_change_pct": round_half_up(F.when(
            F.col("prev_total_trips") != 0,
            100 * (F.col("total_trips") - F.col("prev_total_trips")) / F.col("prev_total_trips"))),
        "revenue_change_pct": round_half_up(F.when(
            F.col("prev_total_revenue") != 0,
            100 * (F.col("total_revenue") - F.col("prev_total_revenue")) / F.col("prev_total_revenue"))),
    })
