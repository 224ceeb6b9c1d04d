"""Calendar keys of a pickup timestamp and trip duration in minutes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

PERIODS = ("day", "week", "month")


def period_key(ts: Column, period: str) -> Column:
    """Weekday (1 = Sunday), ISO week of year, or month number.

    ``week`` is the ISO week while year and month stay calendar values, so
    2024-12-30 gives (2024, Dec, week 1); weeks that span a month boundary are
    split.  That is the source's behaviour and is kept.
    """
    if period == "day":
        return F.dayofweek(ts)
    if period == "week":
        return F.weekofyear(ts)
    if period == "month":
        return F.month(ts)
    raise ValueError(f"Invalid stamp: {period}")


def check_period(period: str) -> str:
    if period not in PERIODS:
        raise ValueError(f"Invalid stamp: {period}")
    return period


def calendar_columns(ts: Column, period: str) -> dict[str, Column]:
    """pickup_year, pickup_month and, unless it repeats the month, pickup_<period>."""
    check_period(period)
    cols = {"pickup_year": F.year(ts), "pickup_month": F.month(ts)}
    if period != "month":
        cols[f"pickup_{period}"] = period_key(ts, period)
    return cols


def rounded_minutes(start: Column, end: Column) -> Column:
    """Whole minutes between two timestamps, HALF_UP (210 s -> 4, 209 s -> 3),
    computed in integer arithmetic: no per-row decimal rounding."""
    seconds = F.unix_timestamp(end) - F.unix_timestamp(start)
    half_up = F.when(seconds >= 0, F.floor((seconds + 30) / 60)).otherwise(-F.floor((30 - seconds) / 60))
    return half_up.cast("int")
