"""Previews and distinct calendar values."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def preview(df: DataFrame, n: int = 20, order_by=None) -> DataFrame:
    """First ``n`` rows in a fixed order (all columns, nulls first, unless
    ``order_by`` is given): a deterministic top-n, run as a per-partition
    top-n merged once (``TakeOrderedAndProject``), not a global sort."""
    keys = list(order_by) if order_by else df.columns
    return df.orderBy(*[F.col(c).asc_nulls_first() for c in keys]).limit(n)


def distinct_months(df: DataFrame, column: str = "tpep_pickup_datetime") -> DataFrame:
    """Months present, ascending (``distinct`` first, then the sort)."""
    return df.select(F.month(column).alias("month")).distinct().orderBy("month")
