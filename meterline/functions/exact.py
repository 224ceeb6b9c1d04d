"""Exact, order-independent metric arithmetic.

A double ``sum`` depends on the order partitions are merged in, so the last
bits (and sometimes the rounded cent) of a metric change from run to run on a
cluster.  Money and minutes in trip data carry at most two decimals, distances
at most four, so they are summed here as whole ten-thousandths in ``bigint``:
exact, independent of partitioning, and pure long arithmetic inside
whole-stage codegen (no per-row BigDecimal).  A sum beyond ``bigint`` raises
an error under Spark's ANSI mode.  Averages divide the exact sum once per
group, and the 2-decimal rounding is HALF_UP on the decimal value.  A group
with a NaN or infinite value gives what the plain double sum gives.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


SCALE = 4  # decimal places kept in sums


def _not_finite(value: Column) -> Column:
    return F.isnan(value - value)


def units(value: Column, scale: int = SCALE) -> Column:
    """Round a value to a whole number of 10^-scale units (bigint)."""
    return F.floor(value.cast("double") * (10 ** scale) + 0.5)


def exact_sum(value: Column, scale: int = SCALE) -> Column:
    """Sum of ``value`` as a double equal to the exact decimal sum."""
    v = value.cast("double")
    return F.coalesce(F.sum(F.when(_not_finite(v), v)),
                      F.sum(F.when(~_not_finite(v), units(v, scale))) / (10 ** scale))


def exact_avg(value: Column, scale: int = SCALE) -> Column:
    """Average over non-null values, from the exact sum."""
    return exact_sum(value, scale) / F.count(value)


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round a double HALF_UP on its decimal value (12 places kept first, so an
    arithmetic artefact such as 2.0049999999999994 rounds like 2.005)."""
    return F.when(_not_finite(value), value).otherwise(
        F.round(value.cast("decimal(38,12)"), digits).cast("double"))


def ratio_pct(part: Column, whole: Column) -> Column:
    """100 * part / whole, 0 when whole is 0 (never divides by zero)."""
    return F.when(whole != 0, 100 * part / whole).otherwise(F.lit(0.0))
