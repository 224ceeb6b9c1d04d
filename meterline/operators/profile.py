"""Data-quality profile: null counts, time range, rule violations, money
check split, money summaries, histograms, row counts.

Each profile is ONE aggregation pass (``count_if`` per check) reshaped to a
long table, instead of one Spark job per check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.functions import exact_avg, round_half_up
from meterline.operators.rules import money_consistent, violation_rules
from meterline.schema import MONEY_COLUMNS

# Labels of the money-check split.
CONSISTENT, INCONSISTENT = "consistent", "inconsistent"


def _long(wide: DataFrame, name_col: str, value_col: str) -> DataFrame:
    """One-row wide frame -> (name, value) rows, in column order."""
    return wide.unpivot([], wide.columns, name_col, value_col)


def null_counts(df: DataFrame) -> DataFrame:
    """(column, nulls) for every column, one pass.  NaN is not null."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _long(wide, "column_name", "nulls")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def time_range(df: DataFrame, column: str = "tpep_pickup_datetime") -> DataFrame:
    return df.agg(F.min(column).alias("initial_pickup_datetime"),
                  F.max(column).alias("final_pickup_datetime"))


def rule_violations(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """(rule, violations): rows for which each check is true, one pass."""
    rules = violation_rules() if rules is None else rules
    wide = df.agg(*[F.count_if(pred).alias(name) for name, pred in rules])
    return _long(wide, "rule", "violations")


def financial_split(df: DataFrame, tolerance: float | None = None) -> DataFrame:
    """(financial_status, trips): rows passing / failing the money check, and
    the total, on the frame as given (a null component fails the check)."""
    ok = money_consistent() if tolerance is None else money_consistent(tolerance)
    wide = df.agg(F.count_if(ok).alias(CONSISTENT),
                  F.count_if(~ok).alias(INCONSISTENT),
                  F.count(F.lit(1)).alias("total"))
    return _long(wide, "financial_status", "trips")


def describe_columns(df: DataFrame, columns=MONEY_COLUMNS, digits: int = 4) -> DataFrame:
    """(column, count, mean, stddev, min, max) as typed values, one pass.

    ``count`` counts non-null values; mean is exact (cents) and rounded to
    ``digits``, stddev is the sample deviation rounded to ``digits``.  A NaN
    in a column makes its mean NaN, as in plain arithmetic.
    """
    aggs = []
    for c in columns:
        v = F.col(c)
        mean = F.when(F.count_if(F.isnan(v)) > 0, F.lit(float("nan"))).otherwise(
            round_half_up(exact_avg(v), digits))
        aggs += [F.count(v).alias(f"{c}__count"),
                 mean.alias(f"{c}__mean"),
                 round_half_up(F.stddev_samp(v), digits).alias(f"{c}__stddev"),
                 F.min(v).alias(f"{c}__min"), F.max(v).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").alias("count"),
                     F.col(f"{c}__mean").alias("mean"),
                     F.col(f"{c}__stddev").alias("stddev"),
                     F.col(f"{c}__min").cast("double").alias("min"),
                     F.col(f"{c}__max").cast("double").alias("max")) for c in columns]
    return wide.select(F.inline(F.array(*rows)))


def histogram(df: DataFrame, columns=MONEY_COLUMNS, bins: int = 20) -> DataFrame:
    """Equal-width histogram per column over its own [min, max].

    Pass 1 fetches 2 numbers per column (a bounded driver round trip); pass 2
    is one count per bin over all columns at once, combined map-side, keyed by
    one int (column number and bin).  Names and edges are attached to the few
    result rows.  Rows: (column, bin, bin_low, bin_high, trips); nulls and NaN
    are not counted; the top edge falls in the last bin.
    """
    bounds = df.agg(*[F.min(F.when(~F.isnan(c), F.col(c))).alias(f"{c}__lo") for c in columns],
                    *[F.max(F.when(~F.isnan(c), F.col(c))).alias(f"{c}__hi") for c in columns]).first()
    names, lows, widths, codes = [], [], [], []
    for c in columns:
        lo, hi = bounds[f"{c}__lo"], bounds[f"{c}__hi"]
        if lo is None:
            continue
        lo, hi = float(lo), float(hi)
        v = F.col(c).cast("double")
        if hi > lo:
            b = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
        else:
            b = F.lit(0).cast("bigint")
        b = F.when(v.isNotNull() & ~F.isnan(v), b + len(names) * bins)
        codes.append(b.cast("int"))
        names.append(c)
        lows.append(lo)
        widths.append((hi - lo) / bins)
    if not names:
        return df.sparkSession.createDataFrame([], "column_name string, bin int, bin_low double, bin_high double, trips bigint")
    counted = (df.select(F.explode(F.array(*codes)).alias("code")).filter(F.col("code").isNotNull())
               .groupBy("code").agg(F.count(F.lit(1)).alias("trips")))
    place = F.floor(F.col("code") / bins).cast("int") + 1
    name, lo, width = (F.element_at(F.array(*map(F.lit, x)), place) for x in (names, lows, widths))
    bin_ = F.col("code") % bins
    return counted.select(name.alias("column_name"), bin_.alias("bin"), (lo + bin_ * width).alias("bin_low"),
                          (lo + (bin_ + 1) * width).alias("bin_high"), "trips")
