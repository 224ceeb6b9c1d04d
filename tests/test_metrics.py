"""Sums beyond two decimals, values that are not finite, and comparison across
periods without trips."""

from __future__ import annotations

import datetime as dt
import math

from pyspark.sql import functions as F

from meterline.functions import exact_avg, exact_sum, round_half_up
from meterline.operators import gold as G
from meterline.plans.silver import clean_trips, valid_trips
from meterline.schema import RAW_SCHEMA
from meterline.sources.fixture import raw_zones, staged_raw_trips
from meterline.sources.zones import sized_zones


def test_sums_keep_small_values(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("v"))
    row = df.agg(exact_sum(F.col("v")).alias("s"), exact_avg(F.col("v")).alias("a")).first()
    assert (row["s"], row["a"]) == (4.0, 0.004)


def test_sums_pass_on_nan_and_infinity(spark):
    df = spark.createDataFrame(
        [("nan", 1.0), ("nan", math.nan), ("nan", 3.0), ("inf", 1.0), ("inf", math.inf), ("null", None), ("ok", 2.5)],
        "k string, v double")
    v = F.col("v")
    rows = {r["k"]: r for r in df.groupBy("k").agg(
        exact_sum(v).alias("s"), round_half_up(exact_avg(v)).alias("a")).collect()}
    assert math.isnan(rows["nan"]["s"]) and math.isnan(rows["nan"]["a"])
    assert rows["inf"]["s"] == math.inf and rows["inf"]["a"] == math.inf
    assert rows["null"]["s"] is None and rows["null"]["a"] is None
    assert (rows["ok"]["s"], rows["ok"]["a"]) == (2.5, 2.5)


def test_comparison_leaves_gaps_empty(spark):
    def trip(zone, day, total):
        return (zone, dt.datetime.fromisoformat(day), total)
    df = spark.createDataFrame(
        [trip("a", "2024-01-01", 10.0), trip("a", "2024-01-08", 20.0), trip("a", "2024-01-22", 30.0),
         trip(None, "2024-01-09", 5.0), trip(None, "2024-01-16", 10.0), trip("a", "2023-12-31", 1.0)],
        "PUlocationID string, tpep_pickup_datetime timestamp, total_amount double")
    found = {(r["PUlocationID"], r["period_start"].isoformat()): (r["prev_total_revenue"], r["revenue_change_pct"])
             for r in G.period_comparison(df, "week").collect()}
    assert found == {
        ("a", "2023-12-25"): (None, None), ("a", "2024-01-01"): (1.0, 900.0), ("a", "2024-01-08"): (10.0, 100.0),
        ("a", "2024-01-22"): (None, None), (None, "2024-01-08"): (None, None), (None, "2024-01-15"): (5.0, 100.0)}
    months = {r["period_start"].isoformat(): r["prev_total_trips"] for r in G.period_comparison(df, "month", []).collect()}
    assert months == {"2023-12-01": None, "2024-01-01": 1}


def test_comparison_has_no_single_partition(spark, small_dir):
    plan = G.period_comparison(clean_trips(staged_raw_trips(spark, small_dir), sized_zones(raw_zones(spark, small_dir))),
                               "month", [])._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan and "Window" not in plan


def test_code_and_total_rules_reach_the_scan(spark, small_dir):
    spark.conf.set("spark.sql.maxMetadataStringLength", "4000")
    try:
        plan = valid_trips(staged_raw_trips(spark, small_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scan = next(line for line in plan.splitlines() if "PushedFilters" in line)
    pushed = scan[scan.index("PushedFilters"):scan.index("ReadSchema")]
    assert all(c in pushed for c in ("In(RatecodeID", "In(payment_type", "LessThanOrEqual(total_amount")), pushed


def test_scan_rules_drop_no_valid_row(spark):
    """Missing codes and NaN or missing fares pass, in both integer and double files."""
    start, end = dt.datetime(2024, 3, 1, 8), dt.datetime(2024, 3, 1, 8, 20)

    def row(rate, payment, fare, total):
        return (1, start, end, 1, 2.0, rate, 1, 2, payment, fare, 0.0, 0.0, total, 0.0, 0.0, total, 0.0, 0.0)
    df = spark.createDataFrame(
        [row(None, None, math.nan, 10.0), row(1, 4, None, 11.0), row(7, 1, 0.0, 12.0), row(99, 9, 0.0, 13.0),
         row(5, 0, 0.0, math.nan), row(5, 0, 0.0, None), row(6, 6, 0.0, 500.0), row(6, 6, 0.0, 501.0)], RAW_SCHEMA)
    double = df.withColumn("RatecodeID", F.col("RatecodeID").cast("double"))
    for frame in (df, double):
        assert sorted(r["total_amount"] for r in valid_trips(frame).collect()) == [10.0, 11.0, 500.0]
