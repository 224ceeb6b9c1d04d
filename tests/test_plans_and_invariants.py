"""Plan shapes (pushdown, pruning, partial aggregation, no cartesian joins)
and cross-table invariants."""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from meterline import operators as O
from meterline.operators import gold as G
from meterline.plans.silver import clean_core, clean_trips
from meterline.sources.fixture import raw_zones, staged_raw_trips
from meterline.sources.zones import sized_zones


def _plan(df) -> str:
    spark = df.sparkSession
    old = spark.conf.get("spark.sql.maxMetadataStringLength")
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    try:
        return df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.maxMetadataStringLength", old)


def _inputs(spark, small_dir):
    return staged_raw_trips(spark, small_dir), sized_zones(raw_zones(spark, small_dir))


def test_clean_plan_shape(spark, small_dir):
    raw, zones = _inputs(spark, small_dir)
    plan = _plan(clean_trips(raw, zones))
    # filters reach the Parquet scan
    assert re.search(r"PushedFilters: \[[^\n]*GreaterThan\(trip_distance,0\.0\)[^\n]*ReadSchema", plan)
    assert "LessThanOrEqual(trip_distance,150.0)" in plan
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan
    # dedup combines map-side before its shuffle
    assert "partial_min(" in plan
    # zone lookups are broadcast hash joins, never cartesian
    assert plan.count("BroadcastHashJoin") == 2
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_gold_aggregates_hash_partial(spark, small_dir):
    raw, zones = _inputs(spark, small_dir)
    plan = _plan(G.trip_metrics(clean_trips(raw, zones), "day", ["PUlocationID"]))
    assert "HashAggregate" in plan and "partial_sum(" in plan and "partial_count(" in plan


def test_gold_reads_only_needed_columns_from_clean_table(spark, small_dir, tmp_dir):
    raw, zones = _inputs(spark, small_dir)
    clean_trips(raw, zones).write.parquet(f"{tmp_dir}/clean")
    plan = _plan(G.bucket_metrics(spark.read.parquet(f"{tmp_dir}/clean"), "day", ["PUlocationID"]))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    names = {f.split(":")[0] for f in schema.split(",")}
    assert names == {"PUlocationID", "tpep_pickup_datetime", "trip_distance", "trip_time_minutes",
                     "total_amount", "tip_amount"}
    # one shuffle: partial aggregate -> Exchange -> final aggregate
    for build in (G.trip_metrics, G.bucket_metrics, G.passenger_metrics):
        plan = _plan(build(spark.read.parquet(f"{tmp_dir}/clean"), "day", ["PUlocationID"]))
        assert plan.count("Exchange hashpartitioning") == 1
        assert "SortAggregate" not in plan


def test_profiles_are_single_pass(spark, small_dir):
    raw, _ = _inputs(spark, small_dir)
    for df in (O.rule_violations(raw), O.null_counts(raw), O.financial_split(raw)):
        plan = _plan(df)
        assert plan.count("FileScan") == 1
        assert "hashpartitioning" not in plan


def test_period_comparison_deals_out_aggregates(spark, small_dir):
    raw, zones = _inputs(spark, small_dir)
    plan = _plan(G.period_comparison(clean_trips(raw, zones), "week", ["PUlocationID"]))
    assert "Window" not in plan
    assert "HashAggregate" in plan.split("Generate")[1]  # rows are dealt out after the aggregation


def test_invariants(spark, small_dir):
    raw, zones = _inputs(spark, small_dir)
    clean = clean_trips(raw, zones).cache()
    n = clean.count()
    assert n > 0
    totals = []
    for build in (G.trip_metrics, G.bucket_metrics, G.passenger_metrics):
        agg = build(clean, "day", ["PUlocationID"]).agg(F.sum("total_trips").alias("t"),
                                                        F.sum("total_revenue").alias("r")).first()
        assert agg["t"] == n
        totals.append(round(agg["r"], 2))
    assert len(set(totals)) == 1
    # nothing the clean rules enforce is violated afterwards
    violations = {r["rule"]: r["violations"] for r in O.rule_violations(clean).collect()}
    for rule in ("pickup_before_start", "dropoff_before_start", "dropoff_before_pickup", "distance_not_positive",
                 "negative_fare_amount", "negative_tip_amount", "negative_tolls_amount", "negative_total_amount"):
        assert violations[rule] == 0, rule
    split = {r["financial_status"]: r["trips"] for r in O.financial_split(clean).collect()}
    assert split["inconsistent"] == 0
    assert O.duplicate_groups(clean).count() == 0
    clean.unpersist()


def test_cleaning_idempotent_on_numeric_core(spark, small_dir):
    raw, _ = _inputs(spark, small_dir)
    core = clean_core(raw)
    again = O.validate_financials(O.consistency_filter(core))
    assert again.count() == core.count()
    assert O.drop_duplicate_trips(core.drop("avg_speed")).count() == core.count()


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:4] == ["PUlocationID", "pickup_year", "pickup_month", "pickup_day"]


def test_registry_covers_oracle():
    import __spark_entry__ as entry
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    # The training-data queries, where installed, have tests of their own.
    from meterline.registry import QUERIES
    assert set(QUERIES) <= set(q)
    assert set(QUERIES) - set(o) == {"iqr_approx", "gold_trips_plain"}
    assert len(q) >= 55
