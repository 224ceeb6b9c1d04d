"""Streamed cleaning within a watermark, and quartiles from stored sketches."""

from __future__ import annotations

import datetime as dt
import random
import sys

import pytest
from pyspark.sql import functions as F

from meterline.operators import sketches
from meterline.operators.dedup import DEDUP_KEYS
from meterline.operators.quantiles import remove_outliers_iqr
from meterline.plans.layers import MONTH_KEY, read_layer, run_layers
from meterline.plans.silver import valid_trips
from meterline.sources.zones import sized_zones
from meterline.streaming.ingest import ingest
from meterline.streaming.watermark import WatermarkRun, clean_stream, read_outcomes
from tests.helpers import raw_frame, trip, zones_frame

T0 = dt.datetime(2024, 2, 1)


def at(minute, **changes):
    start = T0 + dt.timedelta(minutes=minute)
    return trip(tpep_pickup_datetime=start, tpep_dropoff_datetime=start + dt.timedelta(minutes=20), **changes)


def drop(spark, base, rows):
    raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{base}/landing")
    return ingest(spark, f"{base}/landing", f"{base}/raw", f"{base}/_ingest").sink_path


def outcomes(spark, path):
    return sorted((r["tpep_pickup_datetime"], r["passenger_count"], r["outcome"]) for r in read_outcomes(spark, path).collect())


def test_duplicates_within_the_watermark_equal_the_dedup(spark, tmp_dir):
    rng = random.Random(1)
    drops = [[at(60 * d + rng.randint(0, 50), passenger_count=rng.choice([1, 2, None])) for _ in range(60)] for d in range(3)]
    drops[2].append(at(5000, total_amount=-1.0))  # not valid: in no output
    for rows in drops:
        run = clean_stream(spark, drop(spark, tmp_dir, rows), f"{tmp_dir}/clean", delay="3 hours")
        assert run.kept + run.duplicate + run.late == 60 and run.late == 0
    valid = valid_trips(raw_frame(spark, sum(drops, [])))
    every = read_outcomes(spark, f"{tmp_dir}/clean")
    kept = every.filter("outcome = 'kept'").select(*DEDUP_KEYS)
    assert sorted(map(repr, kept.collect())) == sorted(map(repr, valid.select(*DEDUP_KEYS).distinct().collect()))
    columns = [c for c in valid.columns]
    assert every.select(*columns).exceptAll(valid).count() == valid.exceptAll(every.select(*columns)).count() == 0
    assert clean_stream(spark, f"{tmp_dir}/raw", f"{tmp_dir}/clean", delay="3 hours") == WatermarkRun(f"{tmp_dir}/clean", 0, 0, 0)


def test_late_rows_and_late_copies_go_to_the_side(spark, tmp_dir):
    clean_stream(spark, drop(spark, tmp_dir, [at(0), at(10), at(600)]), f"{tmp_dir}/clean", delay="1 hour")
    run = clean_stream(spark, drop(spark, tmp_dir, [at(0), at(5), at(590), at(600), at(700)]), f"{tmp_dir}/clean", delay="1 hour")
    assert (run.kept, run.duplicate, run.late) == (2, 2, 1)  # 590 is within the hour before 600
    times = {(t - T0).seconds // 60: o for t, _, o in outcomes(spark, f"{tmp_dir}/clean") if o != "kept"}
    assert times == {0: "duplicate", 5: "late", 600: "duplicate"}


def test_a_run_that_died_before_its_side_rows_is_completed(spark, tmp_dir, monkeypatch):
    module = sys.modules["meterline.streaming.watermark"]
    sink = drop(spark, tmp_dir, [at(0), at(0), at(300)])
    with monkeypatch.context() as m:
        placed = module._placed_valid
        calls = []
        m.setattr(module, "_placed_valid", lambda raw: calls.append(1) or (placed(raw) if len(calls) == 1 else 1 / 0))
        with pytest.raises(ZeroDivisionError):
            clean_stream(spark, sink, f"{tmp_dir}/clean")
    run = clean_stream(spark, sink, f"{tmp_dir}/clean")
    assert (run.kept, run.duplicate, run.late) == (2, 1, 0)


def clean_like(spark, n, seed):
    return spark.range(n).select(
        F.concat(F.lit("2024-"), F.lpad((F.col("id") % 12 + 1).cast("string"), 2, "0")).alias("m"),
        F.when(F.col("id") % 50 == 0, None).when(F.col("id") % 51 == 0, float("nan")).otherwise(F.exp(F.randn(seed) * 2)).alias("a"),
        F.floor(F.rand(seed + 1) * 5).cast("double").alias("b"), F.lit(None).cast("double").alias("none"))


@pytest.mark.parametrize("n, k", [(500, 4096), (60000, 256)])
def test_merged_sketches_keep_the_rank_bound(spark, n, k):
    df = spark.createDataFrame(clean_like(spark, n, n).toPandas())
    parts = sketches.sketched(df, ["a", "b"], "m", k)
    assert parts.count() == 24
    found = sketches.quantiles(sketches.merged(parts, "m"), (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0))
    rows = sketches.rank_errors(df, found).collect()
    assert len(rows) == 14 and all(r["rank_error"] <= sketches.rank_bound(k) for r in rows)
    if n <= k:
        assert all(r["rank_error"] == 0 for r in rows)


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("x", None), ("y", float("nan"))], "m string, a double")
    parts = sketches.sketched(df, ["a"], "m")
    assert parts.count() == 0
    assert sketches.rank_errors(df, sketches.quantiles(sketches.merged(parts, "m"))).count() == 0
    out, report = sketches.sequential_iqr(df.withColumnRenamed("a", "trip_distance"), ("trip_distance",))
    assert out.count() == 2 and report.count() == 0


def test_a_rebuilt_month_replaces_its_sketch(spark, tmp_dir):
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    first = [at(k, trip_distance=1.0 + k % 40) for k in range(200)]
    more = [at(60 * 24 * 40 + k, trip_distance=50.0) for k in range(30)] + [at(300 + k, trip_distance=60.0) for k in range(50)]
    for rows in (first, more):
        raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
        run = run_layers(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones, sketch_columns=("trip_distance",))
    parts = read_layer(spark, run, "sketches")
    assert {(r[MONTH_KEY], r["n"]) for r in parts.collect()} == {("2024-02", 250), ("2024-03", 30)}
    found = sketches.quantiles(sketches.merged(parts, MONTH_KEY))
    assert all(r["rank_error"] == 0 for r in sketches.rank_errors(read_layer(spark, run, "clean"), found).collect())


def test_sequential_iqr_agrees_with_the_exact_one_on_small_input(spark):
    rng = random.Random(3)
    rows = [(float(rng.choice([1, 2, 3, 4, 5, 100])), float(rng.randint(5, 60) if rng.random() < 0.95 else 900)) for _ in range(400)]
    df = spark.createDataFrame(rows, "trip_distance double, total_amount double")
    out, report = sketches.sequential_iqr(df)
    assert all(r["rank_error"] == 0 for r in report.collect())
    assert abs(out.count() - remove_outliers_iqr(df).count()) <= 4  # exact quartiles lie between two values
