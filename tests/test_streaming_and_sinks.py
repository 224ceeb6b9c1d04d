"""Incremental ingest: run, re-run, add a file; lineage; layer materialisation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from meterline.schema import RAW_COLUMNS
from meterline.sources.sinks import materialize, table_properties
from meterline.streaming.ingest import ingest, read_ingested
from tests.helpers import raw_frame, trip


def _rows(n, start=0):
    t0 = dt.datetime(2024, 2, 1, 8, 0)
    return [trip(tpep_pickup_datetime=t0 + dt.timedelta(minutes=i), tpep_dropoff_datetime=t0 + dt.timedelta(minutes=i + 15))
            for i in range(start, start + n)]


def test_ingest_exactly_once(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    raw_frame(spark, _rows(30)).coalesce(2).write.parquet(source)
    first = ingest(spark, source, sink, ckpt)
    assert first.rows == 30
    assert read_ingested(spark, sink).count() == 30

    again = ingest(spark, source, sink, ckpt)
    assert again.rows == 0
    assert read_ingested(spark, sink).count() == 30

    raw_frame(spark, _rows(7, start=100)).coalesce(1).write.mode("append").parquet(source)
    third = ingest(spark, source, sink, ckpt)
    assert third.rows == 7
    landed = read_ingested(spark, sink)
    assert landed.count() == 37
    assert landed.select(*RAW_COLUMNS).exceptAll(raw_frame(spark, _rows(30) + _rows(7, start=100))).count() == 0


def test_old_files_and_many_batches_are_not_lost(spark, tmp_dir):
    import glob
    import os
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    raw_frame(spark, _rows(40)).repartition(8).write.parquet(source)
    kept = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    first = ingest(spark, source, sink, ckpt, max_files_per_trigger=1)
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", kept)
    assert (first.rows, first.batches) == (40, len(glob.glob(f"{source}/*.parquet")))
    before = set(glob.glob(f"{source}/*.parquet"))
    raw_frame(spark, _rows(9, start=200)).coalesce(1).write.mode("append").parquet(source)
    for f in set(glob.glob(f"{source}/*.parquet")) - before:
        os.utime(f, (1.6e9, 1.6e9))  # long before the others
    assert ingest(spark, source, sink, ckpt).rows == 9
    assert read_ingested(spark, sink).count() == 49


def test_ingest_files_of_other_schemas(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    raw_frame(spark, _rows(5)).coalesce(1).write.parquet(f"{source}/y1")
    (raw_frame(spark, _rows(6, start=10)).coalesce(1)
     .withColumn("passenger_count", F.col("passenger_count").cast("double"))
     .withColumn("PUlocationID", F.col("PUlocationID").cast("bigint")).write.parquet(f"{source}/y2 [new]"))
    (raw_frame(spark, _rows(7, start=20)).coalesce(1).drop("airport_fee").withColumnRenamed("PUlocationID", "PULocationID")
     .withColumn("fee", F.lit(0.75)).withColumn("note", F.lit(None).cast("string")).write.parquet(f"{source}/y3"))
    assert ingest(spark, source, sink, ckpt).rows == 18
    landed = read_ingested(spark, sink)
    want = raw_frame(spark, _rows(5) + _rows(6, start=10)).unionAll(
        raw_frame(spark, _rows(7, start=20)).withColumn("airport_fee", F.lit(None).cast("double")))
    got = landed.select(*RAW_COLUMNS)
    assert got.schema == want.schema
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
    rescued = {r[0]: r[1] for r in landed.groupBy("_rescued_data").count().collect()}
    assert rescued == {None: 11, '{"fee":0.75}': 7}
    assert landed.filter(F.col("_source_file").contains("/y3/")).count() == 7


def test_ingest_stops_at_a_type_that_cannot_be_cast(spark, tmp_dir):
    import pytest
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    raw_frame(spark, _rows(5)).withColumn("trip_distance", F.array("trip_distance")).write.parquet(source)
    with pytest.raises(Exception, match="trip_distance"):
        ingest(spark, source, sink, ckpt)


def test_ingest_lineage_columns(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    raw_frame(spark, _rows(10)).coalesce(1).write.parquet(source)
    ingest(spark, source, sink, ckpt, max_files_per_trigger=1)
    landed = read_ingested(spark, sink)
    assert landed.columns[-2:] == ["_ingestion_time", "_source_file"]
    stats = landed.agg(F.count_if(F.col("_ingestion_time").isNull()).alias("no_time"),
                       F.count_if(~F.col("_source_file").contains("/landing/")).alias("bad_path")).first()
    assert (stats["no_time"], stats["bad_path"]) == (0, 0)


def test_materialize_with_comment_and_properties(spark, tmp_dir):
    df = raw_frame(spark, _rows(5))
    back = materialize(df, f"{tmp_dir}/clean", name="ml_test_clean", comment="Clean trips.",
                       properties={"quality": "silver"})
    assert back.count() == 5
    assert table_properties(spark, "ml_test_clean").get("quality") == "silver"
    comment = [r for r in spark.sql("DESCRIBE TABLE EXTENDED ml_test_clean").collect() if r[0] == "Comment"]
    assert comment and comment[0][1] == "Clean trips."


def test_materialize_partitioned(spark, tmp_dir):
    df = raw_frame(spark, _rows(5)).withColumn("pickup_year", F.year("tpep_pickup_datetime"))
    back = materialize(df, f"{tmp_dir}/part", name="ml_test_part", partition_by=("pickup_year",))
    assert back.count() == 5
    assert back.filter("pickup_year = 2024").count() == 5


def test_metrics_are_taken_while_batches_are_written(spark, tmp_dir):
    """Equal to the report over the rows, for any number of batches."""
    import pytest

    from meterline.plans.quality import merged_metrics, profile_aggregates, quality_report
    from meterline.plans.silver import clean_trips
    from meterline.sources.zones import sized_zones
    from meterline.streaming.ingest import batch_metrics
    from tests.helpers import zones_frame
    source, sink, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    rows = _rows(20) + [trip(total_amount=0.0, VendorID=None), trip(trip_distance=-1.0, tip_amount=None), trip(tpep_pickup_datetime=None)]
    metrics = profile_aggregates(RAW_COLUMNS)
    raw_frame(spark, rows).repartition(3).write.parquet(source)
    assert ingest(spark, source, sink, ckpt, max_files_per_trigger=1, metrics=metrics).rows == len(rows)
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    raw = raw_frame(spark, rows)
    want = {(r["check_type"], r["item"]): r["value"] for r in quality_report(raw, clean_trips(raw, zones), zones).collect()
            if r["layer"] == "raw" and r["check_type"] != "zones"}
    stored = batch_metrics(spark, sink)
    assert stored.select("batch").distinct().count() >= 2
    assert {(r["check_type"], r["item"]): r["value"] for r in merged_metrics(stored).collect()} == want
    with pytest.raises(Exception):
        batch_metrics(spark, f"{tmp_dir}/none").count()
