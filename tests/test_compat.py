"""The source pipeline's call sequence, through the compat entry points,
gives the same clean rows and aggregates as the native plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from meterline import compat as C
from meterline.operators import gold as G
from meterline.plans.silver import clean_trips
from meterline.sources.fixture import raw_zones, staged_raw_trips
from meterline.sources.zones import sized_zones


def test_source_call_sequence(spark, small_dir):
    raw = staged_raw_trips(spark, small_dir)
    zone_rows = raw_zones(spark, small_dir).select("LocationID", "zone").collect()
    location_dict = {r["LocationID"]: r["zone"] for r in zone_rows}

    d = C.fill_missing_values(raw)
    d = C.cast_columns(d)
    d = C.add_trip_time(d)
    d = C.apply_consistency_filters(d, list(location_dict))
    d = C.validate_financials(d, tolerance_pct=0.03)
    d = C.drop_duplicate_trips(d)
    d = d.withColumn("avg_speed", F.round(F.when(F.col("trip_time_minutes") != 0,
                                                 F.col("trip_distance") / (F.col("trip_time_minutes") / 60)), 2))
    d = C.map_ratecode_description(d)
    d = C.map_payment_type_description(d)
    d = C.map_vendor_id_description(d)
    d = C.map_location_to_zone(d, "PUlocationID", location_dict)
    d = C.map_location_to_zone(d, "DOlocationID", location_dict)

    native = clean_trips(raw, sized_zones(raw_zones(spark, small_dir)))
    left, right = d.select(*native.columns), native
    assert left.count() == right.count()
    assert left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0

    a = C.aggregated_values(native, time_stamp="day", location_col=["PUlocationID"])
    b = G.trip_metrics(native, "day", ["PUlocationID"])
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    assert C.aggregate_values_by_bucket(native, "month").columns.count("pickup_month") == 1
    assert C.aggregate_values_by_passengers(native, "week").count() > 0
    assert C.remove_outliers_iqr(native, ["trip_distance", "total_amount"]).count() > 0
