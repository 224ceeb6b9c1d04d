"""Hand-written edge rows for each semantic trap (FIXTURES.md section 4)."""

from __future__ import annotations

import datetime as dt

import pytest

from meterline import operators as O
from meterline.operators import gold as G
from meterline.plans.silver import clean_core, clean_trips, typed_trips
from meterline.sources.zones import sized_zones
from tests.helpers import raw_frame, trip, zones_frame

T0 = dt.datetime(2024, 3, 5, 10, 0, 0)


def _zones(spark):
    return sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))


def _minutes_kept(spark, seconds):
    row = trip(tpep_dropoff_datetime=T0 + dt.timedelta(seconds=seconds))
    typed = typed_trips(raw_frame(spark, [row]))
    minutes = typed.first()["trip_time_minutes"]
    kept = O.consistency_filter(typed).count()
    return minutes, kept


def test_minutes_round_half_up_then_filter(spark):
    assert _minutes_kept(spark, 210) == (4, 1)
    assert _minutes_kept(spark, 209) == (3, 0)


def test_minutes_upper_bound(spark):
    assert _minutes_kept(spark, 180 * 60 + 29) == (180, 1)
    assert _minutes_kept(spark, 180 * 60 + 30) == (181, 0)


def test_negative_duration_rounds_away_from_zero(spark):
    row = trip(tpep_dropoff_datetime=T0 - dt.timedelta(seconds=210))
    assert typed_trips(raw_frame(spark, [row])).first()["trip_time_minutes"] == -4


def test_nan_money_filled_with_zero(spark):
    df = raw_frame(spark, [trip(fare_amount=float("nan"), tip_amount=None)])
    filled = O.fill_missing(df).first()
    assert filled["fare_amount"] == 0.0 and filled["tip_amount"] == 0.0
    typed = typed_trips(df).first()
    assert typed["fare_amount"] == 0.0 and typed["tip_amount"] == 0.0


def test_fill_leaves_vendor_distance_and_times_null(spark):
    df = raw_frame(spark, [trip(VendorID=None, trip_distance=None, RatecodeID=None, payment_type=None,
                                PUlocationID=None, passenger_count=None)])
    row = O.fill_missing(df).first()
    assert row["VendorID"] is None and row["trip_distance"] is None
    assert (row["RatecodeID"], row["payment_type"], row["PUlocationID"], row["passenger_count"]) == (99, 5, 999, 0)


def test_null_distance_dropped_but_banded_open(spark):
    df = raw_frame(spark, [trip(trip_distance=None)])
    assert O.consistency_filter(typed_trips(df)).count() == 0
    assert O.add_distance_band(df).first()["distance_bucket"] == ">100 miles"


@pytest.mark.parametrize("total, ok", [(None, False), (0.0, False), (-5.0, True)])
def test_money_check_alone(spark, total, ok):
    df = typed_trips(raw_frame(spark, [trip(total_amount=total)]))
    assert O.validate_financials(df).count() == (1 if ok else 0)


def test_negative_total_removed_by_range_rule(spark):
    df = raw_frame(spark, [trip(total_amount=-5.0)])
    assert clean_core(df).count() == 0


@pytest.mark.parametrize("total, ok", [(17.0 * 1.02, True), (17.0 * 0.98, True), (17.0 * 1.04, False),
                                       (17.0 * 0.96, False)])
def test_money_tolerance(spark, total, ok):
    df = typed_trips(raw_frame(spark, [trip(total_amount=total)]))
    assert O.validate_financials(df).count() == (1 if ok else 0)


def test_code_labels_defaults(spark):
    df = raw_frame(spark, [trip(VendorID=None, payment_type=9, RatecodeID=42)])
    row = O.map_codes(typed_trips(df)).first()
    assert row["VendorID"] == "Other"
    assert row["payment_type"] == "Other"
    assert row["RatecodeID"] is None


def test_zone_mapping_and_unknown(spark):
    df = raw_frame(spark, [trip(PUlocationID=999, DOlocationID=7), trip(PUlocationID=1, DOlocationID=None)])
    mapped = O.map_location_to_zone(typed_trips(df), _zones(spark))
    got = sorted((r["PUlocationID"] or "", r["DOlocationID"] or "") for r in mapped.collect())
    assert got == [("", ""), ("Alpha", "")]
    unknown = O.fill_unknown_zones(mapped)
    assert {r["PUlocationID"] for r in unknown.collect()} == {"Unknown", "Alpha"}


def test_iso_week_with_calendar_year(spark):
    df = raw_frame(spark, [trip(tpep_pickup_datetime=dt.datetime(2024, 12, 30, 8, 0),
                                tpep_dropoff_datetime=dt.datetime(2024, 12, 30, 8, 30))])
    row = O.add_calendar_keys(typed_trips(df), "week").first()
    assert (row["pickup_year"], row["pickup_month"], row["pickup_week"]) == (2024, 12, 1)


def test_weekday_names(spark):
    rows = [trip(tpep_pickup_datetime=dt.datetime(2023, 1, 1, 8), tpep_dropoff_datetime=dt.datetime(2023, 1, 1, 9)),
            trip(tpep_pickup_datetime=dt.datetime(2023, 1, 7, 8), tpep_dropoff_datetime=dt.datetime(2023, 1, 7, 9))]
    got = O.label_day(O.add_calendar_keys(typed_trips(raw_frame(spark, rows)), "day"))
    assert sorted(r["pickup_day"] for r in got.collect()) == ["Saturday", "Sunday"]


def test_band_edges(spark):
    rows = [trip(trip_distance=d) for d in (2.0, 2.01, 100.0, 100.01)]
    got = [r["distance_bucket"] for r in O.add_distance_band(raw_frame(spark, rows)).collect()]
    assert sorted(got) == sorted(["0-2 miles", "2-5 miles", "50-100 miles", ">100 miles"])


def test_dedup_collision_keeps_smallest(spark):
    rows = [trip(total_amount=17.0, fare_amount=10.0), trip(total_amount=17.2, fare_amount=10.2)]
    out = O.drop_duplicate_trips(raw_frame(spark, rows)).collect()
    assert len(out) == 1 and out[0]["fare_amount"] == 10.0


def test_dedup_null_passengers_group_together(spark):
    rows = [trip(passenger_count=None), trip(passenger_count=None)]
    assert O.drop_duplicate_trips(raw_frame(spark, rows)).count() == 1
    assert O.duplicate_groups(raw_frame(spark, rows)).first()["dup_count"] == 2


def test_dedup_any_survivor(spark):
    rows = [trip(), trip(), trip(trip_distance=4.0)]
    assert O.drop_duplicate_trips(raw_frame(spark, rows), survivor="any").count() == 2


def test_empty_frame_iqr_unchanged(spark):
    df = raw_frame(spark, [])
    out = O.remove_outliers_iqr(typed_trips(df))
    assert out.count() == 0
    assert O.remove_outliers_iqr(typed_trips(df), exact=False).count() == 0


def test_bad_period_raises(spark):
    df = typed_trips(raw_frame(spark, [trip()]))
    with pytest.raises(ValueError):
        G.trip_metrics(df, "year")
    with pytest.raises(ValueError):
        G.bucket_metrics(df, "year")
    with pytest.raises(ValueError):
        G.passenger_metrics(df, "hour")


def test_month_mode_single_month_column(spark):
    clean = clean_trips(raw_frame(spark, [trip()]), _zones(spark))
    for build in (G.trip_metrics, G.bucket_metrics, G.passenger_metrics):
        out = build(clean, "month", ["PUlocationID"])
        assert out.columns.count("pickup_month") == 1
        assert out.first()["pickup_month"] == "Mar"


def test_duplicate_zone_ids_last_wins(spark):
    zones = sized_zones(zones_frame(spark, [(1, "First"), (2, "Beta"), (1, "Last")]).coalesce(1))
    df = typed_trips(raw_frame(spark, [trip(PUlocationID=1)]))
    out = O.map_location_to_zone(df, zones).collect()
    assert len(out) == 1 and out[0]["PUlocationID"] == "Last"


def test_day_mode_labels_and_tip_percentage(spark):
    clean = clean_trips(raw_frame(spark, [trip(), trip(tpep_pickup_datetime=T0 + dt.timedelta(minutes=1),
                                                       tpep_dropoff_datetime=T0 + dt.timedelta(minutes=21))]),
                        _zones(spark))
    row = G.trip_metrics(clean, "day", ["PUlocationID"]).first()
    assert row["pickup_day"] == "Tuesday" and row["pickup_month"] == "Mar"
    assert row["total_trips"] == 2 and row["total_revenue"] == 34.0
    assert row["tip_percentage"] == round(100 * 4.0 / 34.0, 2)


def test_avg_speed_null_for_zero_minutes(spark):
    df = typed_trips(raw_frame(spark, [trip(tpep_dropoff_datetime=T0 + dt.timedelta(seconds=20))]))
    assert O.add_avg_speed(df).first()["avg_speed"] is None


def test_exact_sums_independent_of_partitioning(spark):
    rows = [trip(tpep_pickup_datetime=T0 + dt.timedelta(minutes=i), tpep_dropoff_datetime=T0 + dt.timedelta(minutes=i + 20),
                 total_amount=17.0, tip_amount=2.0) for i in range(200)]
    clean = clean_trips(raw_frame(spark, rows), _zones(spark))
    one = G.trip_metrics(clean.coalesce(1), "month").first()
    many = G.trip_metrics(clean.repartition(16), "month").first()
    assert one == many and one["total_revenue"] == 3400.0


def test_period_filter_is_strict(spark):
    rows = [trip(tpep_pickup_datetime=dt.datetime(2024, 1, 1, 0, 0, 0)),
            trip(tpep_pickup_datetime=dt.datetime(2024, 1, 1, 0, 0, 1))]
    assert O.period_filter(raw_frame(spark, rows)).count() == 1


def test_optional_rules(spark):
    rows = [trip(passenger_count=0), trip(passenger_count=7), trip(VendorID=3), trip(PUlocationID=5), trip()]
    typed = typed_trips(raw_frame(spark, rows))
    assert O.consistency_filter(typed).count() == 5
    assert O.consistency_filter(typed, passengers=True).count() == 3
    assert O.consistency_filter(typed, vendors=True).count() == 4
    assert O.consistency_filter(typed, zones=_zones(spark)).count() == 4


def test_invalid_zone_count_null_safe(spark):
    rows = [trip(PUlocationID=None), trip(DOlocationID=9), trip()]
    assert O.invalid_zone_count(raw_frame(spark, rows), _zones(spark)).first()["invalid_zones"] == 2


def test_rule_violations_count_true_only(spark):
    rows = [trip(passenger_count=None), trip(passenger_count=8), trip(extra=-1.0),
            trip(tpep_dropoff_datetime=T0)]
    got = {r["rule"]: r["violations"] for r in O.rule_violations(raw_frame(spark, rows)).collect()}
    assert len(got) == 14
    assert got["passengers_out_of_range"] == 1
    assert got["negative_extra"] == 1
    assert got["dropoff_before_pickup"] == 0  # equal times are not a violation here


def test_financial_split_labels(spark):
    rows = [trip(), trip(total_amount=0.0), trip(congestion_surcharge=None)]
    got = {r["financial_status"]: r["trips"] for r in O.financial_split(raw_frame(spark, rows)).collect()}
    assert got == {"consistent": 1, "inconsistent": 2, "total": 3}


def test_hot_dedup_key_third_of_rows(spark):
    """One trip key holds a third of all rows: the result is whole and exact."""
    hot = [trip() for _ in range(3000)]
    cold = [trip(tpep_pickup_datetime=T0 + dt.timedelta(seconds=i), tpep_dropoff_datetime=T0 + dt.timedelta(minutes=20, seconds=i))
            for i in range(1, 6001)]
    df = raw_frame(spark, hot + cold).repartition(12)
    assert O.drop_duplicate_trips(df).count() == 6001
    groups = O.duplicate_groups(df).collect()
    assert len(groups) == 1 and groups[0]["dup_count"] == 3000


def test_describe_nan_mean(spark):
    rows = {r["column_name"]: r for r in O.describe_columns(raw_frame(spark, [trip(), trip(fare_amount=float("nan"))]),
                                                              ("fare_amount", "tip_amount")).collect()}
    assert rows["fare_amount"]["mean"] != rows["fare_amount"]["mean"]  # NaN
    assert rows["tip_amount"]["mean"] == 2.0 and rows["tip_amount"]["count"] == 2
