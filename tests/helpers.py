"""Builders for hand-written raw trip rows."""

from __future__ import annotations

import datetime as dt

from meterline.schema import RAW_SCHEMA

BASE = dict(
    VendorID=1, tpep_pickup_datetime=dt.datetime(2024, 3, 5, 10, 0, 0),
    tpep_dropoff_datetime=dt.datetime(2024, 3, 5, 10, 20, 0), passenger_count=1, trip_distance=3.0,
    RatecodeID=1, PUlocationID=1, DOlocationID=2, payment_type=1, fare_amount=10.0, extra=1.0,
    mta_tax=0.5, tip_amount=2.0, tolls_amount=0.0, improvement_surcharge=1.0, total_amount=17.0,
    congestion_surcharge=2.5, airport_fee=0.0,
)


def trip(**changes):
    row = dict(BASE)
    row.update(changes)
    return tuple(row[f.name] for f in RAW_SCHEMA.fields)


def raw_frame(spark, rows):
    return spark.createDataFrame(rows, RAW_SCHEMA)


def zones_frame(spark, pairs):
    return spark.createDataFrame(pairs, "LocationID int, zone string")
