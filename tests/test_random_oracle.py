"""Adversarial raw rows (nulls, NaN, negative and zero money, boundary minutes
and distances, unknown codes and zones, exact and near duplicates): the Spark
operators against the oracle SQL, run by DuckDB on the same file."""

from __future__ import annotations

import datetime as dt
import random

import duckdb
import pytest

from check_oracle import _rows
from meterline import operators as O
from meterline.oracle import RAW, oracle_queries
from meterline.operators import gold as G
from meterline.plans.silver import clean_trips
from meterline.schema import MONEY_COLUMNS, RAW_SCHEMA
from meterline.sources.fixture import raw_zones
from meterline.sources.zones import sized_zones

NAN = float("nan")


def _money(rnd, nan_ok=True):
    r = rnd.random()
    if r < 0.05:
        return None
    if r < 0.08 and nan_ok:
        return NAN
    if r < 0.12:
        return -round(rnd.uniform(0, 20), 2)
    if r < 0.15:
        return 0.0
    return round(rnd.uniform(0, 60), 2)


def _plausible(rnd):
    """A trip that usually passes every rule (near the edges now and then)."""
    start = dt.datetime(2023, 1, 1) + dt.timedelta(seconds=rnd.randrange(0, 86400 * 400))
    seconds = rnd.choice([210, 10829, rnd.randrange(240, 3 * 3600)])
    fare, tip, tolls = round(rnd.uniform(3, 80), 2), round(rnd.uniform(0, 15), 2), rnd.choice([0.0, 6.94])
    extra, mta, imp = rnd.choice([0.0, 0.5, 1.0]), 0.5, 1.0
    cong, air = rnd.choice([None, 2.5]), rnd.choice([None, 1.25])
    base = round(fare + tolls + tip + extra + mta + (air or 0) + imp + (cong or 0), 2)
    total = rnd.choice([base, base, round(base * 1.02, 2), round(base * 0.975, 2)])
    return (
        rnd.choice([1, 2, 6, 7, None]), start, start + dt.timedelta(seconds=seconds),
        rnd.choice([None, 1, 2, 3]), rnd.choice([0.01, 2.0, 2.01, 150.0, round(rnd.uniform(0.1, 40), rnd.choice([2, 3, 4]))]),
        rnd.choice([None, 1, 2, 5, 99]), rnd.choice([None, 1, 5, 24, 26]), rnd.choice([0, 3, 24, 30]),
        rnd.choice([None, 0, 1, 2, 4]), fare, extra, mta, tip, tolls, imp, total, cong, air,
    )


def _row(rnd):
    if rnd.random() < 0.5:
        return _plausible(rnd)
    start = dt.datetime(2022, 11, 1) + dt.timedelta(seconds=rnd.randrange(0, 86400 * 500))
    seconds = rnd.choice([209, 210, 10829, 10830, 0, -60, rnd.randrange(60, 4 * 3600)])
    fare, extra, mta, tip, tolls, imp, cong, air = (_money(rnd) for _ in range(8))
    parts = [x for x in (fare, tolls, tip, extra, mta, air, imp, cong) if x is not None and x == x]
    base = round(sum(parts), 2)
    total = rnd.choice([base, round(base * 1.02, 2), round(base * 1.05, 2), 0.0, None, -5.0, NAN, 600.0])
    return (
        rnd.choice([1, 2, 6, 7, 3, None]),
        start,
        start + dt.timedelta(seconds=seconds),
        rnd.choice([None, 0, 1, 2, 6, 7, 8]),
        rnd.choice([None, NAN, -1.0, 0.0, 0.01, 2.0, 2.01, 100.0, 100.01, 150.0, 150.01, round(rnd.uniform(0, 40), 2)]),
        rnd.choice([None, 1, 2, 5, 6, 7, 99, 42]),
        rnd.choice([None, 1, 5, 24, 25, 26, 999]),
        rnd.choice([0, 3, 24, 30]),
        rnd.choice([None, 0, 1, 4, 6, 7, 9]),
        fare, extra, mta, tip, tolls, imp, total, cong, air,
    )


@pytest.fixture(scope="module")
def adversarial(spark, tmp_path_factory):
    rnd = random.Random(20261203)
    rows = [_row(rnd) for _ in range(3000)]
    rows += rows[:300]                                           # exact copies
    rows += [r[:9] + (r[9] + 1.0 if r[9] is not None else 1.0,) + r[10:] for r in rows[300:400]]  # key collisions
    path = str(tmp_path_factory.mktemp("adversarial") / "trips")
    spark.createDataFrame(rows, RAW_SCHEMA).repartition(4).write.parquet(path)
    return path


def _spark_queries(raw, zones):
    clean = clean_trips(raw, zones)
    return {
        "clean_trips": clean,
        "gold_trips": G.trip_metrics(clean, "day", ["PUlocationID"]),
        "gold_bucket_week": G.bucket_metrics(clean, "week"),
        "gold_passengers_month": G.passenger_metrics(clean, "month"),
        "period_comparison": G.period_comparison(clean, "week", ["PUlocationID"]),
        "dedup_trips": O.drop_duplicate_trips(raw),
        "duplicate_groups": O.duplicate_groups(raw),
        "rule_violations": O.rule_violations(raw),
        "financial_split": O.financial_split(raw),
        "null_profile": O.null_counts(raw),
        "invalid_zones": O.invalid_zones(raw, zones),
        "consistency_filter": O.consistency_filter(O.add_trip_time(O.cast_columns(O.fill_missing(raw)))),
        "histogram": O.histogram(raw, MONEY_COLUMNS, bins=20),
    }


NAMES = ["clean_trips", "gold_trips", "gold_bucket_week", "gold_passengers_month", "period_comparison",
         "dedup_trips", "duplicate_groups", "rule_violations", "financial_split", "null_profile",
         "invalid_zones", "consistency_filter", "histogram"]


@pytest.mark.parametrize("name", NAMES)
def test_adversarial_rows_match_oracle(spark, small_dir, adversarial, name):
    raw = spark.read.schema(RAW_SCHEMA).parquet(adversarial)
    zones = sized_zones(raw_zones(spark, small_dir))
    df = _spark_queries(raw, zones)[name]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW nation AS SELECT * FROM read_parquet('{small_dir}/nation.parquet')")
    sql = {**oracle_queries(), "gold_bucket_week": None, "gold_passengers_month": None}
    from meterline.oracle import CLEAN_CHAIN, gold_bucket_sql, gold_passengers_sql, with_
    sql["gold_bucket_week"] = with_(*CLEAN_CHAIN) + gold_bucket_sql("week", [])
    sql["gold_passengers_month"] = with_(*CLEAN_CHAIN) + gold_passengers_sql("month", [])
    text = sql[name].replace(RAW, f"trips_raw AS (SELECT * FROM read_parquet('{adversarial}/*.parquet'))")
    cur = con.execute(text)
    ocols, orows = [d[0] for d in cur.description], cur.fetchall()
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    assert len(rows) == len(orows)
    assert sorted(cols) == sorted(ocols)
    assert _rows(cols, rows) == _rows(ocols, orows)


def test_adversarial_rows_exercise_the_rules(spark, small_dir, adversarial):
    raw = spark.read.schema(RAW_SCHEMA).parquet(adversarial)
    zones = sized_zones(raw_zones(spark, small_dir))
    clean = clean_trips(raw, zones)
    n_clean = clean.count()
    assert 800 < n_clean < raw.count() * 0.6
    groups = O.duplicate_groups(raw)
    assert groups.count() >= 300
    # some collisions differ outside the key, so the survivor rule matters
    distinct_rows = raw.distinct().count()
    assert distinct_rows > O.drop_duplicate_trips(raw).count()
    assert clean.filter("PUlocationID IS NULL").count() > 0   # unknown zones reach the clean layer
