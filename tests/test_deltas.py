"""Layers kept by deltas: equal to a full build on any order of arrival, no
earlier row read or written without need, published as one."""

from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from meterline.operators import key_index
from meterline.operators.gold import bucket_metrics, passenger_metrics, trip_metrics
from meterline.plans import deltas
from meterline.plans.deltas import maintain, open_snapshot, read_clean, read_gold, survivors
from meterline.plans.silver import clean_trips
from meterline.sources.zones import sized_zones
from tests.helpers import raw_frame, trip, zones_frame

BUILDERS = {"gold_trips": trip_metrics, "gold_bucket": bucket_metrics, "gold_passengers": passenger_metrics}
LINEAGE = ("_ingestion_time", "_source_file")


def random_trips(rng, n):
    """Few keys, so most rows share one with rows that differ otherwise."""
    rows = []
    for _ in range(n):
        t0 = dt.datetime(2024, rng.choice([1, 2, 12]), rng.randint(1, 3), rng.randint(0, 2), 0)
        fare = rng.choice([10.0, 10.5, 11.25])
        tip = rng.choice([2.0, 1.0, 3.75])
        rows.append(trip(tpep_pickup_datetime=t0, tpep_dropoff_datetime=t0 + dt.timedelta(minutes=20), passenger_count=rng.choice([1, 2, None]),
                         trip_distance=rng.choice([3.0, 0.8, 12.5]), PUlocationID=rng.choice([1, 2, 9]), payment_type=rng.choice([1, 2]),
                         fare_amount=fare, tip_amount=tip, total_amount=17.0 - 12.0 + fare + tip, VendorID=rng.choice([1, 2])))
    return rows


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def same(spark, snapshot, zones, raw):
    full = clean_trips(raw, zones)
    assert rows_of(read_clean(spark, snapshot, zones).drop(*LINEAGE)) == rows_of(full)
    for table, build in BUILDERS.items():
        want = build(full, snapshot.period, ["PUlocationID"])
        got = read_gold(spark, snapshot, table)
        assert got.columns == want.columns and rows_of(got) == rows_of(want), table


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", kept)


@pytest.fixture(scope="module")
def zones(spark):
    return sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))


@pytest.mark.parametrize("seed, compact_every", [(1, 2)])
def test_any_order_of_arrival_equals_a_full_build(spark, tmp_dir, zones, seed, compact_every):
    rng, all_rows, replaced = random.Random(seed), [], 0
    for size in (60, 90, 40):
        rows = random_trips(rng, size)
        all_rows += rows
        raw_frame(spark, rows).coalesce(2).write.mode("append").parquet(f"{tmp_dir}/landing")
        s = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones, compact_every=compact_every)
        replaced += s.replaced
    same(spark, s, zones, raw_frame(spark, all_rows))
    assert replaced > 5 and (s.base > 0) == (compact_every < 4)
    assert maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones, compact_every=compact_every) == s


def test_no_duplicate_reads_no_survivor(spark, tmp_dir, zones, monkeypatch):
    t0 = dt.datetime(2024, 3, 1)
    rows = lambda a, b: [trip(tpep_pickup_datetime=t0 + dt.timedelta(seconds=i), tpep_dropoff_datetime=t0 + dt.timedelta(seconds=i + 1200))
                         for i in range(a, b)]
    raw_frame(spark, rows(0, 300)).coalesce(1).write.parquet(f"{tmp_dir}/landing")
    maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    raw_frame(spark, rows(300, 340)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    with monkeypatch.context() as m:
        m.setattr(deltas, "survivors", lambda *a: pytest.fail("survivors were read"))
        s = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    assert (s.rows_in, s.added, s.replaced, s.checked) == (40, 40, 0, 0)
    raw_frame(spark, rows(250, 260)).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    s = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    assert (s.rows_in, s.added, s.replaced, s.checked) == (10, 0, 0, 10)


def test_a_run_that_died_is_done_again_and_never_seen(spark, tmp_dir, zones, monkeypatch):
    rng = random.Random(7)
    rows = random_trips(rng, 40)
    raw_frame(spark, rows).coalesce(1).write.parquet(f"{tmp_dir}/landing")
    s = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    before = {t: rows_of(read_gold(spark, s, t)) for t in BUILDERS}
    more = random_trips(rng, 60)
    raw_frame(spark, more).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    written, plain = [], deltas._write
    for stop in ("gold_bucket", "state"):
        def dying(df, s, part, run, *by):
            if part == stop:
                raise RuntimeError("killed")
            written.append(part)
            return plain(df, s, part, run, *by)
        with monkeypatch.context() as m:
            m.setattr(deltas, "_write", dying)
            m.setattr(deltas, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
        now = open_snapshot(spark, f"{tmp_dir}/layers")
        assert now == s and {t: rows_of(read_gold(spark, now, t)) for t in BUILDERS} == before  # all old, none mixed
    same(spark, now, zones, raw_frame(spark, rows))
    assert "gold_passengers" in written
    done = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    same(spark, done, zones, raw_frame(spark, rows + more))
    assert {t: rows_of(read_gold(spark, s, t)) for t in BUILDERS} == before  # an old snapshot stays what it was


def test_changed_zones_start_a_version(spark, tmp_dir, zones):
    rows = random_trips(random.Random(3), 50)
    raw_frame(spark, rows).coalesce(1).write.parquet(f"{tmp_dir}/landing")
    first = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    other = sized_zones(zones_frame(spark, [(1, "Alpha"), (9, "Gamma")]))
    second = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", other)
    assert second.version != first.version
    same(spark, second, other, raw_frame(spark, rows))


def test_nothing_valid(spark, tmp_dir, zones):
    raw_frame(spark, [trip(total_amount=-5.0)] * 3).coalesce(1).write.parquet(f"{tmp_dir}/landing")
    s = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    assert (s.rows_in, s.added) == (0, 0) and survivors(spark, s).count() == 0
    assert all(read_gold(spark, s, t).count() == 0 for t in BUILDERS)
    rows = random_trips(random.Random(4), 20)
    raw_frame(spark, rows).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/landing")
    same(spark, maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones), zones, raw_frame(spark, rows))


def test_values_that_are_not_finite_can_be_taken_back(spark):
    from meterline.operators.partials import SIGN, finished, partial_sums
    row = "PUlocationID string, tpep_pickup_datetime timestamp, trip_distance double, trip_time_minutes int, total_amount double, fare_amount double, tip_amount double, tolls_amount double, passenger_count int"
    t0, nan, inf = dt.datetime(2024, 1, 1), float("nan"), float("inf")
    values = [("A", t0, 1.0, 10, 10.0, 5.0, t, None, 1) for t in (1.5, nan, inf, -inf, None)]
    kept = [values[0], values[4]]
    parts = [spark.createDataFrame(values, row).withColumn(SIGN, F.lit(1)), spark.createDataFrame(values[1:4], row).withColumn(SIGN, F.lit(-1))]
    for table, build in BUILDERS.items():
        for frames, rows in ((parts, kept), (parts[:1], values), (parts[:1] + [parts[0].withColumn(SIGN, F.lit(-1))], [])):
            partials = partial_sums(frames[0], table, "day", ["PUlocationID"])
            for f in frames[1:]:
                partials = partials.unionByName(partial_sums(f, table, "day", ["PUlocationID"]))
            want = build(spark.createDataFrame(rows, row), "day", ["PUlocationID"])
            assert repr(rows_of(finished(partials, table, "day"))) == repr(rows_of(want)), (table, len(rows))  # NaN, too



def test_key_index_has_no_false_negative_and_few_false_positives(spark):
    n = 60000
    keys = spark.range(2 * n).select((F.col("id") % 3).cast("string").alias("m"), F.xxhash64("id").alias("_key"), (F.col("id") < n).alias("known"))
    index = key_index.build(keys.filter("known").select("m", "_key"), "m").withColumn("run", F.lit(0).cast("long"))
    assert index.groupBy("m").agg(F.count("*").alias("n"), F.max("blocks").alias("b")).filter("n != b or b < 5").count() == 0
    hit = key_index.maybe_present(keys, index, "m")
    found = {r["known"]: r["count"] for r in hit.groupBy("known").count().collect()}
    assert found[True] == n and found.get(False, 0) < 0.03 * n
    assert key_index.maybe_present(keys.withColumn("m", F.lit("x")), index, "m").count() == 0


def test_a_run_without_known_keys_writes_its_rows_once(spark, tmp_dir, zones, monkeypatch):
    staged, stage = [], deltas._stage
    monkeypatch.setattr(deltas, "_stage", lambda df, label: staged.append(label) or stage(df, label))
    one, two = (random_trips(random.Random(k), 40) for k in (1, 2))
    raw_frame(spark, one).write.mode("append").parquet(f"{tmp_dir}/landing")
    maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    assert staged == ["new"]
    staged.clear()
    raw_frame(spark, two).write.mode("append").parquet(f"{tmp_dir}/landing")
    snapshot = maintain(spark, f"{tmp_dir}/landing", f"{tmp_dir}/layers", zones)
    assert staged == ["new", "maybe", "rows"]
    same(spark, snapshot, zones, raw_frame(spark, one + two))
