"""The layered job: full build, incremental month rebuilds equal a full rebuild."""

from __future__ import annotations

import datetime as dt

from meterline.plans.layers import read_layer, run_layers
from meterline.sources.zones import sized_zones
from tests.helpers import raw_frame, trip, zones_frame


def _trips(month, n, start=0):
    t0 = dt.datetime(2024, month, 3, 8, 0)
    return [trip(tpep_pickup_datetime=t0 + dt.timedelta(minutes=7 * i), tpep_dropoff_datetime=t0 + dt.timedelta(minutes=7 * i + 20),
                 PUlocationID=1 + i % 2, total_amount=17.0 + (i % 3), fare_amount=10.0 + (i % 3))
            for i in range(start, start + n)]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_incremental_equals_full(spark, tmp_dir):
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    landing = f"{tmp_dir}/landing"
    raw_frame(spark, _trips(1, 40) + _trips(2, 30)).coalesce(1).write.parquet(landing)
    first = run_layers(spark, landing, f"{tmp_dir}/inc", zones)
    assert first.months is None and first.ingest.rows == 70

    # new files: more February (including exact copies of old rows) and March
    raw_frame(spark, _trips(2, 10, start=25) + _trips(3, 12)).coalesce(1).write.mode("append").parquet(landing)
    second = run_layers(spark, landing, f"{tmp_dir}/inc", zones)
    assert second.months == ["2024-02", "2024-03"]
    assert second.ingest.rows == 22

    again = run_layers(spark, landing, f"{tmp_dir}/inc", zones)
    assert again.months == [] and again.ingest.rows == 0

    full = run_layers(spark, landing, f"{tmp_dir}/full", zones, incremental=False)
    for layer in ("clean", "gold_trips", "gold_bucket", "gold_passengers"):
        inc_rows = read_layer(spark, second, layer)
        full_rows = read_layer(spark, full, layer)
        if layer == "clean":
            inc_rows, full_rows = inc_rows.drop("_ingestion_time", "_source_file"), full_rows.drop("_ingestion_time", "_source_file")
        assert _rows(inc_rows) == _rows(full_rows), layer
    assert read_layer(spark, second, "clean").count() == 40 + 35 + 12  # 5 February rows were copies


def test_killed_full_build_leaves_the_old_version(spark, tmp_dir, monkeypatch):
    import pytest
    from meterline.plans import layers
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    landing, root = f"{tmp_dir}/landing", f"{tmp_dir}/inc"
    raw_frame(spark, _trips(1, 40) + _trips(2, 30)).coalesce(1).write.parquet(landing)
    first = run_layers(spark, landing, root, zones)
    want = _rows(read_layer(spark, first, "gold_trips"))
    write = layers._write
    for survives in range(4):  # dies at the first, second, ... write
        left = [survives]

        def dying(*a, **k):
            if left[0] == 0:
                raise RuntimeError("killed")
            left[0] -= 1
            write(*a, **k)
        monkeypatch.setattr(layers, "_write", dying)
        with pytest.raises(RuntimeError):
            run_layers(spark, landing, root, zones, incremental=False)
        monkeypatch.setattr(layers, "_write", write)
        after = run_layers(spark, landing, root, zones)
        assert after.months == [] and after.paths == first.paths
        assert _rows(read_layer(spark, after, "gold_trips")) == want and read_layer(spark, after, "clean").count() == 70


def test_readers_of_an_incremental_run_see_old_or_new_never_both(spark, tmp_dir, monkeypatch):
    """Killed before each write and before the state row: a reader finds every
    layer as it was; done at last, every layer as a full build makes it."""
    import pytest
    from meterline.plans import layers
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    landing, root = f"{tmp_dir}/landing", f"{tmp_dir}/inc"
    names = ("clean", "gold_trips", "gold_bucket", "gold_passengers")
    assert layers.open_layers(spark, root) is None
    raw_frame(spark, _trips(1, 20) + _trips(2, 15)).coalesce(1).write.parquet(landing)
    run_layers(spark, landing, root, zones)
    seen = lambda: {n: _rows(read_layer(spark, layers.open_layers(spark, root), n).drop("_ingestion_time")) for n in names}
    old = seen()
    early = layers.open_layers(spark, root)
    raw_frame(spark, _trips(2, 10, start=10) + _trips(3, 12)).coalesce(1).write.mode("append").parquet(landing)
    write = layers._write
    for survives in (0, 1, 3, 4):
        left = [survives]

        def dying(*a, **k):
            if left[0] == 0:
                raise RuntimeError("killed")
            left[0] -= 1
            write(*a, **k)
        with monkeypatch.context() as m:
            m.setattr(layers, "_write", dying)
            m.setattr(layers, "_append_state", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
            with pytest.raises(RuntimeError):
                run_layers(spark, landing, root, zones)
        assert seen() == old
    done = run_layers(spark, landing, root, zones)
    assert done.months == ["2024-02", "2024-03"] and done.held_by == {"2024-01": 0, "2024-02": 1, "2024-03": 1}
    new = seen()
    full = run_layers(spark, landing, f"{tmp_dir}/full", zones, incremental=False)
    for n in names[1:]:
        assert new[n] == _rows(read_layer(spark, full, n))
    assert len(new["clean"]) == 20 + 20 + 12
    # a reader who opened the layers before still finds what there was then
    assert {n: _rows(read_layer(spark, early, n).drop("_ingestion_time")) for n in names} == old


def test_changed_zones_and_period_rebuild_everything(spark, tmp_dir):
    landing, root = f"{tmp_dir}/landing", f"{tmp_dir}/inc"
    raw_frame(spark, _trips(1, 40)).coalesce(1).write.parquet(landing)
    run_layers(spark, landing, root, sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")])))
    renamed = sized_zones(zones_frame(spark, [(1, "Gamma"), (2, "Beta")]))
    second = run_layers(spark, landing, root, renamed)
    assert second.months is None
    assert not any("Alpha" in map(str, r) for r in read_layer(spark, second, "clean").collect())
    third = run_layers(spark, landing, root, renamed, period="week")
    assert third.months is None and "pickup_week" in read_layer(spark, third, "gold_trips").columns


def test_only_invalid_rows_give_empty_layers(spark, tmp_dir):
    landing = f"{tmp_dir}/landing"
    rows = [trip(total_amount=-5.0, trip_distance=-1.0) for _ in range(5)]
    raw_frame(spark, rows).coalesce(1).write.parquet(landing)
    run = run_layers(spark, landing, f"{tmp_dir}/inc", sized_zones(zones_frame(spark, [(1, "Alpha")])))
    assert run.ingest.rows == 5
    for layer in ("clean", "gold_trips", "gold_bucket", "gold_passengers"):
        assert read_layer(spark, run, layer).count() == 0


def test_run_dying_after_ingest_loses_nothing(spark, tmp_dir):
    from meterline.streaming.ingest import ingest
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    landing, root = f"{tmp_dir}/landing", f"{tmp_dir}/inc"
    raw_frame(spark, _trips(1, 30)).coalesce(1).write.parquet(landing)
    run_layers(spark, landing, root, zones)
    raw_frame(spark, _trips(4, 15)).coalesce(1).write.mode("append").parquet(landing)
    # a run that ingests the new file and then dies before rebuilding any layer
    assert ingest(spark, landing, f"{root}/raw", f"{root}/_checkpoints/raw").rows == 15
    resumed = run_layers(spark, landing, root, zones)
    assert resumed.ingest.rows == 0 and resumed.months == ["2024-04"]
    assert read_layer(spark, resumed, "clean").count() == 45
    assert run_layers(spark, landing, root, zones).months == []


def test_layer_tables_registered(spark, tmp_dir):
    from meterline.sources.sinks import table_properties
    zones = sized_zones(zones_frame(spark, [(1, "Alpha"), (2, "Beta")]))
    landing = f"{tmp_dir}/landing"
    raw_frame(spark, _trips(5, 12)).coalesce(1).write.parquet(landing)
    run_layers(spark, landing, f"{tmp_dir}/t", zones, table_prefix="ml_layers")
    expected = {"raw": "bronze", "clean": "silver", "gold_trips": "gold", "gold_bucket": "gold",
                "gold_passengers": "gold"}
    for layer, quality in expected.items():
        assert table_properties(spark, f"ml_layers_{layer}").get("quality") == quality
    assert spark.table("ml_layers_clean").count() == 12
    assert spark.table("ml_layers_gold_trips").filter("pickup_ym = '2024-05'").count() > 0
    # months that a later run holds are not read twice
    raw_frame(spark, _trips(5, 3, start=10)).coalesce(1).write.mode("append").parquet(landing)
    run_layers(spark, landing, f"{tmp_dir}/t", zones, table_prefix="ml_layers")
    assert spark.table("ml_layers_clean").count() == 13
    assert spark.table("ml_layers_raw").columns[-3:] == ["_ingestion_time", "_source_file", "ingest_batch"]


def test_month_ranges_wrap_years_and_merge_runs(spark):
    from pyspark.sql import functions as F
    from meterline.plans.layers import _next_month, in_months
    assert _next_month("2024-12") == "2025-01" and _next_month("2024-01") == "2024-02"
    stamps = [dt.datetime(2024, 11, 30, 23, 59, 59), dt.datetime(2024, 12, 15), dt.datetime(2025, 1, 31, 23, 59, 59),
              dt.datetime(2025, 2, 1), dt.datetime(2025, 4, 1), dt.datetime(2025, 3, 31, 12)]
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = [r["ts"] for r in df.filter(in_months(F.col("ts"), ["2025-01", "2024-12", "2025-04"])).orderBy("ts").collect()]
    assert got == [dt.datetime(2024, 12, 15), dt.datetime(2025, 1, 31, 23, 59, 59), dt.datetime(2025, 4, 1)]
