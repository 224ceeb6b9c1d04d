"""dBASE attribute files as a data source: round trip, ranges, damaged files."""

from __future__ import annotations

import datetime as dt
import glob
import struct

import pytest
from pyspark.sql import functions as F

from meterline.sources.dbf import DbfDataSource, read_layout
from meterline.sources.zones import zone_dimension


@pytest.fixture(scope="module", autouse=True)
def registered(spark):
    spark.dataSource.register(DbfDataSource)


def by_hand(path, rows, deleted=(), promised=None):
    """A file of (N 4, C 6, F 6.2, L, D) as other programs write them."""
    fields = [(b"LocationID", b"N", 4, 0), (b"zone", b"C", 6, 0), (b"area", b"N", 6, 2), (b"airport", b"L", 1, 0), (b"since", b"D", 8, 0)]
    width = 1 + sum(f[2] for f in fields)
    head = struct.pack("<BBBBIHH20x", 3, 124, 1, 1, len(rows) if promised is None else promised, 32 + 32 * len(fields) + 1, width)
    body = b"".join((b"*" if k in deleted else b" ") + b"".join(v.rjust(f[2]) if f[1] == b"N" else v.ljust(f[2]) for v, f in zip(r, fields))
                    for k, r in enumerate(rows))
    open(path, "wb").write(head + b"".join(struct.pack("<11sc4xBB14x", *f) for f in fields) + b"\r" + body + b"\x1a")


ROWS = [(b"1", b"Alpha", b"1.25", b"T", b"20240131"), (b"2", b"", b"", b"?", b""), (b"3", b"B\xc3\xa9ta", b"-3", b"n", b"19991231"),
        (b"****", b"x", b"0.5", b"f", b"20200229"), (b"1", b"Last", b"2", b"Y", b"20240201")]


def test_types_nulls_and_deleted_records(spark, tmp_dir):
    by_hand(f"{tmp_dir}/z.dbf", ROWS, deleted=(3,))
    df = spark.read.format("dbf").load(f"{tmp_dir}/z.dbf")
    assert df.schema.simpleString() == "struct<LocationID:bigint,zone:string,area:double,airport:boolean,since:date>"
    assert sorted(map(tuple, df.collect()), key=repr) == sorted([
        (1, "Alpha", 1.25, True, dt.date(2024, 1, 31)), (2, None, None, None, None), (3, "Béta", -3.0, False, dt.date(1999, 12, 31)),
        (1, "Last", 2.0, True, dt.date(2024, 2, 1))], key=repr)
    zones = spark.read.format("dbf").option("position", True).load(f"file://{tmp_dir}/z.dbf")
    zones = zones.withColumn("_pos", F.struct("_file", "_record"))
    assert {tuple(r) for r in zone_dimension(zones).collect()} == {(1, "Last"), (2, None), (3, "Béta")}


@pytest.mark.parametrize("per_task", [1, 3, 100])
def test_ranges_read_every_record_once(spark, tmp_dir, per_task):
    rows = [(str(k).encode(), f"z{k}".encode(), b"", b"", b"") for k in range(10)]
    for name in ("a", "b"):
        by_hand(f"{tmp_dir}/{name}.dbf", rows)
    df = spark.read.format("dbf").option("position", True).option("recordsPerTask", per_task).load(tmp_dir)
    assert df.rdd.getNumPartitions() == 2 * -(-10 // per_task)
    got = sorted((r["_file"].rsplit("/", 1)[1], r["_record"], r["LocationID"], r["zone"]) for r in df.collect())
    assert got == [(f"{n}.dbf", k, k, f"z{k}") for n in "ab" for k in range(10)]


def test_round_trip_of_many_tasks(spark, tmp_dir):
    df = spark.range(0, 500, 1, 4).select(
        F.col("id").cast("int").alias("n"), (F.col("id") * 10 ** 14).alias("big"), F.when(F.col("id") % 7 > 0, F.concat(F.lit("zoné "), "id")).alias("text"),
        (F.col("id") / 7 - 30).alias("x"), (F.col("id") % 2 == 0).alias("flag"), F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    path = f"{tmp_dir}/out"
    df.write.format("dbf").mode("append").save(path)
    back = spark.read.format("dbf").load(path).withColumn("n", F.col("n").cast("int"))
    assert len(glob.glob(f"{path}/*")) == 4
    assert back.exceptAll(df).count() == df.exceptAll(back).count() == 0
    df.limit(3).coalesce(1).write.format("dbf").mode("overwrite").save(path)
    assert spark.read.format("dbf").load(path).count() == 3


def test_what_does_not_fit_fails_and_leaves_nothing(spark, tmp_dir):
    for df in (spark.createDataFrame([("x" * 300,)], "text string"), spark.createDataFrame([(1,)], "a_long_name_here int")):
        with pytest.raises(Exception, match="fit|letters"):
            df.write.format("dbf").mode("append").save(f"{tmp_dir}/out")
    assert glob.glob(f"{tmp_dir}/out/[!_]*.dbf") == []


def test_damaged_files(spark, tmp_dir):
    by_hand(f"{tmp_dir}/short.dbf", ROWS, promised=900)  # cut short: whole records are read
    assert read_layout(f"{tmp_dir}/short.dbf").records == 5
    assert spark.read.format("dbf").load(f"{tmp_dir}/short.dbf").count() == 5
    open(f"{tmp_dir}/no.dbf", "wb").write(b"no dBASE file, but long enough for a header of it")
    for path in (f"{tmp_dir}/no.dbf", f"{tmp_dir}/absent"):
        with pytest.raises(Exception, match="dBASE|absent"):
            spark.read.format("dbf").load(path).count()
    by_hand(f"{tmp_dir}/empty.dbf", [])
    assert spark.read.format("dbf").load(f"{tmp_dir}/empty.dbf").collect() == []
