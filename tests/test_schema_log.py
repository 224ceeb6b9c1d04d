"""Ingest of files with differing schemas: footer grouping, the schema log, and
the evolution policies."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F, types as T

from meterline.schema import RAW_COLUMNS
from meterline.streaming import schema_log
from meterline.streaming.ingest import file_groups, ingest, last_batch, read_ingested
from meterline.streaming.schema_log import Evolution, evolve, read_log, schema_at
from tests.helpers import raw_frame, trip

DECLARED = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("amount", T.FloatType())])


def drop_file(spark, folder, ddl, *rows):
    spark.createDataFrame(list(rows), ddl).coalesce(1).write.parquet(folder)


def events(spark, sink):
    rows = read_log(spark, sink).filter("event != 'declared'").collect()
    return sorted((r["version"], r["event"], r["column_name"], r["from_type"], r["to_type"], r["files"]) for r in rows)


def test_jobs_do_not_grow_with_files(spark, tmp_dir):
    """Files of two types in turn: as many jobs for 80 files as for 240 (Spark
    itself lists over 32 paths by a job)."""
    dag = spark.sparkContext._jsc.sc().dagScheduler()
    narrow = T.StructType([T.StructField("id", T.IntegerType())])
    spark.range(0, 240, 1, 120).select(F.col("id").cast("int")).write.parquet(f"{tmp_dir}/a")
    spark.range(0, 240, 1, 120).select(F.col("id").cast("double")).write.parquet(f"{tmp_dir}/b")
    import glob
    import os
    import shutil
    used = []
    for n in (40, 120):
        os.makedirs(source := f"{tmp_dir}/source{n}")
        for k, pair in enumerate(zip(sorted(glob.glob(f"{tmp_dir}/a/*.parquet"))[:n], sorted(glob.glob(f"{tmp_dir}/b/*.parquet"))[:n])):
            for name, path in zip("ab", pair):
                shutil.copy(path, f"{source}/{k:04d}{name}.parquet")
        paths = spark.createDataFrame([(p,) for p in glob.glob(f"{source}/*.parquet")], "path string")
        assert [len(own) for _, own in file_groups(paths)] == [n, n]
        before = dag.numTotalJobs()
        result = ingest(spark, source, f"{tmp_dir}/raw{n}", f"{tmp_dir}/ckpt{n}", schema=narrow)
        used.append(dag.numTotalJobs() - before)
        assert result.rows == read_ingested(spark, f"{tmp_dir}/raw{n}").count() > 0
    assert used[0] == used[1] < 25


def test_add_and_widen(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/source", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    take = lambda: ingest(spark, source, sink, ckpt, schema=DECLARED, evolution=Evolution("add", "widen"))
    drop_file(spark, f"{source}/1", "id int, amount float", (1, 1.5))
    take()
    assert schema_at(spark, sink) == DECLARED and events(spark, sink) == []
    drop_file(spark, f"{source}/2", "id long, amount double, note string, Code short", (2 ** 40, 2.1, "n", 7))
    drop_file(spark, f"{source}/3", "ID int, code int", (3, 70000))
    take()
    drop_file(spark, f"{source}/4", "id int, amount float, code string", (4, 4.5, "x"))
    take()
    assert schema_at(spark, sink).simpleString() == "struct<id:bigint,amount:double,code:int,note:string>"
    assert schema_at(spark, sink, 0) == DECLARED
    rows = {r["id"]: (r["amount"], r["code"], r["note"], r["_rescued_data"]) for r in read_ingested(spark, sink).collect()}
    assert rows == {1: (1.5, None, None, None), 2 ** 40: (2.1, 7, "n", None), 3: (None, 70000, None, None), 4: (4.5, None, None, '{"code":"x"}')}
    assert [e[:5] for e in events(spark, sink)] == [
        (1, "absent", "amount", None, "double"), (1, "added", "code", None, "int"), (1, "added", "note", None, "string"),
        (1, "cast", "Code", "smallint", "int"),
        (1, "widened", "amount", "float", "double"), (1, "widened", "id", "int", "bigint"),
        (2, "absent", "note", None, "string"), (2, "cast", "amount", "float", "double"), (2, "cast", "id", "int", "bigint"), (2, "rescued", "code", "string", None)]
    first = {r["column_name"]: r["first_file"] for r in read_log(spark, sink).filter("event = 'added'").collect()}
    assert "/2/" in first["note"]


def test_rescue_is_logged_once_and_never_shapes(spark, tmp_dir):
    source, sink, ckpt = f"{tmp_dir}/source", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    for k in range(3):
        drop_file(spark, f"{source}/{k}", "id int, amount float, fee double", (k, 1.0, k + 0.5))
        ingest(spark, source, sink, ckpt, schema=DECLARED)
    assert events(spark, sink) == [(1, "rescued", "fee", "double", None, 1)]
    assert schema_at(spark, sink) == DECLARED
    assert sorted(r["_rescued_data"] for r in read_ingested(spark, sink).collect()) == ['{"fee":0.5}', '{"fee":1.5}', '{"fee":2.5}']


@pytest.mark.parametrize("ddl, policy", [("id int, amount float, x int", Evolution("stop")), ("id long, amount float", Evolution(wider="stop")),
                                         ("id array<int>, amount float", Evolution("add", "widen"))])
def test_stop_writes_nothing(spark, tmp_dir, ddl, policy):
    drop_file(spark, f"{tmp_dir}/source/1", ddl, (([1] if "array" in ddl else 1), 1.0) + ((1,) if "x int" in ddl else ()))
    with pytest.raises(Exception, match="x|id"):
        ingest(spark, f"{tmp_dir}/source", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt", schema=DECLARED, evolution=policy)
    assert last_batch(spark, f"{tmp_dir}/raw") == -1 and read_log(spark, f"{tmp_dir}/raw") is None
    # mended files are taken by the next run
    drop_file(spark, f"{tmp_dir}/other/1", "id int, amount float", (1, 1.0))
    assert ingest(spark, f"{tmp_dir}/other", f"{tmp_dir}/raw2", f"{tmp_dir}/_ckpt2", schema=DECLARED, evolution=policy).rows == 1


def test_unknown_policy():
    with pytest.raises(ValueError):
        Evolution("drop")


def test_a_batch_that_died_after_its_log_entry_is_run_again(spark, tmp_dir, monkeypatch):
    """Killed between log and data: the next run writes the same entry again."""
    import sys
    module = sys.modules["meterline.streaming.ingest"]
    source, sink, ckpt = f"{tmp_dir}/source", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt"
    policy = Evolution("add", "widen")
    for k, ddl in enumerate(("id int, amount float", "id long, amount float, fee int")):
        drop_file(spark, f"{source}/{k}", ddl, (k, 1.0) + (1,) * k)
        with monkeypatch.context() as m:
            m.setattr(module, "read_groups", lambda *a: 1 / 0)
            with pytest.raises(Exception):
                ingest(spark, source, sink, ckpt, schema=DECLARED, evolution=policy)
        assert ingest(spark, source, sink, ckpt, schema=DECLARED, evolution=policy).rows == 1
    assert [e[:4] for e in events(spark, sink)] == [(1, "added", "fee", None), (1, "widened", "id", "int")]
    assert read_log(spark, sink).filter("event = 'declared'").count() == 2
    assert {(r["id"], r["fee"]) for r in read_ingested(spark, sink).collect()} == {(0, None), (1, 1)}


def test_majority_type_is_added(spark):
    s = lambda ddl: T.StructType.fromDDL(ddl)
    groups = [(s("id int, x string"), ["a"]), (s("id int, x bigint"), ["b", "c"]), (s("id int, x int"), ["d"])]
    shape, log = evolve(None, 0, s("id int"), groups, Evolution("add", "widen"))
    assert shape == s("id int, x bigint")
    assert [(e[2], e[3], e[4]) for e in log if e[2] != "declared"] == [("added", "x", None), ("cast", "x", "int"), ("rescued", "x", "string")]
    assert evolve(None, 0, s("id int"), groups[::-1], Evolution("add", "widen")) == (shape, log)


def test_stores_that_only_spark_reads(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(schema_log, "_signature", lambda path: None)
    raw_frame(spark, [trip()]).coalesce(1).write.parquet(f"{tmp_dir}/s/1")
    raw_frame(spark, [trip()]).withColumn("passenger_count", F.lit(2.0)).coalesce(1).write.parquet(f"{tmp_dir}/s/2")
    import glob
    paths = spark.createDataFrame([("file://" + p,) for p in glob.glob(f"{tmp_dir}/s/*/*.parquet")], "path string")
    assert len(file_groups(paths)) == 2
    assert ingest(spark, f"{tmp_dir}/s", f"{tmp_dir}/raw", f"{tmp_dir}/_ckpt").rows == 2
    assert read_ingested(spark, f"{tmp_dir}/raw").select(*RAW_COLUMNS).count() == 2
