"""Streamed cleaning with bounded state: duplicates within a watermark.

The raw layer is read as a stream, cleaned by the validity rules, and deduplicated
by ``dropDuplicatesWithinWatermark`` on the trip's key: Spark keeps a key only
until the watermark (the greatest pickup time seen, less ``delay``) has passed it,
so the state does not grow with history.  The first row of a key to arrive stays.

What the stream drops is not lost.  Every row carries the place it came from
(file and row number); after a run, rows of the batches it took that are not
among the kept ones go to a side output, as ``duplicate`` if their key was kept
and as ``late`` if it was not: they came after the watermark.  Kept and side rows
together are the valid input, row for row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.operators.dedup import DEDUP_KEYS
from meterline.plans.silver import valid_trips
from meterline.schema import LINEAGE_COLUMNS, RAW_COLUMNS
from meterline.session import newest_partition
from meterline.streaming.ingest import BATCH, last_batch, read_batches

EVENT_TIME = "tpep_pickup_datetime"
PLACE = ("_file", "_row")


@dataclass(frozen=True)
class WatermarkRun:
    path: str
    kept: int
    duplicate: int
    late: int


def _placed_valid(raw: DataFrame) -> DataFrame:
    """Valid trips with the place of their row in the raw layer."""
    rows = raw.select(*RAW_COLUMNS, *LINEAGE_COLUMNS, F.col(BATCH).cast("long").alias(BATCH),
                      F.col("_metadata.file_path").alias("_file"), F.col("_metadata.row_index").alias("_row"))
    return valid_trips(rows)


def clean_stream(spark: SparkSession, raw_layer: str, path: str, *, delay: str = "2 hours", keys=DEDUP_KEYS) -> WatermarkRun:
    """Take what is new in ``raw_layer`` (an ingest sink) into ``path``: ``kept``
    and, for each run, ``side/run=<last raw batch>`` (with ``outcome``).

    A run that dies between the two is completed by the next: the stream goes on
    from its checkpoint, and side rows are worked out for all batches that have
    none yet.  Nothing new: no rows, and the counts are 0.  Run it after
    ``ingest``, not beside it: a batch that is being written again has two sets
    of files."""
    newest = last_batch(spark, raw_layer)
    done = newest_partition(spark, f"{path}/side", "run")  # the last raw batch whose side rows are written
    if newest <= done:
        return WatermarkRun(path, 0, 0, 0)
    raw = read_batches(spark, raw_layer)
    # No size bound a trigger: batches of the raw layer are bounded already, and
    # the watermark moves between runs, never between files of one run.
    stream = spark.readStream.schema(raw.schema).parquet(raw_layer)
    kept = (_placed_valid(stream).withWatermark(EVENT_TIME, delay)
            .dropDuplicatesWithinWatermark(list(keys)))
    run = (kept.writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{path}/_checkpoint")
           .trigger(availableNow=True).start(f"{path}/kept"))
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()

    came = _placed_valid(raw.filter(F.col(BATCH).between(done + 1, newest)))
    held = spark.read.schema(kept.schema).parquet(f"{path}/kept")
    now = held.filter(F.col(BATCH).between(done + 1, newest))
    dropped = came.join(now.select(*PLACE), list(PLACE), "left_anti")
    key = F.struct(*keys)
    known = held.select(key.alias("_key")).distinct().withColumn("_known", F.lit(True))
    side = (dropped.withColumn("_key", key).join(known, "_key", "left")
            .withColumn("outcome", F.when(F.col("_known"), "duplicate").otherwise("late")).drop("_key", "_known"))
    side.write.mode("overwrite").parquet(f"{path}/side/run={newest}")
    written = spark.read.schema(side.schema).parquet(f"{path}/side/run={newest}")
    counts = written.agg(F.count_if(F.col("outcome") == "duplicate").alias("d"), F.count_if(F.col("outcome") == "late").alias("l")).first()
    return WatermarkRun(path, now.count(), counts["d"], counts["l"])


def read_outcomes(spark: SparkSession, path: str) -> DataFrame:
    """All valid rows that came, with their ``outcome``: kept, duplicate or late."""
    held = spark.read.parquet(f"{path}/kept").withColumn("outcome", F.lit("kept"))
    schema = T.StructType(held.schema.fields)
    return held.unionByName(spark.read.schema(schema).parquet(f"{path}/side").select(*schema.names))
