"""Incremental ingest of Parquet files into the raw layer.

Structured Streaming over the names of new files -> each batch's files read and
brought to the declared schema -> two lineage columns -> one Parquet folder per
batch.
The checkpoint records which files were taken and which batches committed,
so every file lands exactly once: re-running picks up only new files, and a
lost executor or a killed run resumes from the last committed batch.  Each
batch overwrites a folder of its own (``ingest_batch=<id>``), so a batch that
is run again replaces itself, and the batch id tells later jobs what is new
without any clock.

Files may differ in schema.  The files of a batch are grouped by what their
footers say (one job over the file names), each group is read with its own types
and brought to the layer's schema by ``conform``: absent columns become null,
compatible types are cast, anything else stops the stream.  Columns the schema
does not know are kept as JSON in ``_rescued_data``, or become columns, as the
evolution policy says; the schema log keeps the history.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from meterline.schema import LINEAGE_COLUMNS, RAW_SCHEMA, accepted_cast, conform
from meterline.session import newest_partition
from meterline.streaming.schema_log import Evolution, append, evolve, footers, read_log, schema_at

# Values of columns that the declared schema lacks, as JSON; null without any.
RESCUED = "_rescued_data"


@dataclass
class IngestResult:
    sink_path: str
    checkpoint_path: str
    batches: int
    rows: int


def with_lineage(stream: DataFrame) -> DataFrame:
    """``_ingestion_time`` (processing time) and ``_source_file`` (full path of
    the file each row came from)."""
    return (stream.withColumn("_ingestion_time", F.current_timestamp())
            .withColumn("_source_file", F.col("_metadata.file_path")))


def read_file_stream(spark: SparkSession, source: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame with the ``path`` of each file at ``source`` (a
    directory with any folders below it, or a glob); contents are not read."""
    # A file is new if the checkpoint has not seen it, however old its time
    # stamp is (a backfill, or a copy that keeps time stamps).
    reader = (spark.readStream.format("binaryFile").option("maxFileAge", "36500d").option("recursiveFileLookup", "true")
              .schema("path string, modificationTime timestamp, length long, content binary"))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(source).select("path")


def _literal(path: str) -> str:
    """``path`` with its glob characters quoted, as readers take paths for globs."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _alike(spark: SparkSession, paths: list[str]) -> list[tuple[T.StructType, list[str]]]:
    """``paths`` in groups whose files agree on the type of every column they
    share, with the merged schema, by halves: for stores that only Spark reads."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*map(_literal, paths)).schema, paths)]
    except Exception as e:
        if len(paths) == 1 or "CANNOT_MERGE_SCHEMAS" not in str(e):
            raise
    half = len(paths) // 2
    return _alike(spark, paths[:half]) + _alike(spark, paths[half:])


def file_groups(files: DataFrame) -> list[tuple[T.StructType, list[str]]]:
    """The files in ``path`` by Spark schema: one job reads the footers and
    groups them, then the schema of one file of each kind is read.  The number
    of jobs depends on the kinds of files, not on their number."""
    spark = files.sparkSession
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    for row in sorted(footers(files).collect(), key=lambda r: r["paths"]):  # one batch's, see max_files_per_trigger
        found = (_alike(spark, row["paths"]) if row["signature"] is None
                 else [(spark.read.parquet(_literal(row["paths"][0])).schema, row["paths"])])
        for schema, own in found:
            groups.setdefault(schema.json(), (schema, []))[1].extend(own)
    return list(groups.values())


def read_groups(spark: SparkSession, groups: list[tuple[T.StructType, list[str]]], schema: T.StructType) -> DataFrame:
    """The rows of groups of files: ``schema``'s columns, ``_rescued_data`` (what
    the schema lacks or cannot take, as JSON) and lineage."""
    want = {f.name.lower(): f.dataType for f in schema.fields}
    out = None
    for found, own in groups:
        rows = spark.read.schema(found).parquet(*map(_literal, own))
        extra = [f.name for f in found.fields if f.name.lower() not in want or not accepted_cast(f.dataType, want[f.name.lower()])]
        rescued = F.nullif(F.to_json(F.struct(*extra)), F.lit("{}")) if extra else F.lit(None).cast("string")
        rows = with_lineage(rows.withColumn(RESCUED, rescued)).drop(*extra)
        rows = conform(rows, schema).select(*schema.names, RESCUED, *LINEAGE_COLUMNS)
        out = rows if out is None else out.unionAll(rows)
    return out


# Files per micro-batch: a backfill of many files runs as bounded batches, each
# committed on its own, so a failure costs at most one batch.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000


BATCH = "ingest_batch"

# Beside the batches, hidden from readers of the layer.
METRICS = "_metrics"
METRIC_SCHEMA = "check_type string, item string, value long"


def ingest(spark: SparkSession, source: str, sink: str, checkpoint: str, *,
           schema: T.StructType = RAW_SCHEMA,
           max_files_per_trigger: int | None = DEFAULT_MAX_FILES_PER_TRIGGER,
           evolution: Evolution = Evolution(), metrics: dict[str, Column] | None = None) -> IngestResult:
    """Take every file not yet ingested (``availableNow``: all that is there
    now, in bounded batches, then stop) and add it to ``sink``.  Rows are
    counted as they are written, not taken from the stream's progress log,
    which keeps only the latest batches.  ``evolution`` says what happens to
    unknown columns and wider types; see ``schema_log``.  ``metrics`` (aggregates
    by name ``<check type>__<item>``) are taken while a batch is written, and
    stored beside it: see ``batch_metrics``."""
    stream = read_file_stream(spark, source, max_files_per_trigger)
    written: list[int] = []

    def write(files: DataFrame, batch: int) -> None:
        groups = file_groups(files)
        if not groups:
            return
        now, events = evolve(read_log(spark, sink), batch, schema, groups, evolution)
        append(spark, sink, batch, events)
        counted = Observation()
        rows = read_groups(spark, groups, now).observe(
            counted, F.count(F.lit(1)).alias("rows"), *(m.cast("bigint").alias(name) for name, m in (metrics or {}).items()))
        rows.write.mode("overwrite").parquet(f"{sink}/{BATCH}={batch}")
        found = dict(counted.get)
        written.append(found.pop("rows"))
        if found:
            named = [(*name.split("__", 1), value) for name, value in found.items()]
            (spark.createDataFrame(named, METRIC_SCHEMA).coalesce(1).write.mode("overwrite")
             .parquet(f"{sink}/{METRICS}/batch={batch}"))

    run = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start())
    run.awaitTermination()
    if run.exception() is not None:
        raise run.exception()
    return IngestResult(sink, checkpoint, len(written), sum(written))


def batch_metrics(spark: SparkSession, sink: str) -> DataFrame:
    """(check_type, item, value, batch): what was measured while the batches of
    the raw layer were written.  Nothing of the layer itself is read."""
    return spark.read.schema(f"{METRIC_SCHEMA}, batch long").parquet(f"{sink}/{METRICS}")


def last_batch(spark: SparkSession, sink: str) -> int:
    """Id of the newest batch in the raw layer, from folder names; -1 without any."""
    return newest_partition(spark, sink, BATCH)


def read_batches(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of the raw layer with the id of the batch each row came in:
    the columns the schema log gives it now (null in batches before a column
    came, widened where its type was narrower), or those of ``schema``."""
    schema = schema or schema_at(spark, sink) or RAW_SCHEMA
    lineage = T.StructType(schema.fields + [T.StructField(RESCUED, T.StringType()),
                                            T.StructField("_ingestion_time", T.TimestampType()),
                                            T.StructField("_source_file", T.StringType()),
                                            T.StructField(BATCH, T.LongType())])
    return spark.read.schema(lineage).parquet(sink)


def read_ingested(spark: SparkSession, sink: str, schema: T.StructType | None = None) -> DataFrame:
    """Batch read of the raw layer."""
    return read_batches(spark, sink, schema).drop(BATCH)
