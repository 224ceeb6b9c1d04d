"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from meterline.session import scratch_path

# A word is a run of anything but space, tab, LF, VT, FF and CR.  bytes.split()
# splits UTF-8 on exactly these six bytes.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Whether Spark removes a query's shuffle files when the query has ended (else
# they stay until the driver happens to collect its garbage), and the rows that
# go to a Python worker at once (whole texts: a batch of Spark's usual 10,000
# takes tens of MB in the executor and again in the worker).
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def frugal(spark: SparkSession, texts: bool) -> Iterator[None]:
    """Queries run inside leave no shuffle files behind and, where whole texts
    go to Python, send them in small batches.  The session's own settings hold
    again afterwards."""
    before = {k: spark.conf.get(k) for k in (FREE_SHUFFLES, BATCH_ROWS)}
    try:
        spark.conf.set(FREE_SHUFFLES, "true")
        # 0 or less is no bound at all.
        if texts and not 0 < int(before[BATCH_ROWS]) < SLICE_ROWS:
            spark.conf.set(BATCH_ROWS, str(SLICE_ROWS))
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def staged(df: DataFrame, label: str, *, texts: bool = False, path: str | None = None) -> DataFrame:
    """``df`` written to the shared scratch folder and read back: cuts the
    lineage, survives lost executors, and gives later joins a plain exchange
    on each side, which AQE can split when a key is hot.  Once it is written,
    the shuffle files it took are removed.  ``texts``: it sends whole texts to
    Python, so in small batches.  ``path``: in the place of an earlier staged
    table that nothing reads any more."""
    spark = df.sparkSession
    path, mode = (path, "overwrite") if path else (scratch_path(spark, f"llm-{label}"), "error")
    with frugal(spark, texts):
        df.write.mode(mode).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_bytes(df: DataFrame, *keep: str, id_col: str = "doc_id", text_col: str = "text", without_id: bool = False) -> DataFrame:
    """(id as long, text as UTF-8 bytes, ``keep``): what a Python stage reads.
    Rows without an id take part only if asked; other columns never leave the scan."""
    return (df if without_id else df.filter(F.col(id_col).isNotNull())).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"),
                     *(F.col(c) for c in keep))


def with_twin(documents: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``documents`` with ``_twin``, which tells apart the texts of one id: a hash
    of the text where the id is null or different texts share it, else 0."""
    h = F.xxhash64(text_col)
    shared = (documents.filter(F.col(id_col).isNotNull()).select(F.col(id_col), h.alias("_h")).groupBy(id_col)
              .agg(F.min("_h").alias("_low"), F.max("_h").alias("_high")).filter("_low <> _high").select(id_col))
    shared = staged(shared, label).withColumn("_shared", F.lit(True))
    return (documents.join(shared, id_col, "left")
            .withColumn("_twin", F.when(F.col(id_col).isNull() | F.col("_shared"), h).otherwise(F.lit(0).cast("long"))).drop("_shared"))


def map_rows(df: DataFrame, per_batch: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """``mapInArrow`` over at most ``SLICE_ROWS`` rows at a time, so the Python
    memory of a task does not depend on the session's batch size."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                out = per_batch(batch.slice(start, SLICE_ROWS))
                if out is not None and out.num_rows:
                    yield out
        # What Arrow freed goes back to the system, as the worker lives on for other stages.
        pa.default_memory_pool().release_unused()
    return df.mapInArrow(run, schema)


SLICE_ROWS = 512


def bucket_of(n: int, *cols: Column) -> Column:
    """A bucket 0..n-1 that depends on the values only."""
    return F.pmod(F.xxhash64(*cols), F.lit(n))
