"""The layered job end to end: raw files -> raw layer -> clean layer -> the
three aggregate tables.

    raw   : incremental file-stream ingest (exactly once, with lineage)
    clean : from the raw layer, written partitioned by pickup month
    gold  : trips / distance-band / passenger metrics by pickup zone and
            weekday, each read from the WRITTEN clean layer, also by month

Writing the clean layer once matters at scale: the dedup shuffle (the only
shuffle that moves whole rows) runs one time instead of once per aggregate
table, and each aggregate scan reads only its own columns from Parquet.

Incremental runs.  The dedup key holds the exact pickup time, so duplicates
never span two pickup months, and every aggregate table groups by pickup year
and month.  A run therefore rebuilds only the months that newly ingested
batches touch; the result equals a full rebuild.

State.  A run writes its months to folders of its own (``run=N/<month>``) in
every layer and replaces nothing.  After all layers are written it appends one
row: the folder (version) that holds the layers, which run holds each month, the
last ingest batch they reflect, and a fingerprint of what else they depend on
(zone rows, period, locations).  That row publishes all layers at once: a reader
who opened the state before sees the old months of every layer, one after sees
the new ones, and a run that dies in between is not seen at all; the next one
does its batches again.  A full build goes to a new version, and a changed
fingerprint makes a full build.  Folders that no state row names any more are
left for the folder's owner to remove.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from meterline.operators.gold import bucket_metrics, passenger_metrics, trip_metrics
from meterline.operators.sketches import sketched
from meterline.plans.silver import clean_trips
from meterline.schema import LINEAGE_COLUMNS, RAW_COLUMNS
from meterline.session import partition_values, path_exists
from meterline.sources.sinks import register_table
from meterline.sources.zones import SizedDimension
from meterline.streaming.ingest import BATCH, IngestResult, ingest, last_batch, read_batches

# Partition column of the clean and aggregate layers: pickup month, "yyyy-MM".
MONTH_KEY = "pickup_ym"

# Table comments and properties of each layer.
LAYER_TABLES = {
    "raw": ("Raw trip data with ingestion metadata.", {"quality": "bronze"}),
    "clean": ("Clean and validated trip data.", {"quality": "silver"}),
    "gold_trips": ("Trip metrics by pickup zone and weekday.", {"quality": "gold"}),
    "gold_bucket": ("Distance-band trip metrics by pickup zone and weekday.", {"quality": "gold"}),
    "gold_passengers": ("Passenger-count trip metrics by pickup zone and weekday.", {"quality": "gold"}),
    "sketches": ("Quantile sketches of clean trips by month.", {"quality": "gold"}),
}

GOLD_BUILDERS = {
    "gold_trips": trip_metrics,
    "gold_bucket": bucket_metrics,
    "gold_passengers": passenger_metrics,
}


# Partition column of the run that wrote a month.
RUN = "run"


@dataclass
class LayerRun:
    ingest: IngestResult | None
    months: list | None = None          # months rebuilt (None = all)
    held_by: dict = field(default_factory=dict)  # month -> run that holds it
    paths: dict = field(default_factory=dict)
    schemas: dict = field(default_factory=dict)


def month_key(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def _next_month(m: str) -> str:
    year, month = int(m[:4]), int(m[5:7])
    return f"{year + month // 12:04d}-{month % 12 + 1:02d}"


def in_months(ts: Column, months: list) -> Column:
    """``ts`` within any of the ``yyyy-MM`` months, as timestamp ranges (one
    per run of consecutive months) that reach the Parquet scan, so row groups
    of other months are skipped."""
    runs: list[list[str]] = []
    for m in sorted(set(months)):
        if runs and _next_month(runs[-1][1]) == m:
            runs[-1][1] = m
        else:
            runs.append([m, m])
    cond = F.lit(False)
    for first, last in runs:
        start = F.lit(f"{first}-01 00:00:00").cast("timestamp_ntz")
        end = F.lit(f"{_next_month(last)}-01 00:00:00").cast("timestamp_ntz")
        cond = cond | ((ts >= start) & (ts < end))
    return cond


def _write(df: DataFrame, path: str, run: int) -> None:
    """Write the months of one run.  The rebalance hint deals rows out by month;
    AQE merges small months into one task and splits large ones."""
    df.hint("rebalance", F.col(MONTH_KEY)).write.partitionBy(MONTH_KEY).mode("overwrite").parquet(f"{path}/{RUN}={run}")


def _read(spark: SparkSession, path: str, schema: T.StructType | None, held_by: dict) -> DataFrame:
    """The months of a layer, each from the run that holds it."""
    by_run: dict[int, list[str]] = {}
    for month, run in held_by.items():
        by_run.setdefault(run, []).append(month)
    current = F.lit(False)
    for run, months in sorted(by_run.items()):  # partition pruning: no other folder is read
        current = current | ((F.col(RUN) == run) & F.col(MONTH_KEY).isin(sorted(months)))
    reader = spark.read if schema is None else spark.read.schema(T.StructType([*schema.fields, T.StructField(RUN, T.LongType())]))
    return reader.parquet(path).filter(current).drop(RUN)


@dataclass
class _State:
    run: int
    version: str
    last_batch: int
    depends_on: str
    held_by: dict
    layers: list


_STATE_SCHEMA = "run long, version string, last_batch long, depends_on string, held_by map<string,long>, layers array<string>"


def _read_state(spark: SparkSession, root: str) -> _State | None:
    if not path_exists(spark, f"{root}/_state/runs"):
        return None
    row = spark.read.schema(_STATE_SCHEMA).parquet(f"{root}/_state/runs").orderBy(F.col("run").desc()).first()
    return None if row is None else _State(**row.asDict())


def _append_state(spark: SparkSession, root: str, state: _State) -> None:
    row = [(state.run, state.version, state.last_batch, state.depends_on, state.held_by, state.layers)]
    spark.createDataFrame(row, _STATE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/_state/runs")


def _fingerprint(zones: SizedDimension, period: str, locations: tuple) -> str:
    """Of everything but the raw rows that the layers are computed from."""
    z = zones.df.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("LocationID", "zone")).alias("x")).first()
    return json.dumps([z["n"], z["x"], period, list(locations)])


def _paths(root: str, version: str) -> dict:
    return {"raw": f"{root}/raw", **{layer: f"{root}/versions/{version}/{layer}" for layer in ("clean", *GOLD_BUILDERS)}}


def run_layers(spark: SparkSession, landing: str, root: str, zones: SizedDimension, *,
               period: str = "day", locations=("PUlocationID",), table_prefix: str | None = None,
               incremental: bool = True, sketch_columns: tuple = ()) -> LayerRun:
    """Ingest new files from ``landing`` and bring the clean and aggregate
    layers under ``root`` up to date.

    The first run, ``incremental=False``, and a changed zone table, period or
    location list build everything, in a new version folder.  Other runs
    rebuild the pickup months of the ingest batches not yet reflected (one
    small aggregation, one row per month).  Input without any valid row gives
    empty layers.  With ``sketch_columns`` a quantile sketch of each by month is
    a layer, too.  Old versions are left for the folder's owner to remove."""
    result = ingest(spark, landing, f"{root}/raw", f"{root}/_checkpoints/raw")
    raw = read_batches(spark, result.sink_path).select(*RAW_COLUMNS, *LINEAGE_COLUMNS, BATCH)
    state, depends_on = _read_state(spark, root), _fingerprint(zones, period, (*locations, *sketch_columns))
    full = not incremental or state is None or state.depends_on != depends_on
    newest = last_batch(spark, result.sink_path)
    months = None
    if not full:
        month = month_key(F.col("tpep_pickup_datetime")).alias("m")
        pending = raw.filter(F.col(BATCH) > state.last_batch).select(month).distinct().collect()
        months = sorted(r["m"] for r in pending if r["m"] is not None)
    version = uuid.uuid4().hex if full else state.version
    number = 0 if state is None else state.run + 1
    run = LayerRun(result, months, {} if full else dict(state.held_by), _paths(root, version))
    if sketch_columns:
        run.paths["sketches"] = f"{root}/versions/{version}/sketches"

    source = raw.drop(BATCH) if full else raw.drop(BATCH).filter(in_months(F.col("tpep_pickup_datetime"), months))
    clean = clean_trips(source, zones).withColumn(MONTH_KEY, month_key(F.col("tpep_pickup_datetime")))
    run.schemas["clean"] = clean.schema
    rebuild = full or bool(months)
    if rebuild:
        _write(clean, run.paths["clean"], number)
        written_months = partition_values(spark, f"{run.paths['clean']}/{RUN}={number}", MONTH_KEY)
        run.held_by |= {m: number for m in (written_months if full else months)}
    written = _read(spark, run.paths["clean"], clean.schema, {m: r for m, r in run.held_by.items() if full or m in months})
    for layer, build in GOLD_BUILDERS.items():
        # The month key is fixed by (pickup_year, pickup_month), so grouping by
        # it too leaves every group unchanged; it becomes the partition column.
        table = build(written, period, [*locations, MONTH_KEY])
        run.schemas[layer] = table.schema
        if rebuild:
            _write(table, run.paths[layer], number)
    if sketch_columns:
        table = sketched(written, sketch_columns, MONTH_KEY)
        run.schemas["sketches"] = table.schema
        if rebuild:
            _write(table, run.paths["sketches"], number)

    if full or newest > state.last_batch:
        _append_state(spark, root, _State(number, version, newest, depends_on, run.held_by, sorted(run.paths)))
    if table_prefix:
        for layer, path in run.paths.items():
            comment, props = LAYER_TABLES[layer]
            current = None if layer == "raw" else [
                {RUN: r, MONTH_KEY: m} for m, r in sorted(run.held_by.items())
                if path_exists(spark, f"{path}/{RUN}={r}/{MONTH_KEY}={m}")]
            register_table(spark, f"{table_prefix}_{layer}", path, comment=comment, properties=props, partitioned=True, partitions=current)
    return run


def open_layers(spark: SparkSession, root: str) -> LayerRun | None:
    """The layers that the newest state row names, for readers: one state of all
    layers, whatever is being written.  None before the first run."""
    state = _read_state(spark, root)
    if state is None:
        return None
    base = _paths(root, state.version)
    return LayerRun(None, None, state.held_by, {layer: base.get(layer, f"{root}/versions/{state.version}/{layer}") for layer in state.layers})


def read_layer(spark: SparkSession, run: LayerRun, layer: str) -> DataFrame:
    """A layer as written, without the partition column (sketches keep their month)."""
    if layer == "raw":
        return read_batches(spark, run.paths[layer]).drop(BATCH)
    rows = _read(spark, run.paths[layer], run.schemas.get(layer), run.held_by)
    return rows if layer == "sketches" else rows.drop(MONTH_KEY)


__all__ = ["LayerRun", "open_layers", "read_layer", "run_layers", "MONTH_KEY"]
