"""The layers kept up to date by deltas: a run costs what its new rows cost.

``run_layers`` rebuilds every month that a batch touches.  Here nothing that was
written is written again:

    survivors/run=N   rows of run N that are now their key's trip, by month
    gone/run=N        rows of earlier runs that these replace
    index/run=N       a key index (Bloom blocks) of the run's survivors, by month
    <table>/run=N     signed partial sums of each aggregate table

The survivor of a key is its smallest row, so it only ever gets smaller: a new
row is compared with the key's present survivor, and only rows whose key the
index does not rule out are compared at all.  A row of a new key enters with
sign +1; one that is smaller than the survivor enters with +1 and takes the old
one back with -1; any other changes nothing.  Where a batch holds no key that is
already there, no earlier survivor is read.

Runs are published by one state row, written last.  A reader takes the newest
row and reads the runs it names, so all layers are of one run whatever is being
written meanwhile; folders of a run that died are written again by the next.
After ``compact_every`` runs the partials and the index are merged into the
folders of one run; survivors stay.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.operators import key_index
from meterline.operators.dedup import DEDUP_KEYS, drop_duplicate_trips
from meterline.operators.partials import SIGN, TABLES, finished, merged, partial_sums
from meterline.operators.zones import map_location_to_zone
from meterline.plans.layers import MONTH_KEY, _fingerprint, month_key
from meterline.plans.silver import _clean_projection, valid_trips
from meterline.schema import LINEAGE_COLUMNS, RAW_COLUMNS
from meterline.session import path_exists, scratch_path
from meterline.sources.zones import SizedDimension
from meterline.streaming.ingest import BATCH, ingest, last_batch, read_batches

KEY = "_key"
STATE_SCHEMA = ("run long, version string, last_batch long, depends_on string, period string, base long, "
                "rows_in long, added long, replaced long, checked long, schemas map<string,string>")


@dataclass(frozen=True)
class Snapshot:
    """What one state row names.  ``base`` is the first run whose partials and
    index count (earlier ones are merged into it).  Of the run itself: valid
    rows after its own dedup, survivors added and replaced, and rows whose key
    the index did not rule out."""
    root: str
    run: int
    version: str
    last_batch: int
    depends_on: str
    period: str
    base: int = 0
    rows_in: int = 0
    added: int = 0
    replaced: int = 0
    checked: int = 0
    schemas: dict | None = None

    def folder(self, part: str) -> str:
        return f"{self.root}/deltas/{self.version}/{part}"


def open_snapshot(spark: SparkSession, root: str) -> Snapshot | None:
    """The newest published run; None before the first."""
    if not path_exists(spark, f"{root}/deltas/_state"):
        return None
    row = spark.read.schema(STATE_SCHEMA).parquet(f"{root}/deltas/_state").orderBy(F.col("run").desc()).first()
    return None if row is None else Snapshot(root, **row.asDict())


def _publish(spark: SparkSession, s: Snapshot) -> None:
    names = [c.split()[0] for c in STATE_SCHEMA.replace("map<string,string>", "m").split(", ")]
    row = [tuple(getattr(s, n) for n in names)]
    spark.createDataFrame(row, STATE_SCHEMA).coalesce(1).write.mode("append").parquet(f"{s.root}/deltas/_state")


def _write(df: DataFrame, s: Snapshot, part: str, run: int, *by: str) -> dict:
    """One run's folder of a part, replaced if a run that died left one."""
    df.write.mode("overwrite").partitionBy(*by).parquet(f"{s.folder(part)}/run={run}")
    return {part: df.schema.json()}


def _read(spark: SparkSession, s: Snapshot, part: str, first: int = 0) -> DataFrame:
    """Published runs of a part from ``first`` on, with their ``run``."""
    schema = T.StructType.fromJson(json.loads(s.schemas[part])).add("run", T.LongType())
    return spark.read.schema(schema).parquet(s.folder(part)).filter(F.col("run").between(first, s.run))


def _stage(df: DataFrame, label: str) -> DataFrame:
    path = scratch_path(df.sparkSession, f"delta-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _row_of() -> list[str]:
    """What names one row of the survivors: a run holds a key once."""
    return [MONTH_KEY, KEY, "run", "_version"]


def survivors(spark: SparkSession, s: Snapshot, months: list | None = None) -> DataFrame:
    """The trips of a snapshot before labels: one row for each dedup key."""
    rows, gone = _read(spark, s, "survivors"), _read(spark, s, "gone").withColumnsRenamed({"run": "_by", "of_run": "run"})
    if months is not None:
        rows, gone = rows.filter(F.col(MONTH_KEY).isin(months)), gone.filter(F.col(MONTH_KEY).isin(months))
    return rows.join(gone.select(*_row_of()), _row_of(), "left_anti")


def _delta(spark: SparkSession, s: Snapshot, new: DataFrame, months: list) -> tuple[DataFrame, int]:
    """Signed rows that bring the survivors up to date with ``new`` (one row for
    each key), and how many rows the index could not rule out."""
    rest = [c for c in new.columns if c not in (*DEDUP_KEYS, MONTH_KEY, KEY, "_version")]
    fresh = new.withColumns({SIGN: F.lit(1), "of_run": F.lit(None).cast("long")})
    if s.schemas is None:
        return fresh, 0
    index = _read(spark, s, "index", s.base).filter(F.col(MONTH_KEY).isin(months))
    maybe = _stage(key_index.maybe_present(new.select(MONTH_KEY, KEY), index, MONTH_KEY), "maybe")
    checked = maybe.count()
    if not checked:
        return fresh, 0
    held = survivors(spark, s, months).join(maybe, [MONTH_KEY, KEY], "left_semi")
    asked = new.join(maybe, [MONTH_KEY, KEY], "left_semi")
    row = F.struct(*rest, "_version")
    sides = (held.select(*DEDUP_KEYS, MONTH_KEY, KEY, row.alias("held"), F.col("run"))
             .unionByName(asked.select(*DEDUP_KEYS, MONTH_KEY, KEY, row.alias("asked")), allowMissingColumns=True))
    pairs = sides.groupBy(*DEDUP_KEYS, MONTH_KEY, KEY).agg(
        F.min("held").alias("held"), F.min("run").alias("of_run"), F.min("asked").alias("asked"))
    # The smaller of the two, by the order that the dedup takes its minimum in.
    smaller = F.array_min(F.array("held", "asked"))
    wins = F.col("asked").isNotNull() & (F.col("held").isNull() | ~smaller.eqNullSafe(F.col("held")))
    lit = lambda x: F.lit(x).cast("long")
    moves = F.array(F.struct(F.lit(1).alias(SIGN), F.col("asked").alias("row"), lit(None).alias("of_run")),
                    F.struct(F.lit(-1).alias(SIGN), F.col("held").alias("row"), F.col("of_run")))
    changed = (pairs.filter(wins).select(*DEDUP_KEYS, MONTH_KEY, KEY, F.explode(moves).alias("m"))
               .filter(F.col("m.row").isNotNull()).select(*DEDUP_KEYS, MONTH_KEY, KEY, "m.row.*", f"m.{SIGN}", "m.of_run"))
    return fresh.join(maybe, [MONTH_KEY, KEY], "left_anti").unionByName(changed), checked


def maintain(spark: SparkSession, landing: str, root: str, zones: SizedDimension, *, period: str = "day",
             locations=("PUlocationID",), compact_every: int = 16) -> Snapshot:
    """Ingest new files and bring the layers under ``root`` up to date.  The
    first run, and one after the zone table, period or locations changed, takes
    all batches into a new version; nothing new: the present snapshot."""
    result = ingest(spark, landing, f"{root}/raw", f"{root}/_checkpoints/raw")
    newest, depends_on = last_batch(spark, result.sink_path), _fingerprint(zones, period, tuple(locations))
    s = open_snapshot(spark, root)
    if s is not None and s.depends_on == depends_on and newest <= s.last_batch:
        return s
    run = 0 if s is None else s.run + 1
    if s is None or s.depends_on != depends_on:
        s = Snapshot(root, run - 1, uuid.uuid4().hex, -1, depends_on, period, base=run)

    raw = read_batches(spark, result.sink_path).filter(F.col(BATCH) > s.last_batch).select(*RAW_COLUMNS, *LINEAGE_COLUMNS)
    valid = drop_duplicate_trips(valid_trips(raw))
    new = _stage(valid.withColumns({MONTH_KEY: month_key(F.col("tpep_pickup_datetime")), KEY: key_index.key_hash(*map(F.col, DEDUP_KEYS)),
                                    "_version": F.xxhash64(*valid.columns)}), "new")
    months = sorted(r[0] for r in new.select(MONTH_KEY).distinct().collect())  # a row for each month
    delta, checked = _delta(spark, s, new, months)
    if checked:  # else it is ``new`` as it was written, with its sign
        delta = _stage(delta, "rows")
    came, went = delta.filter(F.col(SIGN) > 0).drop(SIGN, "of_run"), delta.filter(F.col(SIGN) < 0)

    schemas = _write(came, s, "survivors", run, MONTH_KEY)
    schemas |= _write(went.select(MONTH_KEY, KEY, "_version", "of_run"), s, "gone", run, MONTH_KEY)
    schemas |= _write(key_index.build(came.select(MONTH_KEY, KEY), MONTH_KEY), s, "index", run, MONTH_KEY)
    labelled = map_location_to_zone(delta.select(*_clean_projection(delta.columns, labels=True), SIGN), zones)
    for table in TABLES:
        schemas |= _write(partial_sums(labelled, table, period, list(locations)), s, table, run)
    counts = delta.agg(F.count_if(F.col(SIGN) > 0).alias("added"), F.count_if(F.col(SIGN) < 0).alias("replaced")).first()
    s = replace(s, run=run, last_batch=newest, rows_in=new.count(), added=counts["added"], replaced=counts["replaced"],
                checked=checked, schemas=schemas)
    if run - s.base + 1 >= compact_every:
        s = _compacted(spark, s)
    _publish(spark, s)
    return s


def _compacted(spark: SparkSession, s: Snapshot) -> Snapshot:
    """Partials and index of all runs, merged into a run of their own, which is
    published with the run that made them."""
    run = s.run + 1
    for table in TABLES:
        _write(merged(_read(spark, s, table, s.base).drop("run"), table), s, table, run)
    _write(key_index.build(survivors(spark, s).select(MONTH_KEY, KEY), MONTH_KEY), s, "index", run, MONTH_KEY)
    for part in ("survivors", "gone"):
        _write(_read(spark, s, part).filter("false").drop("run"), s, part, run, MONTH_KEY)
    return replace(s, run=run, base=run)


def read_gold(spark: SparkSession, s: Snapshot, table: str) -> DataFrame:
    """An aggregate table of the snapshot."""
    return finished(_read(spark, s, table, s.base).drop("run"), table, s.period)


def read_clean(spark: SparkSession, s: Snapshot, zones: SizedDimension) -> DataFrame:
    """The clean layer of the snapshot."""
    rows = survivors(spark, s)
    return map_location_to_zone(rows.select(*_clean_projection(rows.columns, labels=True)), zones)


__all__ = ["Snapshot", "maintain", "open_snapshot", "read_clean", "read_gold", "survivors"]
