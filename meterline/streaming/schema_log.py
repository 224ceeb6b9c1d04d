"""The schema log of a raw layer: which columns and types files brought, when,
and what became of them.

The log lies beside the data (``<raw layer>/_schema_log``), one folder for each
ingest batch that brought something new, written before the batch's data: data
never has a column that the log lacks, and a batch that is run again writes the
same entry again.  Version 0 holds the declared columns; every batch with events
is one version more.

    declared  a column of the declared schema
    added     an unknown column became a column of the layer
    widened   a column took a wider type of the same kind
    rescued   a column's values go to the rescued data
    cast      a file's type differs and is cast to the layer's
    absent    files without the column (null there)
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from meterline.schema import SchemaContractError, accepted_cast
from meterline.session import path_exists

FOLDER = "_schema_log"
EVENT_SCHEMA = ("version int, position int, event string, column_name string, from_type string, to_type string, "
                "files long, first_file string, ingest_batch long")
SHAPING = ("declared", "added", "widened")

# Kinds of types, narrow to wide.
_KINDS = ((T.ByteType, T.ShortType, T.IntegerType, T.LongType), (T.FloatType, T.DoubleType))


@dataclass(frozen=True)
class Evolution:
    """What happens to a column that the layer does not have (``rescue`` its
    values, ``add`` it, ``stop`` the stream) and to one that is wider in a file
    (``cast`` to the layer's type, ``widen`` the layer's, ``stop``)."""
    unknown: str = "rescue"
    wider: str = "cast"

    def __post_init__(self):
        if self.unknown not in ("rescue", "add", "stop") or self.wider not in ("cast", "widen", "stop"):
            raise ValueError(f"unknown evolution policy: {self}")


def is_wider(found: T.DataType, than: T.DataType) -> bool:
    return any(type(found) in kind and type(than) in kind and kind.index(type(found)) > kind.index(type(than)) for kind in _KINDS)


# --- footers ---------------------------------------------------------------

def _signature(path: str) -> str | None:
    """What a file's footer says of its columns; None where the file system is
    one that only Spark reads.  Files of one signature have one Spark schema."""
    import pyarrow.fs as fs
    import pyarrow.parquet as pq
    try:
        system, name = fs.FileSystem.from_uri(path.replace("file:///", "/") if path.startswith("file:///") else path)
    except (pa.ArrowInvalid, OSError, ImportError):
        return None
    with system.open_input_file(name) as f:
        meta = pq.read_metadata(f)
    columns = [(c.path, c.physical_type, c.length, str(c.logical_type), c.max_definition_level, c.max_repetition_level)
               for c in map(meta.schema.column, range(len(meta.schema)))]
    spark = (meta.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata", b"")
    return json.dumps([columns, spark.decode("utf-8", "replace")])


def footers(files: DataFrame) -> DataFrame:
    """(signature, paths) of the files in ``path``: one task for each slice of
    them reads footers, one aggregation groups."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths = batch.column(0).to_pylist()
            yield pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()),
                                              "signature": pa.array([_signature(p) for p in paths], pa.string())})
    return (files.select("path").mapInArrow(sign, "path string, signature string")
            .groupBy("signature").agg(F.sort_array(F.collect_list("path")).alias("paths")))


# --- the log ---------------------------------------------------------------

def read_log(spark: SparkSession, sink: str) -> DataFrame | None:
    """All events of the raw layer at ``sink``; None before its first batch."""
    path = f"{sink}/{FOLDER}"
    return spark.read.schema(EVENT_SCHEMA).parquet(path) if path_exists(spark, path) else None


def _fold(events: list) -> T.StructType:
    shape: dict[str, tuple[str, str]] = {}
    for e in sorted(events, key=lambda e: (e["version"], e["position"])):
        if e["event"] in SHAPING:
            name = e["column_name"] if e["event"] != "widened" else shape[e["column_name"].lower()][0]
            shape[e["column_name"].lower()] = (name, e["to_type"])
    return T.StructType([T.StructField(n, T.DataType.fromDDL(t)) for n, t in shape.values()])


def schema_at(spark: SparkSession, sink: str, version: int | None = None) -> T.StructType | None:
    """The layer's business columns at ``version`` (default: now)."""
    log = read_log(spark, sink)
    if log is None:
        return None
    rows = log.filter(F.lit(version is None) | (F.col("version") <= (version or 0))).collect()  # a row for each change
    return _fold(rows) or None


def evolve(log: DataFrame | None, batch: int, declared: T.StructType, groups: list[tuple[T.StructType, list[str]]],
           policy: Evolution) -> tuple[T.StructType, list[tuple]]:
    """The layer's schema from ``batch`` on and the new events of the log, from
    (file schema, paths) groups.  Entries of this and later batches (of a run
    that died) are left out, so a repeated batch finds the same events."""
    past = [] if log is None else log.filter(F.col("ingest_batch") < batch).collect()
    events: list[tuple] = []
    if not past:
        events = [(0, k, "declared", f.name, None, f.dataType.simpleString(), 0, None, batch) for k, f in enumerate(declared.fields)]
        shape = {f.name.lower(): f for f in declared.fields}
    else:
        shape = {f.name.lower(): f for f in _fold(past).fields}
    known = {(e["event"], e["column_name"].lower(), e["from_type"]) for e in past}
    version = 1 + max((e["version"] for e in past), default=0)

    found: dict[tuple[str, T.DataType | None], tuple[str, list[str]]] = {}
    for schema, paths in groups:
        have = {f.name.lower() for f in schema.fields}
        for f in schema.fields:
            found.setdefault((f.name.lower(), f.dataType), (f.name, []))[1].extend(paths)
        for key, f in shape.items():
            if key not in have:
                found.setdefault((key, None), (f.name, []))[1].extend(paths)

    def note(event: str, name: str, from_type: T.DataType | None, to_type: T.DataType | None, paths: list[str]) -> None:
        text = [t.simpleString() if t is not None else None for t in (from_type, to_type)]
        if (event, name.lower(), text[0]) not in known or event in ("added", "widened"):
            events.append((version, len(events), event, name, *text, len(paths), min(paths), batch))

    # The type that most files have decides first; names settle the rest.
    for (key, kind), (name, paths) in sorted(found.items(), key=lambda x: (x[0][0], -len(x[1][1]), str(x[0][1]))):
        if kind is None:
            note("absent", name, None, shape[key].dataType, paths)
        elif key not in shape:
            if policy.unknown == "stop":
                raise SchemaContractError(f"column {name}: not in the layer ({min(paths)})")
            if policy.unknown == "add" and not isinstance(kind, T.NullType):
                shape[key] = T.StructField(name, kind)
                note("added", name, None, kind, paths)
            else:
                note("rescued", name, kind, None, paths)
        elif kind != shape[key].dataType:
            target = shape[key].dataType
            if is_wider(kind, target) and policy.wider == "stop":
                raise SchemaContractError(f"column {name}: {kind.simpleString()} is wider than {target.simpleString()} ({min(paths)})")
            if is_wider(kind, target) and policy.wider == "widen":
                shape[key] = T.StructField(shape[key].name, kind)
                note("widened", name, target, kind, paths)
            elif accepted_cast(kind, target):
                note("cast", name, kind, target, paths)
            elif key in {f.name.lower() for f in declared.fields}:
                raise SchemaContractError(f"column {shape[key].name}: {kind.simpleString()} is not compatible with {target.simpleString()} ({min(paths)})")
            else:
                note("rescued", name, kind, None, paths)
    return T.StructType(list(shape.values())), events


def append(spark: SparkSession, sink: str, batch: int, events: list[tuple]) -> None:
    if events:
        spark.createDataFrame(events, EVENT_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{sink}/{FOLDER}/batch={batch}")
