"""Attribute tables in dBASE files (``.dbf``, the attribute part of a shapefile)
as a Spark data source.

    spark.dataSource.register(DbfDataSource)
    spark.read.format("dbf").option("position", True).load(path)   # file or folder
    df.write.format("dbf").save(path)                               # a file for each task

Records have one width, so a file is read in ranges of records, each by a task of
its own that seeks to its first one.  ``position`` adds ``_file`` and ``_record``
(number in the file, from 0).  Deleted records are left out; blank numbers, dates
and flags are null, and so is blank text.
"""

from __future__ import annotations

import datetime as dt
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

# The file format.
HEADER = struct.Struct("<BBBBIHH20x")   # version, year, month, day, records, header bytes, record bytes
FIELD = struct.Struct("<11sc4xBB14x")   # name, kind, width, decimals
VERSION, FIELDS_END, FILE_END, DELETED = 3, b"\r", b"\x1a", b"*"
LONGEST_TEXT = 254

RECORDS_PER_TASK = 1_000_000
CHUNK_BYTES = 1 << 20


@dataclass(frozen=True)
class Field:
    name: str
    kind: str
    width: int
    decimals: int

    def spark_type(self) -> T.DataType:
        if self.kind == "N" and not self.decimals:
            return T.LongType() if self.width <= 18 else T.DecimalType(min(self.width, 38), 0)
        return {"N": T.DoubleType(), "F": T.DoubleType(), "L": T.BooleanType(), "D": T.DateType()}.get(self.kind, T.StringType())

    def parse(self, raw: bytes, encoding: str):
        text = raw.decode(encoding, "replace").rstrip(" \0")
        if self.kind not in "NFLD":
            return text or None
        text = text.strip()
        if not text or set(text) <= {"*", "?"}:  # blank or overflowed
            return None
        if self.kind == "L":
            return text in "TtYy"
        if self.kind == "D":
            return dt.datetime.strptime(text, "%Y%m%d").date()
        if self.kind == "F" or self.decimals:
            return float(text)
        if self.width > 18:
            from decimal import Decimal
            return Decimal(text)
        return int(text)


@dataclass(frozen=True)
class Layout:
    records: int
    start: int
    width: int
    fields: tuple


def _open(path: str):
    """The file system of ``path`` and the name in it."""
    import pyarrow.fs as fs
    return fs.FileSystem.from_uri(path) if "://" in path else fs.FileSystem.from_uri(path[5:] if path.startswith("file:") else path)


def _files(path: str) -> list[str]:
    import pyarrow.fs as fs
    system, name = _open(path)
    info = system.get_file_info(name)
    if info.type == fs.FileType.File:
        return [path]
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = system.get_file_info(fs.FileSelector(name))
    return sorted(f"{path.rstrip('/')}/{f.base_name}" for f in found
                  if f.type == fs.FileType.File and f.base_name.lower().endswith(".dbf") and not f.base_name.startswith(("_", ".")))


def read_layout(path: str) -> Layout:
    system, name = _open(path)
    with system.open_input_file(name) as f:
        head = f.read(HEADER.size)
        if len(head) < HEADER.size:
            raise ValueError(f"not a dBASE file: {path}")
        _, _, _, _, records, start, width = HEADER.unpack(head)
        described = f.read(max(0, start - HEADER.size))
        fields = []
        for at in range(0, len(described) - FIELD.size + 1, FIELD.size):
            if described[at:at + 1] == FIELDS_END:
                break
            field, kind, size, decimals = FIELD.unpack_from(described, at)
            fields.append(Field(field.split(b"\0")[0].decode("ascii", "replace"), kind.decode("latin-1"), size, decimals))
        if not fields or 1 + sum(x.width for x in fields) != width:
            raise ValueError(f"not a dBASE file: {path}")
        # A file cut short holds fewer records than it says.
        whole = max(0, (f.size() - start) // width)
    return Layout(min(records, whole), start, width, tuple(fields))


@dataclass
class Range(InputPartition):
    path: str
    layout: Layout
    first: int
    last: int


class DbfReader(DataSourceReader):
    def __init__(self, path: str, schema: T.StructType, position: bool, encoding: str, records_per_task: int):
        self.path, self.schema, self.position, self.encoding, self.step = path, schema, position, encoding, records_per_task

    def partitions(self) -> list[Range]:
        out = []
        for path in _files(self.path):
            layout = read_layout(path)
            out += [Range(path, layout, k, min(k + self.step, layout.records)) for k in range(0, layout.records, self.step)]
        return out or [Range("", Layout(0, 0, 1, ()), 0, 0)]

    def read(self, part: Range) -> Iterator[tuple]:
        if part.first == part.last:
            return
        at, places = 1, {}
        for f in part.layout.fields:
            places[f.name.lower()] = (f, at, at + f.width)
            at += f.width
        wanted = [places.get(n.lower()) for n in self.schema.names[:len(self.schema.names) - 2 * self.position]]
        system, name = _open(part.path)
        width, per_chunk = part.layout.width, max(1, CHUNK_BYTES // part.layout.width)
        with system.open_input_file(name) as f:
            f.seek(part.layout.start + part.first * width)
            for k in range(part.first, part.last, per_chunk):
                data = f.read(width * min(per_chunk, part.last - k))
                for n in range(len(data) // width):
                    row = data[n * width:(n + 1) * width]
                    if row[:1] != DELETED:
                        values = tuple(x and x[0].parse(row[x[1]:x[2]], self.encoding) for x in wanted)
                        yield values + ((part.path, k + n) if self.position else ())


def described(field: T.StructField) -> Field:
    """How a column is written; text is cut by nothing, so it must fit."""
    kind = field.dataType
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType)):
        return Field(field.name, "N", 11, 0)
    if isinstance(kind, T.LongType):
        return Field(field.name, "N", 18, 0)
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return Field(field.name, "F", 24, 0)
    if isinstance(kind, T.BooleanType):
        return Field(field.name, "L", 1, 0)
    if isinstance(kind, T.DateType):
        return Field(field.name, "D", 8, 0)
    if isinstance(kind, T.StringType):
        return Field(field.name, "C", LONGEST_TEXT, 0)
    raise TypeError(f"column {field.name}: {kind.simpleString()} has no dBASE form")


def packed(field: Field, value, encoding: str) -> bytes:
    if value is None:
        text = ""
    elif field.kind == "L":
        text = "T" if value else "F"
    elif field.kind == "D":
        text = value.strftime("%Y%m%d")
    else:
        text = repr(float(value)) if field.kind == "F" else str(value)
    data = text.encode(encoding)
    if len(data) > field.width:
        raise ValueError(f"column {field.name}: {len(data)} bytes do not fit in {field.width}")
    return data.rjust(field.width) if field.kind in "NF" else data.ljust(field.width)


@dataclass
class Written(WriterCommitMessage):
    temporary: str
    final: str


class DbfWriter(DataSourceWriter):
    """A task writes one file under a hidden name; the commit gives it its name."""

    def __init__(self, path: str, schema: T.StructType, overwrite: bool, encoding: str):
        self.path, self.overwrite, self.encoding, self.job = path.rstrip("/"), overwrite, encoding, uuid.uuid4().hex
        self.fields = tuple(map(described, schema.fields))
        for f in self.fields:
            if len(f.name.encode("ascii")) > 10:
                raise ValueError(f"column {f.name}: dBASE names have 10 letters at most")

    def write(self, rows: Iterator) -> Written:
        from pyspark import TaskContext
        context = TaskContext.get()
        name = f"part-{context.partitionId():05d}-{self.job}.dbf"
        hidden = f"{self.path}/_{context.taskAttemptId()}-{name}"
        system, target = _open(hidden)
        system.create_dir(target.rpartition("/")[0], recursive=True)
        body, count = bytearray(), 0
        start, width = HEADER.size + FIELD.size * len(self.fields) + 1, 1 + sum(f.width for f in self.fields)
        with system.open_output_stream(f"{target}.rows") as out:
            for row in rows:
                body += b" " + b"".join(packed(f, v, self.encoding) for f, v in zip(self.fields, row))
                count += 1
                if len(body) >= CHUNK_BYTES:
                    out.write(bytes(body))
                    body.clear()
            out.write(bytes(body) + FILE_END)
        with system.open_output_stream(target) as out, system.open_input_stream(f"{target}.rows") as rest:
            out.write(HEADER.pack(VERSION, 100, 1, 1, count, start, width))
            out.write(b"".join(FIELD.pack(f.name.encode(), f.kind.encode(), f.width, f.decimals) for f in self.fields) + FIELDS_END)
            while data := rest.read(CHUNK_BYTES):
                out.write(data)
        system.delete_file(f"{target}.rows")
        return Written(hidden, f"{self.path}/{name}")

    def commit(self, messages: list) -> None:
        old = []
        if self.overwrite:
            try:
                old = _files(self.path)
            except FileNotFoundError:
                pass
        for m in filter(None, messages):
            system, source = _open(m.temporary)
            system.move(source, _open(m.final)[1])
        for path in old:
            system, name = _open(path)
            system.delete_file(name)

    def abort(self, messages: list) -> None:
        for m in filter(None, messages):
            system, name = _open(m.temporary)
            system.delete_file(name)


class DbfDataSource(DataSource):
    """Options: ``position`` (false), ``encoding`` (utf-8), ``recordsPerTask``."""

    @classmethod
    def name(cls) -> str:
        return "dbf"

    def _option(self, name: str, default: str) -> str:
        return next((v for k, v in self.options.items() if k.lower() == name.lower()), default)

    def schema(self) -> T.StructType:
        files = _files(self.options["path"])
        if not files:
            raise ValueError(f"no dBASE file in {self.options['path']}")
        fields = [T.StructField(f.name, f.spark_type()) for f in read_layout(files[0]).fields]
        if self._option("position", "false").lower() == "true":
            fields += [T.StructField("_file", T.StringType()), T.StructField("_record", T.LongType())]
        return T.StructType(fields)

    def reader(self, schema: T.StructType) -> DbfReader:
        return DbfReader(self.options["path"], schema, self._option("position", "false").lower() == "true",
                         self._option("encoding", "utf-8"), int(self._option("recordsPerTask", str(RECORDS_PER_TASK))))

    def writer(self, schema: T.StructType, overwrite: bool) -> DbfWriter:
        return DbfWriter(self.options["path"], schema, overwrite, self._option("encoding", "utf-8"))
