"""Schema contracts for the raw and clean trip layers, and the checks on them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# ---------------------------------------------------------------------------
# Names, order and types of the raw and clean layers.
MONEY_COLUMNS = (
    "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
    "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee",
)

# Raw trip record: the 18 business columns in source order.  Integer widths are
# this engine's declaration (the source files do not state them).
RAW_SCHEMA = T.StructType([
    T.StructField("VendorID", T.LongType()),
    T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
    T.StructField("passenger_count", T.LongType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("RatecodeID", T.LongType()),
    T.StructField("PUlocationID", T.IntegerType()),
    T.StructField("DOlocationID", T.IntegerType()),
    T.StructField("payment_type", T.LongType()),
    T.StructField("fare_amount", T.DoubleType()),
    T.StructField("extra", T.DoubleType()),
    T.StructField("mta_tax", T.DoubleType()),
    T.StructField("tip_amount", T.DoubleType()),
    T.StructField("tolls_amount", T.DoubleType()),
    T.StructField("improvement_surcharge", T.DoubleType()),
    T.StructField("total_amount", T.DoubleType()),
    T.StructField("congestion_surcharge", T.DoubleType()),
    T.StructField("airport_fee", T.DoubleType()),
])
RAW_COLUMNS = tuple(f.name for f in RAW_SCHEMA.fields)

LINEAGE_COLUMNS = ("_ingestion_time", "_source_file")

# Types after casting (before code columns become labels).
CAST_TYPES = {
    "VendorID": "int", "PUlocationID": "int",
    "tpep_pickup_datetime": "timestamp", "tpep_dropoff_datetime": "timestamp",
    "DOlocationID": "int", "payment_type": "int", "passenger_count": "int",
    "trip_distance": "double", "RatecodeID": "int",
    **{c: "double" for c in MONEY_COLUMNS},
}

# Clean layer column order.
CLEAN_COLUMNS = (
    "VendorID", "PUlocationID", "tpep_pickup_datetime", "tpep_dropoff_datetime",
    "DOlocationID", "trip_distance", "trip_time_minutes", "avg_speed", "passenger_count",
    "RatecodeID", "payment_type", "fare_amount", "extra", "mta_tax",
    "tip_amount", "tolls_amount", "improvement_surcharge", "congestion_surcharge",
    "airport_fee", "total_amount", *LINEAGE_COLUMNS,
)

CLEAN_SCHEMA = T.StructType([
    T.StructField("VendorID", T.StringType()),
    T.StructField("PUlocationID", T.StringType()),
    T.StructField("tpep_pickup_datetime", T.TimestampType()),
    T.StructField("tpep_dropoff_datetime", T.TimestampType()),
    T.StructField("DOlocationID", T.StringType()),
    T.StructField("trip_distance", T.DoubleType()),
    T.StructField("trip_time_minutes", T.IntegerType()),
    T.StructField("avg_speed", T.DoubleType()),
    T.StructField("passenger_count", T.IntegerType()),
    T.StructField("RatecodeID", T.StringType()),
    T.StructField("payment_type", T.StringType()),
    *[T.StructField(c, T.DoubleType()) for c in (
        "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
        "improvement_surcharge", "congestion_surcharge", "airport_fee", "total_amount")],
    T.StructField("_ingestion_time", T.TimestampType()),
    T.StructField("_source_file", T.StringType()),
])

# ---------------------------------------------------------------------------

# Casts accepted when a file's column type differs from the contract.
_CASTS = {
    (T.IntegerType, T.LongType), (T.ShortType, T.IntegerType), (T.ShortType, T.LongType),
    (T.ByteType, T.IntegerType), (T.ByteType, T.LongType), (T.ByteType, T.ShortType),
    (T.IntegerType, T.DoubleType), (T.LongType, T.DoubleType), (T.FloatType, T.DoubleType),
    (T.TimestampType, T.TimestampNTZType), (T.TimestampNTZType, T.TimestampType),
    # Ids stored wider than declared; a value beyond int raises under ANSI mode.
    (T.LongType, T.IntegerType),
}


# Floating-point files for integer contract columns (trip files store codes
# and passenger counts as double in some years): ``try_cast``, so fractions
# truncate as the source's cast does and NaN or overflow become null.
_FLOAT_TO_INTEGER = {
    (T.DoubleType, T.LongType), (T.DoubleType, T.IntegerType),
    (T.FloatType, T.LongType), (T.FloatType, T.IntegerType),
}


def accepted_cast(have: T.DataType, want: T.DataType) -> bool:
    """Whether ``conform`` takes a column of type ``have`` for one of ``want``."""
    pair = (type(have), type(want))
    return have == want or pair in _CASTS or pair in _FLOAT_TO_INTEGER or isinstance(have, T.DecimalType) and isinstance(want, T.NumericType)


class SchemaContractError(ValueError):
    """A column's type cannot be brought to the contract."""


def conform(df: DataFrame, contract: T.StructType = RAW_SCHEMA, keep_extra: bool = True) -> DataFrame:
    """Bring ``df`` to ``contract``: cast compatible types, add absent columns as
    nulls (files written before a column existed), and fail loudly on an
    incompatible type.  Extra columns (such as lineage) are kept after the
    contract's columns unless ``keep_extra`` is false.

    Names match case-insensitively, as Spark resolves them (trip files spell
    ``PULocationID`` or ``Airport_fee``); the output uses the contract's
    spelling.
    """
    actual = {f.name.lower(): (f.name, f.dataType) for f in df.schema.fields}
    out: list[Column] = []
    for field in contract.fields:
        name, have = actual.get(field.name.lower(), (None, None))
        if have is None:
            out.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif have == field.dataType:
            out.append(F.col(name).alias(field.name))
        elif (type(have), type(field.dataType)) in _CASTS or isinstance(have, T.DecimalType):
            out.append(F.col(name).cast(field.dataType).alias(field.name))
        elif (type(have), type(field.dataType)) in _FLOAT_TO_INTEGER:
            out.append(F.col(name).try_cast(field.dataType).alias(field.name))
        else:
            raise SchemaContractError(
                f"column {field.name}: {have.simpleString()} is not compatible with "
                f"{field.dataType.simpleString()}")
    names = {f.name.lower() for f in contract.fields}
    extra = [F.col(c) for c in df.columns if c.lower() not in names] if keep_extra else []
    return df.select(*out, *extra)


def schema_check(df: DataFrame, contract: T.StructType = RAW_SCHEMA) -> DataFrame:
    """One row per contract column: expected and actual type, whether they
    match, and how many non-null values would not survive the cast to the
    expected type (one pass over the data).
    """
    actual = {f.name.lower(): f.dataType for f in df.schema.fields}
    checks = []
    for field in contract.fields:
        have = actual.get(field.name.lower())
        if have is None:
            bad = F.lit(0).cast("bigint")
        else:
            value = F.col(field.name)
            bad = F.count_if(value.isNotNull() & value.try_cast(field.dataType).isNull())
        checks.append(bad.alias(field.name))
    counts = df.agg(*checks)
    rows = []
    for field in contract.fields:
        have = actual.get(field.name.lower())
        rows.append(F.struct(
            F.lit(field.name).alias("column_name"),
            F.lit(field.dataType.simpleString()).alias("expected_type"),
            F.lit(have.simpleString() if have is not None else None).cast("string").alias("actual_type"),
            F.lit(have == field.dataType).alias("type_ok"),
            F.col(field.name).cast("bigint").alias("nonconforming_values"),
        ))
    return counts.select(F.inline(F.array(*rows)))
