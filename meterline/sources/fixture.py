"""Trip records and zone dimension derived from the provided TPC-H-style tables.

The trip data is a pure projection of ``lineitem`` (one trip per line item,
plus an exact second copy of every line of each 50th order), so it scales
linearly with the input and needs no shuffle.  The expressions are valid
unchanged in Spark SQL and in DuckDB; money is built in integer cents so the
doubles agree bit for bit between engines.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline.schema import RAW_COLUMNS, RAW_SCHEMA
from meterline.session import scratch_path

# ---------------------------------------------------------------------------
# The trip fixture definition (FIXTURES.md section 2).  Each
# layer is evaluated over the one above it; layer 5 gives the raw columns.
FIXTURE_LAYERS = (
    (  # layer 1, from lineitem
        ("ok", "l_orderkey"),
        ("pk", "l_partkey"),
        ("sk", "l_suppkey"),
        ("ln", "l_linenumber"),
        ("rf", "l_returnflag"),
        ("ls", "l_linestatus"),
        ("sd", "l_shipdate"),
        ("q", "cast(l_quantity as int)"),
        ("dp", "cast(round(l_discount*100) as int)"),
        ("tx", "cast(round(l_tax*100) as int)"),
        ("p", "cast(round(l_extendedprice*100) as bigint)/1e6"),
    ),
    (  # layer 2
        ("dist_h", "cast(floor(p*p*p*p*1.2e0 + p*100e0) as bigint) - 20"),
    ),
    (  # layer 3
        ("fare0_c", "dist_h * 3 + 300"),
    ),
    (  # layer 4
        ("fare_c", "case when ok % 97 = 0 then -fare0_c else fare0_c end"),
        ("tip_c", "case when ok % 89 = 0 then -100 else cast(floor(fare0_c*dp/50e0) as bigint) end"),
        ("tolls_c", "case when ok % 83 = 0 then -100 else tx*100 end"),
        ("extra_c", "case when ls='O' then 100 else 50 end"),
        ("mta_c", "50"),
        ("imp_c", "100"),
        ("cong_c", "case when ln % 3 = 0 then null else 250 end"),
        ("air_c", "case when ln % 4 = 0 then 125 else null end"),
        ("pu", "sd + (9863*86400 + ((ok*7+ln*131) % 1440)*60) * interval '1' second"),
        ("dur_s", "225*q - 225 - case when rf='A' then 30 else 0 end"),
    ),
    (  # layer 5, the raw trip columns
        ("VendorID", "cast(case sk % 5 when 0 then 1 when 1 then 2 when 2 then 6 when 3 then 7 end as bigint)"),
        ("tpep_pickup_datetime", "pu"),
        ("tpep_dropoff_datetime", "pu + dur_s * interval '1' second"),
        ("passenger_count", "cast(case when dp=10 then null else ln-1 end as bigint)"),
        ("trip_distance", "dist_h/100e0"),
        ("RatecodeID", "cast(case pk % 9 when 0 then null when 7 then 99 when 8 then 7 else pk % 9 end as bigint)"),
        ("PUlocationID", "cast(case when pk % 31 = 0 then null else pk % 27 end as int)"),
        ("DOlocationID", "cast(ok % 27 as int)"),
        ("payment_type", "cast(case ok % 9 when 7 then null else ok % 9 end as bigint)"),
        ("fare_amount", "fare_c/100e0"),
        ("extra", "extra_c/100e0"),
        ("mta_tax", "mta_c/100e0"),
        ("tip_amount", "tip_c/100e0"),
        ("tolls_amount", "tolls_c/100e0"),
        ("improvement_surcharge", "imp_c/100e0"),
        ("total_amount", "case when sk % 10 = 9 then 0e0 else cast(floor((fare_c+extra_c+mta_c+tip_c+tolls_c+imp_c+coalesce(cong_c,0)+coalesce(air_c,0)) * (case sk % 10 when 3 then 105 when 5 then 102 else 100 end)/100e0) as bigint)/100e0 end"),
        ("congestion_surcharge", "cong_c/100e0"),
        ("airport_fee", "air_c/100e0"),
    ),
)
DUPLICATE_EVERY_ORDER = 50  # orders with ok % 50 = 0 appear twice
# ---------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One provided table by name (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def trips_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Raw trip records (18 columns, raw types) from a ``lineitem`` frame."""
    df = lineitem
    for layer in FIXTURE_LAYERS:
        df = df.select("*", *[F.expr(expr).alias(name) for name, expr in layer])
    copies = df.filter(F.col("ok") % DUPLICATE_EVERY_ORDER == 0)
    return df.unionAll(copies).select(*RAW_COLUMNS)


def read_trip_files(spark: SparkSession, *paths: str) -> DataFrame:
    """Batch backfill of raw trip files whose schemas differ over the years.

    Each path (say, one folder per year) is read with Parquet schema merging
    (columns added later), brought to the raw contract (absent columns as
    nulls, widening casts, doubles into integer codes, an error on anything
    else), and the groups are unioned by name.  Paths whose types conflict
    with each other (long in one year, double in another) are therefore
    passed separately."""
    from meterline.schema import conform
    frames = [conform(spark.read.option("mergeSchema", "true").parquet(p), RAW_SCHEMA, keep_extra=False)
              for p in paths]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zone rows with their file position ``_pos`` (path, row index)."""
    nation = table(spark, sf_dir, "nation")
    position = F.struct(F.col("_metadata.file_path"), F.col("_metadata.row_index")).alias("_pos")
    return nation.select(F.col("n_nationkey").cast("int").alias("LocationID"), F.col("n_name").alias("zone"),
                         position)


def fixture_sql() -> str:
    """The same trip fixture as one DuckDB/ANSI query over ``lineitem``."""
    sql = "lineitem"
    for i, layer in enumerate(FIXTURE_LAYERS, start=1):
        cols = ", ".join(f"{expr} AS {name}" for name, expr in layer)
        sql = f"(SELECT *, {cols} FROM {sql}) AS l{i}"
    raw = ", ".join(RAW_COLUMNS)
    body = sql
    return (f"SELECT {raw} FROM {body} UNION ALL "
            f"SELECT {raw} FROM {body} WHERE ok % {DUPLICATE_EVERY_ORDER} = 0")


_STAGED: dict[tuple[str, str], str] = {}


def spread(df: DataFrame) -> DataFrame:
    """A frame with fewer partitions than the cluster has cores (one big
    unsplittable input file) is spread round-robin, so the work on it runs in
    parallel; wider inputs are returned as they are (no shuffle)."""
    parallelism = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(parallelism) if df.rdd.getNumPartitions() < parallelism else df


def landing_path(spark: SparkSession, sf_dir: str) -> str:
    """Raw trip files for ``sf_dir``, written once per application under the
    shared checkpoint folder: the raw layer that later layers read, as trip
    files on storage are in production."""
    key = (spark.sparkContext.applicationId, os.path.abspath(sf_dir))
    path = _STAGED.get(key)
    if path is None:
        path = scratch_path(spark, "landing")
        trips_from_lineitem(spread(table(spark, sf_dir, "lineitem"))).write.parquet(path)
        _STAGED[key] = path
    return path


def staged_raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw trip layer (18 columns, raw contract types) read from files."""
    return spark.read.schema(RAW_SCHEMA).parquet(landing_path(spark, sf_dir))
