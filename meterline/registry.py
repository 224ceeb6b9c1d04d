"""Named queries over the provided tables: ``name -> f(spark, sf_dir) -> DataFrame``.

Trip queries read the raw trip layer derived from ``lineitem`` (staged once
per application as Parquet files, see ``sources.fixture.landing_path``) and
the zone dimension derived from ``nation``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterline import operators as O
from meterline.operators import gold as G
from meterline.operators.sketches import merged, quantiles, rank_bound, rank_errors, sequential_iqr
from meterline.plans.deltas import maintain, read_clean, read_gold
from meterline.plans.layers import MONTH_KEY, read_layer, run_layers
from meterline.plans.quality import merged_metrics, profile_aggregates, quality_report
from meterline.plans.silver import clean_core, clean_trips, typed_trips
from meterline.schema import LINEAGE_COLUMNS, MONEY_COLUMNS, RAW_COLUMNS, RAW_SCHEMA, schema_check
from meterline.session import configure, scratch_path
from meterline.sources.dbf import DbfDataSource
from meterline.sources.fixture import landing_path, raw_zones, staged_raw_trips, table
from meterline.sources.sinks import materialize
from meterline.sources.zones import sized_zones, zone_dimension
from meterline.streaming.ingest import batch_metrics, ingest, read_ingested
from meterline.streaming.schema_log import Evolution, read_log
from meterline.streaming.watermark import clean_stream, read_outcomes

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return register


def _raw(spark, sf):
    return staged_raw_trips(spark, sf)


def _zones(spark, sf):
    return sized_zones(raw_zones(spark, sf))


def _typed(spark, sf):
    return typed_trips(_raw(spark, sf))


def _clean(spark, sf, **kw):
    return clean_trips(_raw(spark, sf), _zones(spark, sf), **kw)


# --- sources and sinks -------------------------------------------------------

@query("scan_trips")
def q_scan_trips(spark, sf):
    """The raw trip layer as read from its files."""
    return _raw(spark, sf)


@query("zone_dim")
def q_zone_dim(spark, sf):
    """Zone dimension, one row per id."""
    return zone_dimension(raw_zones(spark, sf))


@query("zone_dim_dbf")
def q_zone_dim_dbf(spark, sf):
    """The zone dimension from dBASE attribute records, read in ranges: every id
    comes first with a former name, and its last record wins."""
    spark.dataSource.register(DbfDataSource)
    path = scratch_path(spark, "zones-dbf")
    zones = raw_zones(spark, sf).select("LocationID", "zone").orderBy("LocationID")
    former = zones.withColumn("zone", F.concat(F.lit("Former "), "zone"))
    former.unionAll(zones).coalesce(1).write.format("dbf").mode("append").save(path)
    rows = spark.read.format("dbf").option("position", True).option("recordsPerTask", 7).load(path)
    return zone_dimension(rows.select(F.col("LocationID").cast("int").alias("LocationID"), "zone",
                                      F.struct("_file", "_record").alias("_pos")))


@query("schema_contract")
def q_schema_contract(spark, sf):
    """Trip files of three schemas ingested in one batch: as declared; codes
    stored as double and a wider id; one column missing and one extra (which
    goes to the rescued data)."""
    base, raw = scratch_path(spark, "schemas"), _raw(spark, sf)
    kind = F.pmod("DOlocationID", F.lit(3))
    files = {
        "declared": raw.filter((kind == 0) | kind.isNull()),
        "double": raw.filter(kind == 1).withColumns({
            **{c: F.col(c).cast("double") for c in ("passenger_count", "RatecodeID")},
            "PUlocationID": F.col("PUlocationID").cast("bigint")}),
        "other": raw.filter(kind == 2).drop("airport_fee").withColumn("cbd_congestion_fee", F.lit(0.75)),
    }
    for name, rows in files.items():
        rows.write.parquet(f"{base}/source/{name}")
    result = ingest(spark, f"{base}/source", f"{base}/raw", f"{base}/_checkpoint")
    return read_ingested(spark, result.sink_path).select(*RAW_COLUMNS, F.col("_rescued_data").alias("rescued_data"))


@query("schema_history")
def q_schema_history(spark, sf):
    """The schema log after three drops of trip files, with unknown columns
    added and wider types taken over: as declared; a new fee, long zone ids and
    passengers as double; the fee as long, a new tag and no airport fee.  With
    each event, the values that its column holds in the raw layer now."""
    base, raw = scratch_path(spark, "history"), _raw(spark, sf)
    kind = F.pmod("DOlocationID", F.lit(3))
    drops = (
        raw.filter((kind == 0) | kind.isNull()),
        raw.filter(kind == 1).withColumns({
            "cbd_congestion_fee": F.lit(1), "PUlocationID": F.col("PUlocationID").cast("bigint"),
            "passenger_count": F.col("passenger_count").cast("double")}),
        raw.filter(kind == 2).drop("airport_fee").withColumns({"cbd_congestion_fee": F.lit(2 ** 40), "tag": F.lit("t")}),
    )
    for k, rows in enumerate(drops):
        rows.write.parquet(f"{base}/source/{k}")
        result = ingest(spark, f"{base}/source", f"{base}/raw", f"{base}/_checkpoint", evolution=Evolution("add", "widen"))
    landed = read_ingested(spark, result.sink_path)
    names = [c for c in landed.columns if not c.startswith("_")]
    values = landed.agg(*(F.count(c).alias(c) for c in names)).select(
        F.inline(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).alias("values_now")) for c in names))))
    return (read_log(spark, result.sink_path).join(values, "column_name")
            .select("version", "event", "column_name", "from_type", "to_type", "values_now"))


@query("schema_check")
def q_schema_check(spark, sf):
    """Contract vs the types found in trip files, with values failing the
    cast.  The files store passengers as double, rate codes as text (99 as
    "n/a") and pickup ids as long (26 beyond the range of int), and lack the
    airport fee."""
    path = scratch_path(spark, "check")
    rate, zone = F.col("RatecodeID"), F.col("PUlocationID").cast("bigint")
    (_raw(spark, sf).drop("airport_fee").withColumns({
        "passenger_count": F.col("passenger_count").cast("double"),
        "RatecodeID": F.when(rate == 99, "n/a").otherwise(rate.cast("string")),
        "PUlocationID": F.when(zone == 26, zone + 2 ** 40).otherwise(zone),
    }).write.parquet(path))
    return schema_check(spark.read.parquet(path), RAW_SCHEMA)


@query("ingest_stream")
def q_ingest_stream(spark, sf):
    """Raw trip files streamed into the raw layer (availableNow), read back."""
    base = scratch_path(spark, "ingest")
    result = ingest(spark, landing_path(spark, sf), f"{base}/raw", f"{base}/_checkpoint")
    return read_ingested(spark, result.sink_path).select(*RAW_COLUMNS)


@query("ingest_late_files")
def q_ingest_late_files(spark, sf):
    """Files that arrive in a second step are added to those of the first,
    whatever their order in time: the later half of the rows comes first."""
    base = scratch_path(spark, "late")
    late = F.col("tpep_pickup_datetime") < F.lit("2024-06-01").cast("timestamp_ntz")
    raw = _raw(spark, sf)
    for part in (raw.filter(~F.coalesce(late, F.lit(False))), raw.filter(late)):
        part.write.mode("append").parquet(f"{base}/source")
        result = ingest(spark, f"{base}/source", f"{base}/raw", f"{base}/_checkpoint")
    return read_ingested(spark, result.sink_path).select(*RAW_COLUMNS)


@query("ingest_lineage")
def q_ingest_lineage(spark, sf):
    """Lineage after ingest: per source partition (pickup year), rows, rows
    stamped with an ingestion time, and rows whose recorded source file lies
    in that partition's directory."""
    base = scratch_path(spark, "lineage")
    source = f"{base}/source"
    (_raw(spark, sf).withColumn("src_year", F.year("tpep_pickup_datetime"))
     .write.partitionBy("src_year").parquet(source))
    result = ingest(spark, source, f"{base}/raw", f"{base}/_checkpoint")
    landed = read_ingested(spark, result.sink_path)
    year = F.year("tpep_pickup_datetime")
    path_year = F.regexp_extract("_source_file", r"/src_year=(\d+)/", 1).cast("int")
    return (landed.groupBy(year.alias("source_year")).agg(
        F.count(F.lit(1)).alias("trips"),
        F.count_if(F.col("_ingestion_time").isNotNull()).alias("stamped_trips"),
        F.count_if(path_year == year).alias("traced_trips")))


@query("events_stream")
def q_events_stream(spark, sf):
    """The events table streamed through the same ingest (glob source)."""
    base = scratch_path(spark, "events")
    schema = table(spark, sf, "events").schema
    result = ingest(spark, f"{sf.rstrip('/')}/events*.parquet", f"{base}/raw", f"{base}/_checkpoint",
                    schema=schema)
    return read_ingested(spark, result.sink_path, schema).select(*schema.names)


@query("layers_gold_trips")
def q_layers_gold_trips(spark, sf):
    """The whole layered job (ingest -> written clean layer -> three aggregate
    tables); returns the trip-metrics table as written."""
    run = run_layers(spark, landing_path(spark, sf), scratch_path(spark, "layers"), _zones(spark, sf))
    return read_layer(spark, run, "gold_trips")


@query("layers_gold_bucket")
def q_layers_gold_bucket(spark, sf):
    """The distance-band table as the layered job writes it."""
    run = run_layers(spark, landing_path(spark, sf), scratch_path(spark, "layers"), _zones(spark, sf))
    return read_layer(spark, run, "gold_bucket")


@query("layers_gold_passengers")
def q_layers_gold_passengers(spark, sf):
    """The passenger table as the layered job writes it."""
    run = run_layers(spark, landing_path(spark, sf), scratch_path(spark, "layers"), _zones(spark, sf))
    return read_layer(spark, run, "gold_passengers")


def _drops(spark, sf):
    """The raw layer in three drops of files, rows dealt out by position, so
    copies of a trip come in different drops."""
    raw = _raw(spark, sf).withColumn("_drop", F.monotonically_increasing_id() % 3)
    return [raw.filter(F.col("_drop") == k).drop("_drop") for k in (2, 0, 1)]


def _maintained(spark, sf, **options):
    base = scratch_path(spark, "deltas")
    for drop in _drops(spark, sf):
        drop.write.mode("append").parquet(f"{base}/landing")
        snapshot = maintain(spark, f"{base}/landing", f"{base}/layers", _zones(spark, sf), **options)
    return snapshot


@query("delta_gold_trips")
def q_delta_gold_trips(spark, sf):
    """Trip metrics kept by signed deltas over three drops of files."""
    return read_gold(spark, _maintained(spark, sf), "gold_trips")


@query("delta_gold_bucket")
def q_delta_gold_bucket(spark, sf):
    """Distance-band metrics kept by signed deltas."""
    return read_gold(spark, _maintained(spark, sf), "gold_bucket")


@query("delta_gold_passengers")
def q_delta_gold_passengers(spark, sf):
    """Passenger metrics kept by signed deltas, partials and key index merged
    into one run on the way."""
    return read_gold(spark, _maintained(spark, sf, compact_every=2), "gold_passengers")


@query("delta_clean")
def q_delta_clean(spark, sf):
    """The clean layer as the deltas keep it: appended survivors less those that
    later drops replaced."""
    return read_clean(spark, _maintained(spark, sf), _zones(spark, sf)).drop(*LINEAGE_COLUMNS)


@query("watermark_clean")
def q_watermark_clean(spark, sf):
    """Streamed cleaning with duplicates dropped within a watermark: trips come
    in three drops by time, then some of the first months again, once as they
    were and once as trips that were never seen.  Rows by outcome."""
    base, raw = scratch_path(spark, "watermark"), _raw(spark, sf)
    pickup = F.col("tpep_pickup_datetime")
    at = lambda day: F.lit(day).cast("timestamp_ntz")
    early = raw.filter(pickup < at("2023-07-01"))
    zone = F.col("DOlocationID") % 7
    drops = (
        raw.filter(pickup < at("2024-01-01")), raw.filter((pickup >= at("2024-01-01")) & (pickup < at("2025-01-01"))),
        raw.filter(pickup >= at("2025-01-01")),
        early.filter(zone == 1).unionAll(early.filter(zone == 0).withColumn("passenger_count", F.coalesce("passenger_count", F.lit(0)) + 10)),
    )
    for k, rows in enumerate(drops):
        rows.write.parquet(f"{base}/source/{k}")
        result = ingest(spark, f"{base}/source", f"{base}/raw", f"{base}/_ingest")
        clean_stream(spark, result.sink_path, f"{base}/clean")
    return read_outcomes(spark, f"{base}/clean").groupBy("outcome").agg(F.count(F.lit(1)).alias("trips"))


@query("quartiles_sketch")
def q_quartiles_sketch(spark, sf):
    """Quartiles of the clean layer from the sketches of its months alone, each
    held against the exact ranks of its value."""
    columns = ("trip_distance", "total_amount", "tip_amount", "fare_amount")
    run = run_layers(spark, landing_path(spark, sf), scratch_path(spark, "layers"), _zones(spark, sf), sketch_columns=columns)
    found = quantiles(merged(read_layer(spark, run, "sketches"), MONTH_KEY))
    checked = rank_errors(read_layer(spark, run, "clean"), found)
    return checked.select("column_name", "n", "probability", (F.col("rank_error") <= rank_bound()).alias("within_bound"))


@query("iqr_sketch_ranks")
def q_iqr_sketch_ranks(spark, sf):
    """The quartiles that sequential outlier removal by sketches uses, held
    against their exact ranks among the rows each was taken from."""
    _, report = sequential_iqr(_clean(spark, sf))
    return report.select("column_name", "probability", (F.col("rank_error") <= rank_bound()).alias("within_bound"))


@query("materialize_roundtrip")
def q_materialize_roundtrip(spark, sf):
    """Clean layer written as a table with comment and properties, read back."""
    path = scratch_path(spark, "clean")
    return materialize(_clean(spark, sf), path, name="trips_clean_check",
                       comment="Clean and validated trip data.", properties={"quality": "silver"})


@query("clean_trips")
def q_clean_trips(spark, sf):
    """Raw -> clean layer: fill, cast, minutes, rules, money check, dedup,
    speed, code labels, zone names."""
    return _clean(spark, sf)


# --- projections ---------------------------------------------------------------

@query("fill_missing")
def q_fill_missing(spark, sf):
    return O.fill_missing(_raw(spark, sf))


@query("fill_all_numeric")
def q_fill_all_numeric(spark, sf):
    return O.fill_all_numeric(_raw(spark, sf))


@query("cast_columns")
def q_cast_columns(spark, sf):
    return O.cast_columns(O.fill_missing(_raw(spark, sf)))


@query("trip_time")
def q_trip_time(spark, sf):
    return _typed(spark, sf).select("tpep_pickup_datetime", "tpep_dropoff_datetime", "trip_time_minutes")


@query("avg_speed")
def q_avg_speed(spark, sf):
    return (O.add_avg_speed(_typed(spark, sf))
            .select("tpep_pickup_datetime", "trip_distance", "trip_time_minutes", "avg_speed"))


@query("project_clean")
def q_project_clean(spark, sf):
    """Clean rows in clean column order with numeric codes (before labels)."""
    return clean_core(_raw(spark, sf))


def _labelled(spark, sf, column, op):
    return (_typed(spark, sf).withColumn("code", F.col(column)).transform(op).select("code", column))


@query("map_ratecode")
def q_map_ratecode(spark, sf):
    return _labelled(spark, sf, "RatecodeID", O.map_ratecode)


@query("map_payment")
def q_map_payment(spark, sf):
    return _labelled(spark, sf, "payment_type", O.map_payment)


@query("map_vendor")
def q_map_vendor(spark, sf):
    return _labelled(spark, sf, "VendorID", O.map_vendor)


@query("map_zone")
def q_map_zone(spark, sf):
    typed = _typed(spark, sf).select(F.col("PUlocationID").alias("pu_id"), F.col("DOlocationID").alias("do_id"),
                                     "PUlocationID", "DOlocationID")
    return O.map_location_to_zone(typed, _zones(spark, sf))


@query("zone_unknown")
def q_zone_unknown(spark, sf):
    return O.fill_unknown_zones(_clean(spark, sf))


@query("distance_bucket")
def q_distance_bucket(spark, sf):
    return O.add_distance_band(_typed(spark, sf)).select("trip_distance", "distance_bucket")


@query("month_name")
def q_month_name(spark, sf):
    return (O.add_calendar_keys(_typed(spark, sf), "month").transform(O.label_month)
            .select("tpep_pickup_datetime", "pickup_year", "pickup_month"))


@query("day_name")
def q_day_name(spark, sf):
    return (O.add_calendar_keys(_typed(spark, sf), "day").transform(O.label_day)
            .select("tpep_pickup_datetime", "pickup_day"))


@query("calendar_keys")
def q_calendar_keys(spark, sf):
    return (O.add_calendar_keys(_typed(spark, sf), "week")
            .select("tpep_pickup_datetime", "pickup_year", "pickup_month", "pickup_week"))


# --- filters --------------------------------------------------------------------

@query("consistency_filter")
def q_consistency_filter(spark, sf):
    return O.consistency_filter(_typed(spark, sf))


@query("optional_filters")
def q_optional_filters(spark, sf):
    """Validity rules plus the opt-in passenger, vendor and known-zone rules."""
    return O.consistency_filter(_typed(spark, sf), passengers=True, vendors=True, zones=_zones(spark, sf))


@query("validate_financials")
def q_validate_financials(spark, sf):
    return O.validate_financials(_typed(spark, sf))


@query("period_filter")
def q_period_filter(spark, sf):
    return O.period_filter(_raw(spark, sf))


@query("invalid_zones")
def q_invalid_zones(spark, sf):
    return O.invalid_zones(_raw(spark, sf), _zones(spark, sf))


@query("invalid_zone_count")
def q_invalid_zone_count(spark, sf):
    return O.invalid_zone_count(_raw(spark, sf), _zones(spark, sf))


@query("iqr_exact")
def q_iqr_exact(spark, sf):
    """Clean trips without distance outliers, then without total outliers."""
    return O.remove_outliers_iqr(_clean(spark, sf))


@query("iqr_approx")
def q_iqr_approx(spark, sf):
    return O.remove_outliers_iqr(_clean(spark, sf), exact=False)


# --- aggregations -------------------------------------------------------------

@query("dedup_trips")
def q_dedup_trips(spark, sf):
    return O.drop_duplicate_trips(_raw(spark, sf))


@query("duplicate_groups")
def q_duplicate_groups(spark, sf):
    return O.duplicate_groups(_raw(spark, sf))


@query("gold_trips")
def q_gold_trips(spark, sf):
    """Trip metrics by pickup zone and weekday (the daily trip table)."""
    return G.trip_metrics(_clean(spark, sf), "day", ["PUlocationID"])


@query("gold_trips_plain")
def q_gold_trips_plain(spark, sf):
    """The daily trip table with the plain double formula (sum/avg of doubles,
    then round), for comparison with the exact default."""
    return G.trip_metrics(_clean(spark, sf), "day", ["PUlocationID"], exact=False)


@query("tip_percentage")
def q_tip_percentage(spark, sf):
    """Tip share of revenue per payment type on the clean layer."""
    return G.tip_share(_clean(spark, sf), ["payment_type"])


@query("gold_trips_week")
def q_gold_trips_week(spark, sf):
    return G.trip_metrics(_clean(spark, sf), "week", ["PUlocationID", "DOlocationID"])


@query("gold_trips_month")
def q_gold_trips_month(spark, sf):
    return G.trip_metrics(_clean(spark, sf), "month")


@query("gold_bucket")
def q_gold_bucket(spark, sf):
    """Distance-band metrics by pickup zone and weekday."""
    return G.bucket_metrics(_clean(spark, sf), "day", ["PUlocationID"])


@query("gold_bucket_week")
def q_gold_bucket_week(spark, sf):
    return G.bucket_metrics(_clean(spark, sf), "week")


@query("gold_bucket_month")
def q_gold_bucket_month(spark, sf):
    return G.bucket_metrics(_clean(spark, sf), "month", ["PUlocationID"])


@query("gold_passengers")
def q_gold_passengers(spark, sf):
    """Passenger-count metrics by pickup zone and weekday."""
    return G.passenger_metrics(_clean(spark, sf), "day", ["PUlocationID"])


@query("gold_passengers_week")
def q_gold_passengers_week(spark, sf):
    return G.passenger_metrics(_clean(spark, sf), "week", ["DOlocationID"])


@query("gold_passengers_month")
def q_gold_passengers_month(spark, sf):
    return G.passenger_metrics(_clean(spark, sf), "month")


@query("gold_passengers_hour")
def q_gold_passengers_hour(spark, sf):
    """Passenger-count metrics by weekday and pickup hour."""
    return G.passenger_metrics(_clean(spark, sf), "day", by_hour=True)


@query("period_comparison")
def q_period_comparison(spark, sf):
    """Week-over-week trips and revenue per pickup zone."""
    return G.period_comparison(_clean(spark, sf), "week", ["PUlocationID"])


@query("period_comparison_month")
def q_period_comparison_month(spark, sf):
    return G.period_comparison(_clean(spark, sf), "month", [])


@query("gold_trips_iqr")
def q_gold_trips_iqr(spark, sf):
    """Trip metrics by pickup zone and weekday after IQR outlier removal."""
    needed = _clean(spark, sf).select(
        "PUlocationID", "tpep_pickup_datetime", "trip_distance", "trip_time_minutes", "total_amount",
        "fare_amount", "tip_amount", "tolls_amount")
    return G.trip_metrics(O.remove_outliers_iqr(needed), "day", ["PUlocationID"])


@query("null_profile")
def q_null_profile(spark, sf):
    return O.null_counts(_raw(spark, sf))


@query("time_range")
def q_time_range(spark, sf):
    return O.time_range(_raw(spark, sf))


@query("rule_violations")
def q_rule_violations(spark, sf):
    return O.rule_violations(_raw(spark, sf))


@query("financial_split")
def q_financial_split(spark, sf):
    return O.financial_split(_raw(spark, sf))


@query("describe_money")
def q_describe_money(spark, sf):
    return O.describe_columns(_raw(spark, sf), MONEY_COLUMNS)


@query("quartiles_exact")
def q_quartiles_exact(spark, sf):
    return O.quartile_report(_clean(spark, sf))


@query("row_count")
def q_row_count(spark, sf):
    return O.row_count(_raw(spark, sf))


@query("histogram")
def q_histogram(spark, sf):
    return O.histogram(_raw(spark, sf), MONEY_COLUMNS, bins=20)


@query("events_histogram")
def q_events_histogram(spark, sf):
    return O.histogram(table(spark, sf, "events"), ["value"], bins=50)


@query("preview")
def q_preview(spark, sf):
    """First 20 raw trips of the analysis period, in a fixed order."""
    return O.preview(O.period_filter(_raw(spark, sf)).select(*RAW_COLUMNS), 20)


@query("distinct_months")
def q_distinct_months(spark, sf):
    return O.distinct_months(_clean(spark, sf))


@query("ingest_quality")
def q_ingest_quality(spark, sf):
    """The raw layer's quality report from what was measured while its batches
    were written (two drops of files); no row is read again."""
    base, raw = scratch_path(spark, "quality"), _raw(spark, sf)
    first = F.coalesce(F.col("DOlocationID") % 2 == 0, F.lit(True))
    for k, rows in enumerate((raw.filter(first), raw.filter(~first))):
        rows.write.parquet(f"{base}/source/{k}")
        result = ingest(spark, f"{base}/source", f"{base}/raw", f"{base}/_checkpoint", metrics=profile_aggregates(RAW_COLUMNS))
    return merged_metrics(batch_metrics(spark, result.sink_path))


@query("quality_report")
def q_quality_report(spark, sf):
    raw = _raw(spark, sf)
    zones = _zones(spark, sf)
    return quality_report(raw, clean_trips(raw, zones), zones)
