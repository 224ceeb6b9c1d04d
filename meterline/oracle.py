"""Oracle SQL: the same queries written independently as plain SQL that
DuckDB runs over the provided tables.  Used only to check results."""

from __future__ import annotations

from meterline.sources.fixture import fixture_sql

MONEY = ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
         "improvement_surcharge", "total_amount", "congestion_surcharge", "airport_fee")


def _fill_double(c: str) -> str:
    return f"CASE WHEN {c} IS NULL OR isnan({c}) THEN 0.0 ELSE {c} END AS {c}"


RAW = f"trips_raw AS ({fixture_sql()})"

ZONES = ("zones AS (SELECT LocationID, arg_max(zone, pos) AS zone FROM ("
         "SELECT CAST(n_nationkey AS INTEGER) AS LocationID, n_name AS zone, "
         "row_number() OVER () AS pos FROM nation) WHERE LocationID IS NOT NULL GROUP BY LocationID)")

FILLED = ("filled AS (SELECT VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, "
          "COALESCE(passenger_count, 0) AS passenger_count, trip_distance, "
          "COALESCE(RatecodeID, 99) AS RatecodeID, COALESCE(PUlocationID, 999) AS PUlocationID, "
          "COALESCE(DOlocationID, 999) AS DOlocationID, COALESCE(payment_type, 5) AS payment_type, "
          + ", ".join(_fill_double(c) for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                                                  "improvement_surcharge", "total_amount", "congestion_surcharge",
                                                  "airport_fee"))
          + " FROM trips_raw)")

TYPED = ("typed AS (SELECT CAST(VendorID AS INTEGER) AS VendorID, "
         "CAST(tpep_pickup_datetime AS TIMESTAMP) AS tpep_pickup_datetime, "
         "CAST(tpep_dropoff_datetime AS TIMESTAMP) AS tpep_dropoff_datetime, "
         "CAST(passenger_count AS INTEGER) AS passenger_count, CAST(trip_distance AS DOUBLE) AS trip_distance, "
         "CAST(RatecodeID AS INTEGER) AS RatecodeID, CAST(PUlocationID AS INTEGER) AS PUlocationID, "
         "CAST(DOlocationID AS INTEGER) AS DOlocationID, CAST(payment_type AS INTEGER) AS payment_type, "
         "fare_amount, extra, mta_tax, tip_amount, tolls_amount, improvement_surcharge, total_amount, "
         "congestion_surcharge, airport_fee, "
         "CAST(round((epoch(tpep_dropoff_datetime) - epoch(tpep_pickup_datetime)) / 60.0) AS INTEGER) "
         "AS trip_time_minutes FROM filled)")

VALID_WHERE = (
    "tpep_pickup_datetime >= DATE '2023-01-01' AND tpep_dropoff_datetime >= DATE '2023-01-01' "
    "AND tpep_dropoff_datetime > tpep_pickup_datetime AND trip_distance > 0 AND trip_distance <= 150 "
    "AND RatecodeID IN (1, 2, 3, 4, 5, 6, 99) AND payment_type IN (0, 1, 2, 3, 4, 5, 6) "
    "AND trip_time_minutes > 3 AND trip_time_minutes <= 180 AND total_amount > 0 AND total_amount <= 500 "
    "AND fare_amount >= 0 AND tip_amount >= 0 AND tolls_amount >= 0")

COMPONENTS = ("(fare_amount + tolls_amount + tip_amount + extra + mta_tax + airport_fee "
              "+ improvement_surcharge + congestion_surcharge)")
MONEY_OK = (f"(CASE WHEN total_amount = 0 THEN false "
            f"WHEN abs({COMPONENTS} - total_amount) / total_amount <= 0.03 THEN true ELSE false END)")

VALID = f"valid AS (SELECT * FROM typed WHERE {VALID_WHERE} AND {MONEY_OK})"

DEDUP_ORDER = ("VendorID, RatecodeID, PUlocationID, DOlocationID, payment_type, fare_amount, extra, mta_tax, "
               "tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, "
               "airport_fee, trip_time_minutes")


def dedup_cte(name: str, source: str, order: str) -> str:
    order_sql = ", ".join(f"{c.strip()} ASC NULLS FIRST" for c in order.split(","))
    return (f"{name} AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY "
            f"tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance "
            f"ORDER BY {order_sql}) AS rn FROM {source}) WHERE rn = 1)")


def round2(expr: str, digits: int = 2) -> str:
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), {digits}) AS DOUBLE)"


# Plain rounding of a double: HALF_UP on its shortest decimal form.
SPEED = ("CAST(round(CAST(CAST(CASE WHEN trip_time_minutes <> 0 THEN trip_distance / (trip_time_minutes / 60.0) END "
         "AS VARCHAR) AS DECIMAL(38,20)), 2) AS DOUBLE) AS avg_speed")

CORE = (dedup_cte("deduped", "valid", DEDUP_ORDER) + ", core AS (SELECT VendorID, PUlocationID, "
        "tpep_pickup_datetime, tpep_dropoff_datetime, DOlocationID, trip_distance, trip_time_minutes, "
        + SPEED + ", passenger_count, RatecodeID, payment_type, fare_amount, extra, mta_tax, tip_amount, "
        "tolls_amount, improvement_surcharge, congestion_surcharge, airport_fee, total_amount FROM deduped)")


def case_label(col: str, pairs, default: str | None) -> str:
    whens = " ".join(f"WHEN {col} = {k} THEN '{v}'" for k, v in pairs)
    tail = "NULL" if default is None else f"'{default}'"
    return f"CASE {whens} ELSE {tail} END"


RATE = [(1, "Standard rate"), (2, "JFK"), (3, "Newark"), (4, "Nassau or Westchester"),
        (5, "Negotiated fare"), (6, "Group ride"), (99, "Null/Unknown")]
PAY = [(0, "Flex Fare trip"), (1, "Credit card"), (2, "Cash"), (3, "No charge"), (4, "Dispute"),
       (5, "Unknown"), (6, "Voided trip")]
VEND = [(1, "Creative Mobile Technologies, LLC"), (2, "Curb Mobility, LLC"), (6, "Myle Technologies Inc"),
        (7, "Helix")]
MONTHS = [(i + 1, m) for i, m in enumerate("Jan Feb Mar Apr May Jun Jul Aug Sep Oct Nov Dec".split())]
DAYS = [(i + 1, d) for i, d in enumerate("Sunday Monday Tuesday Wednesday Thursday Friday Saturday".split())]

CLEAN = ("clean AS (SELECT " + case_label("c.VendorID", VEND, "Other") + " AS VendorID, zp.zone AS PUlocationID, "
         "c.tpep_pickup_datetime, c.tpep_dropoff_datetime, zd.zone AS DOlocationID, c.trip_distance, "
         "c.trip_time_minutes, c.avg_speed, c.passenger_count, "
         + case_label("c.RatecodeID", RATE, None) + " AS RatecodeID, "
         + case_label("c.payment_type", PAY, "Other") + " AS payment_type, "
         "c.fare_amount, c.extra, c.mta_tax, c.tip_amount, c.tolls_amount, c.improvement_surcharge, "
         "c.congestion_surcharge, c.airport_fee, c.total_amount FROM core c "
         "LEFT JOIN zones zp ON zp.LocationID = c.PUlocationID "
         "LEFT JOIN zones zd ON zd.LocationID = c.DOlocationID)")


def with_(*ctes: str) -> str:
    return "WITH " + ", ".join(ctes) + " "


CLEAN_CHAIN = (RAW, ZONES, FILLED, TYPED, VALID, CORE, CLEAN)


def exact_sum(c: str) -> str:
    return f"CAST(SUM(CAST({c} AS DECIMAL(18,6))) AS DOUBLE)"


def exact_avg(c: str) -> str:
    return round2(f"SUM(CAST({c} AS DECIMAL(18,6))) / COUNT({c})")


def gold_trips_sql(period: str, locations: list[str], source: str = "clean") -> str:
    cal = {"day": "dayofweek(tpep_pickup_datetime) + 1", "week": "weekofyear(tpep_pickup_datetime)",
           "month": None}[period]
    loc = "".join(f"{c}, " for c in locations)
    keys_inner = "CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, " \
                       "CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month"
    group = loc + "pickup_year, pickup_month"
    if cal:
        keys_inner += f", CAST({cal} AS INTEGER) AS pickup_{period}"
        group += f", pickup_{period}"
    agg = (f"SELECT {group}, COUNT(*) AS total_trips, {exact_sum('total_amount')} AS total_revenue, "
           f"{exact_sum('fare_amount')} AS total_fare, {exact_sum('tip_amount')} AS total_tips, "
           f"{exact_sum('tolls_amount')} AS total_tolls, {exact_avg('trip_distance')} AS avg_distance, "
           f"{exact_avg('trip_time_minutes')} AS avg_trip_time "
           f"FROM (SELECT *, {keys_inner} FROM {source}) GROUP BY {group}")
    day = f", {case_label('pickup_day', DAYS, 'N/A')} AS pickup_day" if period == "day" else \
        (", pickup_week" if period == "week" else "")
    return (f"SELECT {loc}pickup_year, {case_label('pickup_month', MONTHS, 'N/A')} AS pickup_month{day}, "
            f"total_trips, total_revenue, total_fare, total_tips, total_tolls, avg_distance, avg_trip_time, "
            + round2("CASE WHEN total_revenue <> 0 THEN 100 * total_tips / total_revenue ELSE 0 END")
            + f" AS tip_percentage FROM ({agg})")


RAW_COLS = ("VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
            "RatecodeID", "PUlocationID", "DOlocationID", "payment_type", "fare_amount", "extra", "mta_tax",
            "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount", "congestion_surcharge",
            "airport_fee")
CLEAN_COLS = ("VendorID", "PUlocationID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "DOlocationID",
              "trip_distance", "trip_time_minutes", "avg_speed", "passenger_count", "RatecodeID", "payment_type",
              "fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge",
              "congestion_surcharge", "airport_fee", "total_amount")
RAW_DEDUP_ORDER = ("VendorID, RatecodeID, PUlocationID, DOlocationID, payment_type, fare_amount, extra, mta_tax, "
                   "tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee")

VIOLATIONS = [
    ("pickup_before_start", "tpep_pickup_datetime < DATE '2023-01-01'"),
    ("dropoff_before_start", "tpep_dropoff_datetime < DATE '2023-01-01'"),
    ("dropoff_before_pickup", "tpep_dropoff_datetime < tpep_pickup_datetime"),
    ("passengers_out_of_range", "passenger_count <= 0 OR passenger_count > 7"),
    ("distance_not_positive", "trip_distance <= 0"),
] + [(f"negative_{c}", f"{c} < 0") for c in ("fare_amount", "extra", "mta_tax", "tip_amount", "tolls_amount",
                                              "improvement_surcharge", "congestion_surcharge", "airport_fee",
                                              "total_amount")]

BANDS = [(2, "0-2 miles"), (5, "2-5 miles"), (10, "5-10 miles"), (25, "10-25 miles"), (50, "25-50 miles"),
         (100, "50-100 miles")]


def band_sql(c: str) -> str:
    return "CASE " + " ".join(f"WHEN {c} <= {e} THEN '{b}'" for e, b in BANDS) + " ELSE '>100 miles' END"


def _calendar(period: str) -> tuple[str, str]:
    """(select list, group list) of the calendar keys."""
    sel = ("CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, "
           "CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month")
    grp = "pickup_year, pickup_month"
    if period == "day":
        sel += ", CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day"
        grp += ", pickup_day"
    elif period == "week":
        sel += ", CAST(weekofyear(tpep_pickup_datetime) AS INTEGER) AS pickup_week"
        grp += ", pickup_week"
    return sel, grp


def _labels(period: str) -> str:
    out = f"{case_label('pickup_month', MONTHS, 'N/A')} AS pickup_month"
    if period == "day":
        out += f", {case_label('pickup_day', DAYS, 'N/A')} AS pickup_day"
    elif period == "week":
        out += ", pickup_week"
    return out


def gold_bucket_sql(period: str, locations: list[str], source: str = "clean") -> str:
    loc = "".join(f"{c}, " for c in locations)
    sel, grp = _calendar(period)
    agg = (f"SELECT {loc}distance_bucket, {grp}, COUNT(*) AS total_trips, "
           f"{exact_sum('total_amount')} AS total_revenue, {exact_avg('trip_time_minutes')} AS avg_trip_time, "
           f"{exact_avg('tip_amount')} AS avg_tips FROM (SELECT *, {band_sql('trip_distance')} AS distance_bucket, "
           f"{sel} FROM {source}) GROUP BY {loc}distance_bucket, {grp}")
    return (f"SELECT {loc}distance_bucket, pickup_year, {_labels(period)}, total_trips, total_revenue, "
            f"avg_trip_time, avg_tips FROM ({agg})")


def gold_passengers_sql(period: str, locations: list[str], by_hour: bool = False, source: str = "clean") -> str:
    loc = "".join(f"{c}, " for c in locations)
    sel, grp = _calendar(period)
    if by_hour:
        sel += ", CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour"
        grp += ", pickup_hour"
    agg = (f"SELECT {loc}passenger_count, {grp}, COUNT(*) AS total_trips, "
           f"{exact_sum('total_amount')} AS total_revenue, {exact_avg('tip_amount')} AS avg_tips, "
           f"{exact_avg('trip_time_minutes')} AS avg_trip_time FROM (SELECT *, {sel} FROM {source}) "
           f"GROUP BY {loc}passenger_count, {grp}")
    hour = ", pickup_hour" if by_hour else ""
    return (f"SELECT {loc}passenger_count, pickup_year, {_labels(period)}{hour}, total_trips, total_revenue, "
            f"avg_tips, avg_trip_time FROM ({agg})")


def comparison_sql(period: str, locations: list[str], source: str = "clean") -> str:
    loc = "".join(f"{c}, " for c in locations)
    part = f"PARTITION BY {', '.join(locations)} " if locations else ""
    agg = (f"SELECT {loc}CAST(date_trunc('{period}', tpep_pickup_datetime) AS DATE) AS period_start, "
           f"COUNT(*) AS total_trips, {exact_sum('total_amount')} AS total_revenue FROM {source} "
           f"GROUP BY {loc}period_start")
    before = f"lag(period_start) OVER w = period_start - INTERVAL 1 {period}"
    lagged = (f"SELECT *, CASE WHEN {before} THEN lag(total_trips) OVER w END AS prev_total_trips, "
              f"CASE WHEN {before} THEN lag(total_revenue) OVER w END AS prev_total_revenue FROM ({agg}) "
              f"WINDOW w AS ({part}ORDER BY period_start)")
    return (f"SELECT *, "
            + round2("CASE WHEN prev_total_trips <> 0 THEN 100 * (total_trips - prev_total_trips) / prev_total_trips END")
            + " AS trips_change_pct, "
            + round2("CASE WHEN prev_total_revenue <> 0 THEN 100 * (total_revenue - prev_total_revenue) "
                     "/ prev_total_revenue END")
            + f" AS revenue_change_pct FROM ({lagged})")


def _valid_value(c: str) -> str:
    return f"{c} IS NOT NULL AND NOT isnan({c})"


def iqr_ctes(source: str, columns=("trip_distance", "total_amount")) -> tuple[list[str], str]:
    ctes, cur = [], source
    for i, c in enumerate(columns):
        ctes.append(f"iq{i} AS (SELECT quantile_cont({c}, 0.25) AS a, quantile_cont({c}, 0.75) AS b "
                    f"FROM {cur} WHERE {_valid_value(c)})")
        ctes.append(f"is{i} AS (SELECT t.* FROM {cur} t, iq{i} WHERE t.{c} >= iq{i}.a - 1.5 * (iq{i}.b - iq{i}.a) "
                    f"AND t.{c} <= iq{i}.b + 1.5 * (iq{i}.b - iq{i}.a))")
        cur = f"is{i}"
    return ctes, cur


def histogram_sql(source: str, columns, bins: int) -> str:
    parts = []
    for c in columns:
        parts.append(
            f"SELECT '{c}' AS column_name, CAST(bin AS INTEGER) AS bin, lo + bin * w AS bin_low, "
            f"lo + (bin + 1) * w AS bin_high, COUNT(*) AS trips FROM ("
            f"SELECT CAST(CASE WHEN hi > lo THEN least(floor((CAST({c} AS DOUBLE) - lo) / (hi - lo) * {bins}), "
            f"{bins - 1}) ELSE 0 END AS INTEGER) AS bin, lo, (hi - lo) / {bins} AS w "
            f"FROM {source}, (SELECT CAST(min({c}) AS DOUBLE) AS lo, CAST(max({c}) AS DOUBLE) AS hi FROM {source} "
            f"WHERE {_valid_value(c)}) bounds WHERE {_valid_value(c)}) GROUP BY bin, lo, w")
    return " UNION ALL ".join(parts)


def _profile_sql(layer: str, source: str, columns, unknown: str) -> list[str]:
    rows = [f"SELECT '{layer}' AS layer, 'row_count' AS check_type, 'rows' AS item, COUNT(*) AS value FROM {source}"]
    rows += [f"SELECT '{layer}', 'nulls', '{c}', COUNT(*) FILTER (WHERE {c} IS NULL) FROM {source}" for c in columns]
    rows += [f"SELECT '{layer}', 'rules', '{n}', COUNT(*) FILTER (WHERE {p}) FROM {source}" for n, p in VIOLATIONS]
    rows += [f"SELECT '{layer}', 'money', 'consistent', COUNT(*) FILTER (WHERE {MONEY_OK}) FROM {source}",
             f"SELECT '{layer}', 'money', 'inconsistent', COUNT(*) FILTER (WHERE NOT {MONEY_OK}) FROM {source}",
             f"SELECT '{layer}', 'zones', 'invalid_zones', COUNT(*) FILTER (WHERE {unknown}) FROM {source}",
             f"SELECT '{layer}', 'time', 'first_pickup_epoch', CAST(epoch(min(tpep_pickup_datetime)) AS BIGINT) "
             f"FROM {source}",
             f"SELECT '{layer}', 'time', 'last_pickup_epoch', CAST(epoch(max(tpep_pickup_datetime)) AS BIGINT) "
             f"FROM {source}"]
    return rows


UNKNOWN_RAW = ("(PUlocationID IS NULL OR DOlocationID IS NULL OR PUlocationID NOT IN (SELECT LocationID FROM zones) "
               "OR DOlocationID NOT IN (SELECT LocationID FROM zones))")


def oracle_queries() -> dict[str, str]:
    q: dict[str, str] = {}
    raw = with_(RAW)
    rz = with_(RAW, ZONES)
    typed = with_(RAW, FILLED, TYPED)
    tz = with_(RAW, ZONES, FILLED, TYPED)
    clean = with_(*CLEAN_CHAIN)

    # sources and sinks
    q["scan_trips"] = raw + "SELECT * FROM trips_raw"
    q["zone_dim"] = with_(ZONES) + "SELECT * FROM zones"
    q["zone_dim_dbf"] = q["zone_dim"]
    q["schema_contract"] = (raw + "SELECT * REPLACE (CASE WHEN DOlocationID % 3 = 2 THEN NULL ELSE airport_fee END "
                            "AS airport_fee), CASE WHEN DOlocationID % 3 = 2 THEN '{\"cbd_congestion_fee\":0.75}' END AS rescued_data "
                            "FROM trips_raw")
    contract = {"VendorID": "bigint", "passenger_count": "bigint", "RatecodeID": "bigint", "PUlocationID": "int",
                "DOlocationID": "int", "payment_type": "bigint", "tpep_pickup_datetime": "timestamp_ntz",
                "tpep_dropoff_datetime": "timestamp_ntz"}
    found = {"passenger_count": "'double'", "RatecodeID": "'string'", "PUlocationID": "'bigint'", "airport_fee": "NULL"}
    bad = {"RatecodeID": "COUNT(*) FILTER (WHERE RatecodeID = 99)", "PUlocationID": "COUNT(*) FILTER (WHERE PUlocationID = 26)"}
    events = [(0, "declared", c, None, contract.get(c, "double")) for c in RAW_COLS] + [
        (1, "added", "cbd_congestion_fee", None, "int"), (1, "widened", "PUlocationID", "int", "bigint"),
        (1, "cast", "passenger_count", "double", "bigint"), (2, "absent", "airport_fee", None, "double"),
        (2, "added", "tag", None, "string"), (2, "widened", "cbd_congestion_fee", "int", "bigint"),
        (2, "cast", "PUlocationID", "int", "bigint")]
    holds = {"airport_fee": "coalesce(DOlocationID % 3, 0) <> 2 AND airport_fee IS NOT NULL", "tag": "DOlocationID % 3 = 2",
             "cbd_congestion_fee": "DOlocationID % 3 IN (1, 2)"}
    q["schema_history"] = raw + " UNION ALL ".join(
        f"SELECT {v} AS version, '{e}' AS event, '{c}' AS column_name, CAST({repr(a) if a else 'NULL'} AS VARCHAR) AS from_type, "
        f"'{b}' AS to_type, COUNT(*) FILTER (WHERE {holds.get(c, c + ' IS NOT NULL')}) AS values_now FROM trips_raw"
        for v, e, c, a, b in events)
    valid = with_(RAW, FILLED, TYPED, VALID)
    keys = "tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance"
    again = "FROM valid WHERE tpep_pickup_datetime < TIMESTAMP '2023-07-01' AND DOlocationID % 7"
    q["watermark_clean"] = (valid + f", k AS (SELECT DISTINCT {keys} FROM valid), n(outcome, trips) AS ("
                            "SELECT 'kept', (SELECT COUNT(*) FROM k) UNION ALL "
                            f"SELECT 'duplicate', (SELECT COUNT(*) FROM valid) - (SELECT COUNT(*) FROM k) + (SELECT COUNT(*) {again} = 1) "
                            f"UNION ALL SELECT 'late', (SELECT COUNT(*) {again} = 0)) SELECT * FROM n WHERE trips > 0")
    quarters = "CROSS JOIN (VALUES (0.25::DOUBLE), (0.75::DOUBLE)) AS p(probability)"
    q["quartiles_sketch"] = (clean + "SELECT column_name, n, probability, true AS within_bound FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS n FROM clean" for c in ("trip_distance", "total_amount", "tip_amount", "fare_amount"))
        + f") {quarters}")
    q["iqr_sketch_ranks"] = ("SELECT column_name, probability, true AS within_bound FROM (VALUES ('trip_distance'), ('total_amount')) "
                             f"AS c(column_name) {quarters}")
    q["schema_check"] = raw + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{(t := contract.get(c, 'double'))}' AS expected_type, "
        f"CAST({found.get(c, repr(t))} AS VARCHAR) AS actual_type, "
        f"{str(c not in found).lower()} AS type_ok, "
        f"{bad.get(c, 'COUNT(*) FILTER (WHERE false)')} AS nonconforming_values FROM trips_raw"
        for c in RAW_COLS)
    q["ingest_stream"] = q["scan_trips"]
    q["ingest_late_files"] = q["scan_trips"]
    q["ingest_lineage"] = (raw + "SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS source_year, "
                           "COUNT(*) AS trips, COUNT(*) AS stamped_trips, COUNT(*) AS traced_trips "
                           "FROM trips_raw GROUP BY source_year")
    q["events_stream"] = "SELECT * FROM events"
    q["materialize_roundtrip"] = clean + "SELECT * FROM clean"
    q["clean_trips"] = clean + "SELECT * FROM clean"

    # projections
    q["fill_missing"] = with_(RAW, FILLED) + "SELECT * FROM filled"
    fill0 = ", ".join(
        [f"COALESCE({c}, 0) AS {c}" for c in ("VendorID", "passenger_count", "RatecodeID", "PUlocationID",
                                                "DOlocationID", "payment_type")]
        + [_fill_double(c) for c in ("trip_distance",) + MONEY])
    q["fill_all_numeric"] = raw + f"SELECT tpep_pickup_datetime, tpep_dropoff_datetime, {fill0} FROM trips_raw"
    q["cast_columns"] = typed + "SELECT * EXCLUDE (trip_time_minutes) FROM typed"
    q["trip_time"] = typed + "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, trip_time_minutes FROM typed"
    q["avg_speed"] = (typed + "SELECT tpep_pickup_datetime, trip_distance, trip_time_minutes, "
                      + SPEED + " FROM typed")
    q["project_clean"] = with_(RAW, FILLED, TYPED, VALID, CORE) + "SELECT * FROM core"
    q["map_ratecode"] = typed + f"SELECT RatecodeID AS code, {case_label('RatecodeID', RATE, None)} AS RatecodeID FROM typed"
    q["map_payment"] = typed + f"SELECT payment_type AS code, {case_label('payment_type', PAY, 'Other')} AS payment_type FROM typed"
    q["map_vendor"] = typed + f"SELECT VendorID AS code, {case_label('VendorID', VEND, 'Other')} AS VendorID FROM typed"
    q["map_zone"] = (tz + "SELECT t.PUlocationID AS pu_id, t.DOlocationID AS do_id, zp.zone AS PUlocationID, "
                     "zd.zone AS DOlocationID FROM typed t LEFT JOIN zones zp ON zp.LocationID = t.PUlocationID "
                     "LEFT JOIN zones zd ON zd.LocationID = t.DOlocationID")
    q["zone_unknown"] = (clean + "SELECT * REPLACE (COALESCE(PUlocationID, 'Unknown') AS PUlocationID, "
                         "COALESCE(DOlocationID, 'Unknown') AS DOlocationID) FROM clean")
    q["distance_bucket"] = typed + f"SELECT trip_distance, {band_sql('trip_distance')} AS distance_bucket FROM typed"
    q["month_name"] = (typed + "SELECT tpep_pickup_datetime, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, "
                       + case_label("month(tpep_pickup_datetime)", MONTHS, "N/A") + " AS pickup_month FROM typed")
    q["day_name"] = (typed + "SELECT tpep_pickup_datetime, "
                     + case_label("(dayofweek(tpep_pickup_datetime) + 1)", DAYS, "N/A") + " AS pickup_day FROM typed")
    q["calendar_keys"] = (typed + "SELECT tpep_pickup_datetime, CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year, "
                          "CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month, "
                          "CAST(weekofyear(tpep_pickup_datetime) AS INTEGER) AS pickup_week FROM typed")

    # filters
    q["consistency_filter"] = typed + f"SELECT * FROM typed WHERE {VALID_WHERE}"
    q["optional_filters"] = (tz + f"SELECT * FROM typed WHERE {VALID_WHERE} AND passenger_count > 0 "
                             "AND passenger_count < 7 AND VendorID IN (1, 2, 6, 7) "
                             "AND PUlocationID IN (SELECT LocationID FROM zones) "
                             "AND DOlocationID IN (SELECT LocationID FROM zones)")
    q["validate_financials"] = typed + f"SELECT * FROM typed WHERE {MONEY_OK}"
    q["period_filter"] = raw + "SELECT * FROM trips_raw WHERE tpep_pickup_datetime > DATE '2024-01-01'"
    q["invalid_zones"] = rz + f"SELECT * FROM trips_raw WHERE {UNKNOWN_RAW}"
    q["invalid_zone_count"] = rz + f"SELECT COUNT(*) AS invalid_zones FROM trips_raw WHERE {UNKNOWN_RAW}"
    iq, last = iqr_ctes("clean")
    q["iqr_exact"] = with_(*CLEAN_CHAIN, *iq) + f"SELECT * FROM {last}"

    # aggregations
    q["dedup_trips"] = with_(RAW, dedup_cte("d", "trips_raw", RAW_DEDUP_ORDER)) + "SELECT * FROM d"
    q["duplicate_groups"] = (raw + "SELECT tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
                             "trip_distance, COUNT(*) AS dup_count FROM trips_raw GROUP BY tpep_pickup_datetime, "
                             "tpep_dropoff_datetime, passenger_count, trip_distance HAVING COUNT(*) > 1")
    q["gold_trips"] = clean + gold_trips_sql("day", ["PUlocationID"])
    q["layers_gold_trips"] = q["gold_trips"]
    q["tip_percentage"] = (clean + f"SELECT payment_type, COUNT(*) AS total_trips, {exact_sum('tip_amount')} AS total_tips, "
                           f"{exact_sum('total_amount')} AS total_revenue, "
                           + round2("CASE WHEN total_revenue <> 0 THEN 100 * total_tips / total_revenue ELSE 0 END")
                           + " AS tip_percentage FROM clean GROUP BY payment_type")
    q["gold_trips_week"] = clean + gold_trips_sql("week", ["PUlocationID", "DOlocationID"])
    q["gold_trips_month"] = clean + gold_trips_sql("month", [])
    q["gold_bucket"] = clean + gold_bucket_sql("day", ["PUlocationID"])
    q["gold_bucket_week"] = clean + gold_bucket_sql("week", [])
    q["gold_bucket_month"] = clean + gold_bucket_sql("month", ["PUlocationID"])
    q["gold_passengers"] = clean + gold_passengers_sql("day", ["PUlocationID"])
    q["layers_gold_bucket"] = q["gold_bucket"]
    for table in ("gold_trips", "gold_bucket", "gold_passengers"):
        q[f"delta_{table}"] = q[table]
    q["delta_clean"] = q["clean_trips"]
    q["layers_gold_passengers"] = q["gold_passengers"]
    q["gold_passengers_week"] = clean + gold_passengers_sql("week", ["DOlocationID"])
    q["gold_passengers_month"] = clean + gold_passengers_sql("month", [])
    q["gold_passengers_hour"] = clean + gold_passengers_sql("day", [], by_hour=True)
    q["period_comparison"] = clean + comparison_sql("week", ["PUlocationID"])
    q["period_comparison_month"] = clean + comparison_sql("month", [])
    q["gold_trips_iqr"] = with_(*CLEAN_CHAIN, *iq) + gold_trips_sql("day", ["PUlocationID"], source=last)
    q["null_profile"] = raw + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT(*) FILTER (WHERE {c} IS NULL) AS nulls FROM trips_raw" for c in RAW_COLS)
    q["time_range"] = (raw + "SELECT min(tpep_pickup_datetime) AS initial_pickup_datetime, "
                       "max(tpep_pickup_datetime) AS final_pickup_datetime FROM trips_raw")
    q["rule_violations"] = raw + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, COUNT(*) FILTER (WHERE {p}) AS violations FROM trips_raw" for n, p in VIOLATIONS)
    q["financial_split"] = (raw + f"SELECT 'consistent' AS financial_status, COUNT(*) FILTER (WHERE {MONEY_OK}) AS trips "
                            f"FROM trips_raw UNION ALL SELECT 'inconsistent', COUNT(*) FILTER (WHERE NOT {MONEY_OK}) "
                            "FROM trips_raw UNION ALL SELECT 'total', COUNT(*) FROM trips_raw")
    q["describe_money"] = raw + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, COUNT({c}) AS count, "
        + round2(f"SUM(CAST({c} AS DECIMAL(18,2))) / COUNT({c})", 4) + " AS mean, "
        + round2(f"stddev_samp({c})", 4) + f" AS stddev, CAST(min({c}) AS DOUBLE) AS min, "
        f"CAST(max({c}) AS DOUBLE) AS max FROM trips_raw" for c in MONEY)
    q["quartiles_exact"] = clean + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, {round2('a', 6)} AS q1, {round2('b', 6)} AS q3, {round2('b - a', 6)} AS iqr, "
        f"{round2('a - 1.5 * (b - a)', 6)} AS lower_bound, "
        f"{round2('b + 1.5 * (b - a)', 6)} AS upper_bound FROM (SELECT quantile_cont({c}, 0.25) AS a, "
        f"quantile_cont({c}, 0.75) AS b FROM clean WHERE {_valid_value(c)})"
        for c in ("trip_distance", "total_amount"))
    q["row_count"] = raw + "SELECT COUNT(*) AS row_count FROM trips_raw"
    q["histogram"] = raw + histogram_sql("trips_raw", MONEY, 20)
    q["events_histogram"] = histogram_sql("events", ["value"], 50)
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in RAW_COLS)
    q["preview"] = (raw + "SELECT * FROM trips_raw WHERE tpep_pickup_datetime > DATE '2024-01-01' "
                    f"ORDER BY {order} LIMIT 20")
    q["distinct_months"] = clean + "SELECT DISTINCT CAST(month(tpep_pickup_datetime) AS INTEGER) AS month FROM clean"
    q["quality_report"] = clean + " UNION ALL ".join(
        _profile_sql("raw", "trips_raw", RAW_COLS, UNKNOWN_RAW)
        + _profile_sql("clean", "clean", CLEAN_COLS, "(PUlocationID IS NULL OR DOlocationID IS NULL)"))
    q["ingest_quality"] = f"SELECT check_type, item, value FROM ({q['quality_report']}) WHERE layer = 'raw' AND check_type <> 'zones'"
    return q
