"""Raw -> clean trips."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.operators.cleaning import avg_speed_column, code_labels, typed_columns
from meterline.operators.dedup import drop_duplicate_trips
from meterline.operators.rules import (
    MAX_TOTAL, MONEY_TOLERANCE, VALID_PAYMENTS, VALID_RATECODES, valid_condition,
)
from meterline.operators.zones import known_zones_only, map_location_to_zone
from meterline.schema import CLEAN_COLUMNS
from meterline.sources.zones import SizedDimension


def typed_trips(raw: DataFrame) -> DataFrame:
    """Fill, cast, trip minutes: every raw row, clean types, one projection."""
    return raw.select(*typed_columns(raw))


def scan_condition(raw: DataFrame) -> Column:
    """Code and total rules on the raw columns, where Parquet can skip row
    groups by them; the validity rules still follow.  A missing code is filled
    with a known one and a missing or NaN total never passes, so no row is
    lost.  Fare, tip and tolls stay out: NaN counts as 0 there and must pass,
    but file statistics leave NaN out.  Only for columns of the contract's
    kind (codes stored as double are cast first)."""
    kinds = {c.lower(): t for c, t in raw.dtypes}
    cond = F.lit(True)
    for column, known in (("RatecodeID", VALID_RATECODES), ("payment_type", VALID_PAYMENTS)):
        if kinds.get(column.lower()) in ("int", "bigint"):
            cond = cond & (F.col(column).isNull() | F.col(column).isin(list(known)))
    if kinds.get("total_amount") == "double":
        cond = cond & (F.col("total_amount") > 0) & (F.col("total_amount") <= MAX_TOTAL)
    return cond


def valid_trips(raw: DataFrame, *, passengers: bool = False, vendors: bool = False,
                known_zones: SizedDimension | None = None) -> DataFrame:
    """Typed trips passing the validity rules AND the money check, as one
    filter.  A negative total passes the ratio test and is removed by the range
    rule only; the ratio is guarded against a zero total, so conjunct order
    does not matter."""
    out = typed_trips(raw.filter(scan_condition(raw))).filter(valid_condition(passengers, vendors, MONEY_TOLERANCE))
    if known_zones is not None:
        out = known_zones_only(out, known_zones)
    return out


def clean_core(raw: DataFrame, *, survivor: str = "smallest", passengers: bool = False,
               vendors: bool = False, known_zones: SizedDimension | None = None) -> DataFrame:
    """Valid, deduplicated trips with speed, in clean column order, codes
    still numeric.  The dedup aggregation is the only shuffle, and it runs
    after every filter so only surviving rows move."""
    deduped = drop_duplicate_trips(valid_trips(raw, passengers=passengers, vendors=vendors,
                                               known_zones=known_zones), survivor=survivor)
    return deduped.select(*_clean_projection(deduped.columns, labels=False))


def _clean_projection(columns, labels: bool) -> list:
    """Clean column order, with speed and (optionally) code labels: one Project."""
    derived = {"avg_speed": avg_speed_column()}
    if labels:
        derived.update(code_labels())
    return [derived[c].alias(c) if c in derived else F.col(c)
            for c in CLEAN_COLUMNS if c in derived or c in columns]


def clean_trips(raw: DataFrame, zones: SizedDimension, *, survivor: str = "smallest",
                passengers: bool = False, vendors: bool = False, zone_rule: bool = False) -> DataFrame:
    """The clean layer: codes become labels and location ids become zone names
    (broadcast lookups) after the dedup, so the shuffle carries no labels.

    ``passengers``, ``vendors`` and ``zone_rule`` switch on the optional
    rules (off by default)."""
    deduped = drop_duplicate_trips(valid_trips(raw, passengers=passengers, vendors=vendors,
                                               known_zones=zones if zone_rule else None), survivor=survivor)
    labelled = deduped.select(*_clean_projection(deduped.columns, labels=True))
    return map_location_to_zone(labelled, zones)
