"""Data-quality report: raw and clean layers side by side, one long table
``(layer, check_type, item, value)``.

Each layer is profiled in ONE aggregation pass (row count, nulls per column,
the 14 rule checks, the money-check split, unknown zones, first and last
pickup) instead of one Spark job per number.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from meterline.operators.rules import money_consistent, violation_rules
from meterline.operators.zones import flag_unknown_zones
from meterline.sources.zones import SizedDimension

SEP = "__"


def profile_aggregates(columns, unknown_zone: Column | None = None) -> dict[str, Column]:
    """The checks of one layer by name, each one aggregate that merges over any
    parts of the layer by its sum (the pickup times by min and max)."""
    ok = money_consistent()
    pickup = F.col("tpep_pickup_datetime").cast("timestamp")
    aggs = {f"row_count{SEP}rows": F.count(F.lit(1))}
    aggs |= {f"nulls{SEP}{c}": F.count_if(F.col(c).isNull()) for c in columns}
    aggs |= {f"rules{SEP}{name}": F.count_if(pred) for name, pred in violation_rules()}
    aggs |= {f"money{SEP}consistent": F.count_if(ok), f"money{SEP}inconsistent": F.count_if(~ok)}
    if unknown_zone is not None:
        aggs[f"zones{SEP}invalid_zones"] = F.count_if(unknown_zone)
    return aggs | {f"time{SEP}first_pickup_epoch": F.unix_timestamp(F.min(pickup)), f"time{SEP}last_pickup_epoch": F.unix_timestamp(F.max(pickup))}


def _profile(df: DataFrame, unknown_zone: Column, layer: str, helpers=()) -> DataFrame:
    aggs = profile_aggregates([c for c in df.columns if c not in helpers], unknown_zone)
    wide = df.agg(*(a.cast("bigint").alias(name) for name, a in aggs.items()))
    long = wide.unpivot([], wide.columns, "key", "value")
    parts = F.split(F.col("key"), SEP, 2)
    return long.select(F.lit(layer).alias("layer"), parts[0].alias("check_type"), parts[1].alias("item"), "value")


def merged_metrics(parts: DataFrame) -> DataFrame:
    """(check_type, item, value) of a layer from the metrics of its parts."""
    item, value = F.col("item"), F.col("value")
    total = (F.when(F.first(item) == "first_pickup_epoch", F.min(value)).when(F.first(item) == "last_pickup_epoch", F.max(value))
             .otherwise(F.sum(value)))
    return parts.groupBy("check_type", "item").agg(total.alias("value"))


def quality_report(raw: DataFrame, clean: DataFrame, zones: SizedDimension) -> DataFrame:
    """Raw layer: unknown zone = id null or absent from the dimension.
    Clean layer: ids are already names, so unknown zone = null name."""
    raw_part = _profile(flag_unknown_zones(raw, zones), F.col("_unknown_zone"), "raw",
                        helpers=("_unknown_zone",))
    clean_unknown = F.col("PUlocationID").isNull() | F.col("DOlocationID").isNull()
    clean_part = _profile(clean, clean_unknown, "clean")
    return raw_part.unionByName(clean_part)
