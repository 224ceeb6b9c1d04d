"""Quartiles from stored sketches.

Each partition of a table (a month) keeps one KLL sketch a column; sketches of
any partitions merge, so quartiles of any span of months need no row of the
table, and a rebuilt month replaces only its own.  A sketch of size ``k`` holds
the rank of a value within 2.296 / k^0.9723 of all values (99 % of the time;
``rank_bound`` is three times that), and is exact up to ``k`` values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

SKETCH_K = 4096


def rank_bound(k: int = SKETCH_K) -> float:
    """The error in rank, as a share of all values, that no quantile exceeds in practice."""
    return 3 * 2.296 / k ** 0.9723


def _value(column: str) -> Column:
    v = F.col(column).cast("double")
    return F.when(~F.isnan(v), v)


def sketched(df: DataFrame, columns, by: str, k: int = SKETCH_K) -> DataFrame:
    """(by, column_name, n, sketch): one aggregation; nulls and NaN are left out,
    and a column without any value in a partition has no row there."""
    parts = df.groupBy(by).agg(*(F.struct(F.lit(c).alias("column_name"), F.count(_value(c)).alias("n"),
                                          F.kll_sketch_agg_double(_value(c), k).alias("sketch")).alias(c) for c in columns))
    return parts.select(by, F.inline(F.array(*columns))).filter("n > 0")


def merged(sketches: DataFrame, by: str) -> DataFrame:
    """(column_name, n, sketch) over the partitions given, merged in their order:
    a row for each partition and column is all this reads."""
    lists = sketches.groupBy("column_name").agg(F.sum("n").alias("n"), F.sort_array(F.collect_list(F.struct(by, "sketch"))).alias("s"))
    rest = F.slice("s", F.lit(2), F.size("s"))
    return lists.select("column_name", "n", F.aggregate(rest, F.get("s", F.lit(0))["sketch"],
                                                        lambda a, x: F.kll_sketch_merge_double(a, x["sketch"])).alias("sketch"))


def quantiles(merged_sketches: DataFrame, probabilities=(0.25, 0.75)) -> DataFrame:
    """(column_name, n, probability, value)."""
    each = F.array(*(F.struct(F.lit(float(p)).alias("probability"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(p))).alias("value"))
                     for p in probabilities))
    return merged_sketches.select("column_name", "n", F.inline(each))


def rank_errors(df: DataFrame, found: DataFrame) -> DataFrame:
    """``found`` with ``rank_error``: how far the probability is from the ranks
    that the value takes among the rows of ``df``, counted exactly in one pass."""
    asked = [r.asDict() for r in found.collect()]  # a row for each column and probability
    counts = []
    for k, r in enumerate(asked):
        v = _value(r["column_name"])
        counts += [F.count_if(v < r["value"]).alias(f"below{k}"), F.count_if(v <= r["value"]).alias(f"upto{k}"), F.count(v).alias(f"n{k}")]
    if not asked:
        return found.withColumn("rank_error", F.lit(0.0))
    out = df.agg(*counts).select(F.inline(F.array(*(F.struct(
        F.lit(r["column_name"]).alias("column_name"), F.lit(r["n"]).alias("n"), F.lit(r["probability"]).alias("probability"),
        F.lit(r["value"]).alias("value"),
        F.greatest(F.lit(0.0), F.col(f"below{k}") / F.col(f"n{k}") - r["probability"], r["probability"] - F.col(f"upto{k}") / F.col(f"n{k}"))
        .alias("rank_error")) for k, r in enumerate(asked)))))
    return out


def sequential_iqr(df: DataFrame, columns=("trip_distance", "total_amount"), k: int = SKETCH_K, fence: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """Rows within each column's fences, one column after another, and the
    quartiles used with their rank errors among the rows they were taken from:
    one sketch pass a column over the rows that the previous ones left."""
    out, reports = df, None
    for c in columns:
        found = quantiles(merged(sketched(out.withColumn("_all", F.lit(0)), [c], "_all", k), "_all"))
        report = rank_errors(out, found)
        reports = report if reports is None else reports.unionByName(report)
        q = {r["probability"]: r["value"] for r in report.collect()}
        if not q:
            break
        iqr = q[0.75] - q[0.25]
        out = out.filter((F.col(c) >= q[0.25] - fence * iqr) & (F.col(c) <= q[0.75] + fence * iqr))
    return out, reports
