"""Quartiles and IQR outlier removal.

Exact quantiles are found by distributed selection: each pass is one
aggregation that counts values per equal-width bin of the range still in
question (combined map-side, at most ``bins`` rows per target reach the
driver), and the range narrows to the bin holding the wanted rank.  Memory on
every task and on the driver stays bounded by ``bins`` whatever the data size,
value distribution or number of distinct values; a column usually resolves in
2-4 passes.  The result is the linear interpolation between the values at
ranks floor/ceil of (n - 1) * p, as SQL ``percentile_cont`` defines it.

Approximate quartiles use ``percentile_approx`` (one pass, bounded sketch).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F

from meterline.functions.exact import round_half_up

# The IQR fence.
QUARTILES = (0.25, 0.75)
FENCE = 1.5

DEFAULT_BINS = 4096
MAX_PASSES = 64
# First pass: bins of width 1/64 on sign(v) * log(1 + |v|), a monotone scale
# that needs no min/max and keeps heavy tails from crowding one bin (about
# 1.6 % relative width; at most 64 * 710 bins per sign for any double).
LOG_BINS_PER_UNIT = 64


def _locate(hist_rows, state: dict, found: dict, column: str) -> None:
    """Walk each target's bins in order; settle it when its bin holds one
    distinct value, else narrow its range to that bin."""
    for r, rows in hist_rows.items():
        rlo, rhi, below = state[r]
        seen = below
        for row in sorted(rows, key=lambda x: x["b"]):
            if seen + row["n"] > r:
                if row["mn"] == row["mx"]:
                    found[r] = float(row["mn"])
                else:
                    state[r] = (float(row["mn"]), float(row["mx"]), seen)
                break
            seen += row["n"]
        else:
            raise RuntimeError(f"rank {r} not found in {column}; the input changed between passes")


def _first_pass(valid: DataFrame, column: str, probabilities) -> tuple[int, dict, dict, list] | None:
    """One aggregation over log-scale bins: the count, and for every target
    rank either its value or a narrowed range."""
    v = F.col(column).cast("double")
    key = F.floor(F.signum(v) * F.log1p(F.abs(v)) * LOG_BINS_PER_UNIT)
    hist = (valid.groupBy(key.alias("b"))
            .agg(F.count(F.lit(1)).alias("n"), F.min(v).alias("mn"), F.max(v).alias("mx"))
            .collect())
    n = sum(row["n"] for row in hist)
    if not n:
        return None
    ordered = sorted(hist, key=lambda x: x["b"])
    positions = [(n - 1) * p for p in probabilities]
    ranks = sorted({int(math.floor(h)) for h in positions} | {int(math.ceil(h)) for h in positions})
    lo = min(float(row["mn"]) for row in hist)
    hi = max(float(row["mx"]) for row in hist)
    state = {r: (lo, hi, 0) for r in ranks}
    found: dict[int, float] = {}
    # The scale is monotone, so bins come out ordered; were they ever not,
    # the narrowing passes start from the whole range instead (still exact).
    if all(a["mx"] <= b["mn"] for a, b in zip(ordered, ordered[1:])):
        _locate({r: ordered for r in ranks}, state, found, column)
    return n, state, found, positions


def _kth_values(df: DataFrame, column: str, state: dict, found: dict, bins: int) -> dict[int, float]:
    """Exact value at each 0-based rank among the non-null, non-NaN values.

    ``state`` maps each open rank to (lo, hi, count of values below lo)."""
    v = F.col(column).cast("double")
    for _ in range(MAX_PASSES):
        open_ranks = [r for r in state if r not in found]
        if not open_ranks:
            break
        # one job for every open rank: tag each value with the targets whose range holds it
        tags = []
        for i, r in enumerate(open_ranks):
            rlo, rhi, _ = state[r]
            b = F.floor((v - F.lit(rlo)) / F.lit(rhi - rlo) * bins) if rhi > rlo else F.lit(0)
            tags.append(F.when((v >= rlo) & (v <= rhi),
                               F.struct(F.lit(i).alias("t"), F.least(b, F.lit(bins - 1)).cast("int").alias("b"))))
        tagged = (df.select(v.alias("v"), F.array(*tags).alias("xs"))
                  .select("v", F.explode("xs").alias("x")).filter(F.col("x").isNotNull())
                  .select(F.col("x.t").alias("t"), F.col("x.b").alias("b"), "v"))
        hist = (tagged.groupBy("t", "b")
                .agg(F.count(F.lit(1)).alias("n"), F.min("v").alias("mn"), F.max("v").alias("mx"))
                .collect())
        per_target: dict[int, list] = {r: [] for r in open_ranks}
        for row in hist:
            per_target[open_ranks[row["t"]]].append(row)
        _locate(per_target, state, found, column)
    if len(found) < len(state):
        raise RuntimeError(f"exact quantile of {column} did not converge")
    return found


def exact_quantiles(df: DataFrame, column: str, probabilities=QUARTILES,
                    bins: int = DEFAULT_BINS) -> list[float] | None:
    """``percentile_cont`` of each probability over non-null, non-NaN values;
    ``None`` for an empty column.  Feed it a materialised frame (checkpoint or
    written table): it makes a few passes."""
    v = F.col(column).cast("double")
    valid = df.filter(v.isNotNull() & ~F.isnan(v))
    first = _first_pass(valid, column, probabilities)
    if first is None:
        return None
    n, state, found, positions = first
    values = _kth_values(valid, column, state, found, bins)
    out = []
    for h in positions:
        fl, ce = int(math.floor(h)), int(math.ceil(h))
        lo_v, hi_v = values[fl], values[ce]
        out.append(lo_v if fl == ce else lo_v + (hi_v - lo_v) * (h - fl))
    return out


def approx_quantiles(df: DataFrame, column: str, probabilities=QUARTILES,
                     relative_error: float = 0.01) -> list[float] | None:
    """``percentile_approx`` (rank error about ``relative_error`` * n), one pass."""
    accuracy = max(1, int(round(1.0 / relative_error)))
    v = F.col(column).cast("double")
    row = (df.filter(v.isNotNull() & ~F.isnan(v))
           .agg(F.percentile_approx(v, list(probabilities), accuracy).alias("q")).first())
    return None if row["q"] is None else [float(x) for x in row["q"]]


def _materialized(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table under ``spark.checkpoint.dir`` and read
    it back.  This cuts the lineage like ``checkpoint()`` (a lost executor never
    forces recomputing the input), and because the copy is columnar each
    quantile pass reads only the one column it needs."""
    from meterline.session import scratch_path
    path = scratch_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def iqr_bounds(q1: float, q3: float, fence: float = FENCE) -> tuple[float, float]:
    iqr = q3 - q1
    return q1 - fence * iqr, q3 + fence * iqr


def remove_outliers_iqr(df: DataFrame, columns=("trip_distance", "total_amount"), exact: bool = True,
                        relative_error: float = 0.01, materialize: bool = True) -> DataFrame:
    """Keep rows within [Q1 - 1.5 IQR, Q3 + 1.5 IQR], one column after another:
    each column's quartiles come from the rows that survived the previous
    column.  Rows with a null value in a checked column are dropped; an empty
    frame is returned unchanged.

    With ``materialize`` the input is written once as Parquet under
    ``spark.checkpoint.dir``, so the quantile passes re-read one column of it
    instead of recomputing its lineage.
    """
    if materialize:
        df = _materialized(df)
    out = df
    for c in columns:
        qs = exact_quantiles(out, c) if exact else approx_quantiles(out, c, relative_error=relative_error)
        if qs is None:
            return out
        lower, upper = iqr_bounds(*qs)
        out = out.filter((F.col(c) >= F.lit(lower)) & (F.col(c) <= F.lit(upper)))
    return out


def quartile_report(df: DataFrame, columns=("trip_distance", "total_amount"), exact: bool = True,
                    digits: int = 6) -> DataFrame:
    """(column_name, q1, q3, iqr, lower_bound, upper_bound) for each column,
    computed independently on the same input, reported to ``digits``
    decimals (HALF_UP)."""
    if exact:
        df = _materialized(df.select(*columns))
    rows = []
    for c in columns:
        qs = exact_quantiles(df, c) if exact else approx_quantiles(df, c)
        if qs is None:
            rows.append((c, None, None, None, None, None))
            continue
        q1, q3 = qs
        lower, upper = iqr_bounds(q1, q3)
        rows.append((c, q1, q3, q3 - q1, lower, upper))
    report = df.sparkSession.createDataFrame(
        rows, "column_name string, q1 double, q3 double, iqr double, lower_bound double, upper_bound double")
    return report.select("column_name", *[round_half_up(F.col(c), digits).alias(c) for c in report.columns[1:]])
