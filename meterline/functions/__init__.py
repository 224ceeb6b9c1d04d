"""Column-level building blocks: code labels, calendar keys, exact metrics."""

from meterline.functions.calendar import calendar_columns, check_period, period_key, rounded_minutes
from meterline.functions.exact import exact_avg, exact_sum, ratio_pct, round_half_up, units
from meterline.functions.labels import (
    code_label, distance_band, month_label, payment_label, ratecode_label, vendor_label, weekday_label,
)

__all__ = [
    "calendar_columns", "check_period", "period_key", "rounded_minutes",
    "exact_avg", "exact_sum", "ratio_pct", "round_half_up", "units",
    "code_label", "distance_band", "month_label", "payment_label", "ratecode_label",
    "vendor_label", "weekday_label",
]
