"""DataFrame -> DataFrame operators of the trip layers."""

from meterline.operators.cleaning import (
    FILL_VALUES, add_avg_speed, add_calendar_keys, add_distance_band, add_trip_time, cast_columns,
    fill_all_numeric, fill_missing, fill_unknown_zones, label_day, label_month, map_codes, map_payment,
    map_ratecode, map_vendor,
)
from meterline.operators.dedup import DEDUP_KEYS, drop_duplicate_trips, duplicate_groups
from meterline.operators.gold import bucket_metrics, passenger_metrics, period_comparison, trip_metrics
from meterline.operators.preview import distinct_months, preview
from meterline.operators.profile import (
    describe_columns, financial_split, histogram, null_counts, row_count, rule_violations, time_range,
)
from meterline.operators.quantiles import (
    approx_quantiles, exact_quantiles, iqr_bounds, quartile_report, remove_outliers_iqr,
)
from meterline.operators.rules import (
    consistency_filter, keep_rules, money_consistent, period_filter, validate_financials, violation_rules,
)
from meterline.operators.zones import (
    flag_unknown_zones, invalid_zone_count, invalid_zones, known_zones_only, map_location_to_zone,
)
