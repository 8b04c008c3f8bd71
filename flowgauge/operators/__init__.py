"""Reusable DataFrame operators: percentiles, ranks, rolling means, joins, loads of one row per key."""

from flowgauge.operators.asof import join_thresholds_asof
from flowgauge.operators.calendar import calendar_means, calendar_spine
from flowgauge.operators.patterns import matched_levels, sla_from_patterns
from flowgauge.operators.percentile import (
    counts_by_group,
    grouped_percentiles,
    percentiles_of_counts,
    value_counts,
)
from flowgauge.operators.ranking import global_row_number, top_k
from flowgauge.operators.relational import (
    distinct_tasks,
    hot_tasks,
    join_thresholds,
    latest_per_key,
    sla_thresholds,
)
from flowgauge.operators.rolling import rolling_mean
from flowgauge.operators.sketch import merge_sketches, quantiles_of, rank_error, sketched_percentiles, sketches

__all__ = [
    "calendar_means",
    "calendar_spine",
    "counts_by_group",
    "distinct_tasks",
    "global_row_number",
    "grouped_percentiles",
    "hot_tasks",
    "join_thresholds",
    "join_thresholds_asof",
    "latest_per_key",
    "matched_levels",
    "merge_sketches",
    "percentiles_of_counts",
    "quantiles_of",
    "rank_error",
    "rolling_mean",
    "sketched_percentiles",
    "sketches",
    "sla_from_patterns",
    "sla_thresholds",
    "top_k",
    "value_counts",
]
