"""Column expressions shared by all models and checks."""

from flowgauge.functions.expressions import (
    age_hours,
    calculated_duration,
    day_of,
    has_duration,
    is_in_progress,
    parse_timestamp,
    percent_text,
    rate_percent,
    run_duration,
    seconds_between,
    sla_threshold,
    state_bucket,
    time_literal,
)

__all__ = [
    "age_hours",
    "calculated_duration",
    "day_of",
    "has_duration",
    "is_in_progress",
    "parse_timestamp",
    "percent_text",
    "rate_percent",
    "run_duration",
    "seconds_between",
    "sla_threshold",
    "state_bucket",
    "time_literal",
]
