"""Data-quality rules, compiled to one aggregate per table."""

from flowgauge.quality.checks import run_standard_checks, standard_checks, summarize
from flowgauge.quality.footers import run_footer_rules
from flowgauge.quality.model_tests import MODEL_TESTS, run_model_tests
from flowgauge.quality.rules import (
    Between,
    FreshWithin,
    InSet,
    NotNull,
    NullShare,
    PairOrder,
    RowCount,
    Rule,
    Unique,
    run_rules,
)
from flowgauge.quality.suites import (
    Suite,
    dag_runs_suite,
    run_suite,
    statistics,
    suite_dict,
    suite_from_rows,
    suite_rows,
    task_instances_suite,
)

__all__ = [
    "Between",
    "FreshWithin",
    "InSet",
    "MODEL_TESTS",
    "NotNull",
    "NullShare",
    "PairOrder",
    "RowCount",
    "Rule",
    "Suite",
    "Unique",
    "dag_runs_suite",
    "run_footer_rules",
    "run_model_tests",
    "run_rules",
    "run_standard_checks",
    "run_suite",
    "standard_checks",
    "statistics",
    "suite_dict",
    "suite_from_rows",
    "suite_rows",
    "summarize",
    "task_instances_suite",
]
