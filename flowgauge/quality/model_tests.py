"""The tests declared on sources and models, and their runner."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame

from flowgauge.quality.rules import Between, InSet, NotNull, Rule, Unique, run_rules

MODEL_TEST_SUITE = "model_tests"


def not_null(*columns: str) -> list[Rule]:
    return [NotNull(column=column) for column in columns]


def accepted_values(column: str, *values: str) -> Rule:
    return InSet(column=column, values=values)


def accepted_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    return Between(column=column, min_value=low, max_value=high)


def _percent(column: str) -> Rule:
    return accepted_range(column, 0, 100)


MODEL_TESTS: dict[str, list[Rule]] = {
    "dag_runs": not_null("dag_id", "execution_date"),
    "task_instances": not_null("dag_id", "task_id", "execution_date"),
    # A workflow runs many times, so its id repeats in a table of runs and the
    # unique test fails there.  It is declared, so it is run and reported.
    "stg_dag_runs": [
        *not_null("dag_id"),
        Unique(column="dag_id"),
        *not_null("execution_date"),
        accepted_range("calculated_duration", 0),
    ],
    "stg_task_instances": [
        *not_null("dag_id", "task_id", "execution_date"),
        accepted_range("calculated_duration", 0),
        accepted_range("try_number", 1),
    ],
    "dag_runtime_metrics": not_null("dag_id", "execution_day"),
    "dag_failure_rates": [
        *not_null("dag_id", "execution_day"),
        _percent("failure_rate_percent"),
        _percent("success_rate_percent"),
    ],
    "slowest_tasks": [*not_null("dag_id", "task_id"), _percent("failure_rate_percent")],
    "sla_misses": [
        accepted_values("entity_type", "dag", "task"),
        *not_null("dag_id", "execution_day"),
        _percent("sla_miss_rate_percent"),
    ],
}


def run_model_tests(relations: Mapping[str, DataFrame]) -> DataFrame:
    """Result rows of the declared tests of every given relation."""
    parts = [
        run_rules(df, MODEL_TESTS[name], MODEL_TEST_SUITE, name)
        for name, df in relations.items()
        if name in MODEL_TESTS
    ]
    return reduce(DataFrame.unionByName, parts)
