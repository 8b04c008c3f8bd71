"""One daily run: load, check, build, test."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from flowgauge.plans.models import build_models, stored_relations
from flowgauge.quality.checks import (
    STANDARD_SUITE,
    run_standard_checks,
    standard_checks,
    summarize,
    table_exists,
)
from flowgauge.quality.model_tests import MODEL_TEST_SUITE, MODEL_TESTS
from flowgauge.quality.rules import run_rule_sets, settled
from flowgauge.quality.suites import dag_runs_suite, task_instances_suite
from flowgauge.schemas import SlaThresholds
from flowgauge.sources.load import extract_and_load, load_window
from flowgauge.sources.readers import Source

log = logging.getLogger(__name__)

RESULTS_TABLE = "quality_results"
TESTS_TABLE = "model_test_results"


class QualityError(RuntimeError):
    """Checks failed and the caller asked for that to stop the run."""


@dataclass(frozen=True)
class PipelineResult:
    counts: dict[str, int]
    all_passed: bool
    passed_count: int
    total_count: int
    checks: DataFrame
    models: list[str]
    tests: DataFrame | None = None


def run_all_rules(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | None],
    as_of: datetime,
    run: Callable[..., DataFrame] = run_rule_sets,
) -> DataFrame:
    """The standard battery and the rule suites of both tables, one scan per table.

    With a table missing there is only the battery's report of that.  With
    ``run=settled`` the checks run now, and an error of one rule is its failed row.
    """
    if any(df is None for df in tables.values()):
        return run_standard_checks(spark, tables, as_of)
    parts = [
        run(
            tables[suite.table],
            {STANDARD_SUITE: standard_checks(suite.table, as_of), suite.name: suite.rules},
            suite.table,
        )
        for suite in (dag_runs_suite(), task_instances_suite())
    ]
    return reduce(DataFrame.unionByName, parts)


def run_tests(spark: SparkSession, names: list[str], database: str) -> DataFrame:
    """The declared tests of the named tables and models, as stored in ``model_test_results``."""
    relations = stored_relations(spark, database, names)
    parts = [settled(relations[n], {MODEL_TEST_SUITE: MODEL_TESTS[n]}, n) for n in names if n in MODEL_TESTS]
    stored = f"{database}.{TESTS_TABLE}"
    reduce(DataFrame.unionByName, parts).write.mode("overwrite").saveAsTable(stored)
    results = spark.table(stored)
    for row in results.where("not passed").collect():
        log.warning("test %s: %s", row.check_name, row.message)
    return results


def run_pipeline(
    spark: SparkSession,
    runs_source: Source,
    tasks_source: Source,
    logical_time: datetime,
    as_of: datetime | None = None,
    database: str = "default",
    on_failure: str = "warn",
    select: list[str] | None = None,
    thresholds: SlaThresholds = SlaThresholds(),
    dedupe: bool = False,
    only_changed: bool = False,
) -> PipelineResult:
    """Load the day before ``logical_time``, check both tables, build the models, test them.

    ``as_of`` is the clock of the whole run, now if not given: rows are stamped with
    it and judged by it.  ``dedupe`` drops what overlapping windows loaded twice; with
    ``only_changed`` models with the same query and files as last time are neither built nor tested.

    Failed checks are warned about and the run goes on, unless ``on_failure`` is
    ``'raise'``.  Errors of the run itself always surface.  The check results
    are kept in ``quality_results``, those of the declared tests of sources and models
    in ``model_test_results``; both are read back from there, so that nothing is
    checked twice.  A failed test is warned about only: some are declared that fail
    by nature.
    """
    if on_failure not in ("warn", "raise"):
        raise ValueError("on_failure must be 'warn' or 'raise'")
    as_of = as_of or datetime.now(timezone.utc).replace(tzinfo=None)
    start, end = load_window(logical_time)
    counts = extract_and_load(spark, runs_source, tasks_source, start, end, as_of, database)
    log.info("loaded %s", counts)

    names = ("dag_runs", "task_instances")
    tables = {
        name: spark.table(f"{database}.{name}") if table_exists(spark, f"{database}.{name}") else None
        for name in names
    }
    results = run_all_rules(spark, tables, as_of, settled)
    stored = f"{database}.{RESULTS_TABLE}"
    results.write.mode("overwrite").saveAsTable(stored)
    checks = spark.table(stored)
    summary = summarize(checks).first()
    if not summary["all_passed"]:
        broken = summary["total_count"] - summary["passed_count"]
        text = f"{broken} of {summary['total_count']} quality checks failed, see {stored}"
        if on_failure == "raise":
            raise QualityError(text)
        log.warning("%s", text)

    models: list[str] = []
    tests = None
    if all(df is not None for df in tables.values()):
        models = build_models(spark, tables, select, database, thresholds, dedupe, only_changed)
        tests = run_tests(spark, [*names, *models], database)
    return PipelineResult(counts, *summary, checks, models, tests)
