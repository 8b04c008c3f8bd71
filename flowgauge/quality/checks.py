"""The standard battery that runs after every load, and its summary."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.quality.rules import (
    FreshWithin,
    NullShare,
    RowCount,
    Rule,
    TableExists,
    failed_result,
    run_rules,
)
from flowgauge.schemas import MAX_AGE_HOURS

STANDARD_SUITE = "standard"
REQUIRED_COLUMNS = {
    "dag_runs": ("dag_id", "execution_date"),
    "task_instances": ("task_id", "dag_id"),
}


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether the catalog has the table; any catalog error counts as no."""
    try:
        return spark.catalog.tableExists(table)
    except Exception:  # noqa: BLE001 - an unreachable catalog is an answer here
        return False


def standard_checks(
    table: str,
    as_of: datetime,
    min_rows: int = 0,
    max_null_share: float = 0.0,
    max_age_hours: float = MAX_AGE_HOURS,
) -> list[Rule]:
    """Row count, NULLs in two identifying columns, and freshness."""
    nulls = [
        NullShare(column=column, max_share=max_null_share) for column in REQUIRED_COLUMNS[table]
    ]
    fresh = FreshWithin(
        as_of=as_of, max_age_hours=max_age_hours, name=f"freshness_check_{table}"
    )
    return [RowCount(min_rows=min_rows), *nulls, fresh]


def run_standard_checks(
    spark: SparkSession, tables: Mapping[str, DataFrame | None], as_of: datetime, **limits: float
) -> DataFrame:
    """Result rows of the battery over both tables, one scan each.

    If a required table is missing (None) nothing else is checked: the result
    is one failed row per missing table.
    """
    absent = [name for name in REQUIRED_COLUMNS if tables.get(name) is None]
    if absent:
        anchor = spark.range(1)
        parts = [
            failed_result(
                anchor,
                TableExists(),
                STANDARD_SUITE,
                name,
                "required table is missing",
            )
            for name in absent
        ]
    else:
        parts = [
            run_rules(tables[name], standard_checks(name, as_of, **limits), STANDARD_SUITE, name)
            for name in REQUIRED_COLUMNS
        ]
    return reduce(DataFrame.unionByName, parts)


def summarize(results: DataFrame) -> DataFrame:
    """One row: all_passed, passed_count, total_count."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("all_passed"),
        F.count_if("passed").alias("passed_count"),
        F.count(F.lit(1)).alias("total_count"),
    )
