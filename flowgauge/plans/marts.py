"""The four marts.  Row order is presentation: see ``in_report_order``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgauge.functions import day_of, rate_percent, sla_threshold
from flowgauge.operators import (
    grouped_percentiles,
    join_thresholds,
    percentiles_of_counts,
    rolling_mean,
    top_k,
    value_counts,
)
from flowgauge.plans.staging import timed
from flowgauge.schemas import TOP_SLOWEST, SlaThresholds

DURATION = "calculated_duration"
BROADCAST_ROWS = 10_000  # a top-k result up to this many rows may be broadcast


def _outcomes(state: str) -> Column:
    return F.count_if(F.col("state") == state)


def dag_runtime_metrics(runs: DataFrame) -> DataFrame:
    """Runtime statistics per workflow and day, over runs with a known duration."""
    daily = timed(runs).withColumn("execution_day", day_of(F.col("execution_date")))
    return runtime_metrics_of_counts(value_counts(daily, RUNTIME_KEYS, DURATION, ["state"]))


RUNTIME_KEYS = ["dag_id", "execution_day"]


def runtime_metrics_of_counts(counts: DataFrame) -> DataFrame:
    """Runtime statistics from the runs of each duration and state, counted."""
    return percentiles_of_counts(
        counts,
        keys=RUNTIME_KEYS,
        totals={
            "total_runs": ("sum", "weight"),
            "successful_runs": ("sum", "if(state = 'success', weight, 0)"),
            "failed_runs": ("sum", "if(state = 'failed', weight, 0)"),
            "min_duration_seconds": ("min", "value"),
            "max_duration_seconds": ("max", "value"),
            "total_duration_seconds": ("sum", "value * weight"),
        },
        quantiles={"median_duration_seconds": 0.5, "p95_duration_seconds": 0.95},
    ).select(
        "dag_id",
        "execution_day",
        "total_runs",
        "successful_runs",
        "failed_runs",
        (F.col("total_duration_seconds") / F.col("total_runs")).alias("avg_duration_seconds"),
        "min_duration_seconds",
        "max_duration_seconds",
        "median_duration_seconds",
        "p95_duration_seconds",
        "total_duration_seconds",
    )


def daily_outcomes(runs: DataFrame) -> DataFrame:
    """All runs per workflow and day by outcome, with exact decimal rates."""
    daily = runs.groupBy("dag_id", day_of(F.col("execution_date")).alias("execution_day")).agg(
        F.count(F.lit(1)).alias("total_runs"),
        _outcomes("failed").alias("failed_runs"),
        _outcomes("success").alias("successful_runs"),
    )
    return with_rates(daily)


def with_rates(daily: DataFrame) -> DataFrame:
    """Counts of runs by outcome with their rates."""
    return daily.withColumns(
        {
            "failure_rate_percent": rate_percent(F.col("failed_runs"), F.col("total_runs")),
            "success_rate_percent": rate_percent(F.col("successful_runs"), F.col("total_runs")),
        }
    )


def dag_failure_rates(runs: DataFrame) -> DataFrame:
    """Failure and success rates per workflow and day, with means over 7 and 30 rows.

    Unlike the runtime metrics this counts every run, timed or not.
    """
    return failure_rates_of(daily_outcomes(runs))


def failure_rates_of(outcomes: DataFrame) -> DataFrame:
    """Rates and their rolling means from one row per workflow and day."""
    return outcomes.select(
        "dag_id",
        "execution_day",
        "total_runs",
        "failed_runs",
        "successful_runs",
        F.col("failure_rate_percent").cast("double").alias("failure_rate_percent"),
        F.col("success_rate_percent").cast("double").alias("success_rate_percent"),
        rolling_mean("failure_rate_percent", 7).alias("rolling_7d_failure_rate"),
        rolling_mean("failure_rate_percent", 30).alias("rolling_30d_failure_rate"),
    )


def task_totals(tasks: DataFrame) -> DataFrame:
    """One row per task over all its timed runs, percentiles left out."""
    return (
        timed(tasks)
        .groupBy("dag_id", "task_id")
        .agg(
            F.count(F.lit(1)).alias("total_executions"),
            F.avg(DURATION).alias("avg_duration_seconds"),
            F.max(DURATION).alias("max_duration_seconds"),
            F.sum(DURATION).alias("total_duration_seconds"),
            _outcomes("failed").alias("failed_executions"),
            _outcomes("success").alias("successful_executions"),
            F.max("extracted_at").alias("last_updated"),
        )
    )


def slowest_first(column: str) -> list[Column]:
    """Longest first, unknown last; the task's name settles ties."""
    return [F.desc_nulls_last(column), F.asc_nulls_first("dag_id"), F.asc_nulls_first("task_id")]


def _with_rank(some: DataFrame, totals: DataFrame, column: str, name: str) -> DataFrame:
    """The rows of ``some`` (a few of ``totals``) with their place among all by ``slowest_first(column)``."""
    key = F.struct(
        F.col(column).isNull().alias("unknown"), (-F.col(column)).alias("longest"), "dag_id", "task_id"
    )
    edges = some.agg(F.sort_array(F.collect_list(key)).alias("edges")).scalar()

    def placed(df: DataFrame) -> DataFrame:
        before = F.filter("edges", lambda edge: edge < key)
        return df.withColumn("edges", edges).withColumn("stretch", F.size(before)).drop("edges")

    counts = placed(totals).groupBy("stretch").agg(F.count(F.lit(1)).alias("n"))
    # Stretch i ends with edge i, so the sum up to it is that edge's rank.
    order = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, 0)
    ranks = counts.select("stretch", F.sum("n").over(order).cast("bigint").alias(name))
    return placed(some).join(F.broadcast(ranks), "stretch").drop("stretch")


def slowest_tasks(tasks: DataFrame, k: int = TOP_SLOWEST) -> DataFrame:
    """The ``k`` tasks with the longest mean runtime.

    Ranks are over all tasks.  The rank by mean is the place in the top list itself.
    For the rank by maximum, one pass over the totals counts how many lie between
    the ``k`` reported tasks in that order: the counts of at most ``k + 1`` stretches
    add up to their ranks, so the totals are never sorted.  Percentiles need the
    single runs, and are computed only for the ``k`` tasks that are reported; their
    runs travel under the place number, not under two names.
    """
    totals = task_totals(tasks)
    place = "rank_by_avg_duration"
    best = _with_rank(
        top_k(totals, slowest_first("avg_duration_seconds"), k, place),
        totals,
        "max_duration_seconds",
        "rank_by_max_duration",
    )
    task = F.struct("dag_id", "task_id").alias("_task")  # equal by field, NULL included
    places = best.select(task, place)
    if k <= BROADCAST_ROWS:
        places = F.broadcast(places)
    p95 = grouped_percentiles(
        timed(tasks).select(task, DURATION).join(places, "_task"),
        keys=[place],
        value=DURATION,
        quantiles={"p95_duration_seconds": 0.95},
    )
    return (
        best.join(p95, place)
        .select(
            "dag_id",
            "task_id",
            "total_executions",
            "avg_duration_seconds",
            "max_duration_seconds",
            "p95_duration_seconds",
            "total_duration_seconds",
            "failed_executions",
            "successful_executions",
            rate_percent(F.col("failed_executions"), F.col("total_executions"))
            .cast("double")
            .alias("failure_rate_percent"),
            "last_updated",
            "rank_by_avg_duration",
            "rank_by_max_duration",
        )
    )


def _sla_counts(timed_runs: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Runs over and within ``sla_threshold_seconds`` per group."""
    grouped = timed_runs.groupBy(*keys, "sla_threshold_seconds").agg(
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(F.col(DURATION) > F.col("sla_threshold_seconds")).alias("sla_misses"),
        F.count_if(F.col(DURATION) <= F.col("sla_threshold_seconds")).alias("sla_meets"),
        F.avg(DURATION).alias("avg_duration_seconds"),
        F.max(DURATION).alias("max_duration_seconds"),
    )
    return grouped.withColumn(
        "sla_miss_rate_percent",
        rate_percent(F.col("sla_misses"), F.col("total_count")).cast("double"),
    )


SLA_COLUMNS = (
    "entity_type",
    "dag_id",
    "identifier",
    "execution_day",
    "total_count",
    "sla_misses",
    "sla_meets",
    "sla_miss_rate_percent",
    "avg_duration_seconds",
    "max_duration_seconds",
    "sla_threshold_seconds",
)


def sla_task_daily(
    tasks: DataFrame,
    thresholds: SlaThresholds = SlaThresholds(),
    task_thresholds: DataFrame | None = None,
) -> DataFrame:
    """Service-level counts per task and day.

    Tier thresholds follow from the workflow's name, so they are a projection
    and need no join.  Give ``task_thresholds`` (dag_id, task_id,
    sla_threshold_seconds) to set them for some tasks; these are joined, and all
    other tasks keep their tier's.  Either way a task without a name has no
    threshold and is left out.
    """
    limit = sla_threshold(F.col("dag_id"), thresholds)
    named = timed(tasks).where(F.col("dag_id").isNotNull() & F.col("task_id").isNotNull())
    if task_thresholds is not None:
        named = join_thresholds(named, task_thresholds, how="left")
        limit = F.coalesce("sla_threshold_seconds", limit)
    limited = named.withColumn("sla_threshold_seconds", limit)
    day = day_of(F.col("execution_date")).alias("execution_day")
    return _sla_counts(limited, ["dag_id", "task_id", day])


def sla_dag_daily(
    runs: DataFrame, thresholds: SlaThresholds = SlaThresholds(), by_tier: bool = False
) -> DataFrame:
    """Service-level counts per workflow and day, under one limit for all workflows.

    ``by_tier`` applies the tier limits of the tasks to whole runs instead.
    """
    limit = (
        sla_threshold(F.col("dag_id"), thresholds) if by_tier else F.lit(thresholds.dag_level)
    )
    limited = timed(runs).withColumn("sla_threshold_seconds", limit)
    return _sla_counts(limited, ["dag_id", day_of(F.col("execution_date")).alias("execution_day")])


def sla_misses(
    runs: DataFrame,
    tasks: DataFrame,
    thresholds: SlaThresholds = SlaThresholds(),
    task_thresholds: DataFrame | None = None,
    dag_limit_by_tier: bool = False,
) -> DataFrame:
    """Service-level counts of tasks and of workflows in one table.

    Days without a miss are listed too; a run of exactly the allowed length
    meets its level.
    """
    of_tasks = sla_task_daily(tasks, thresholds, task_thresholds).withColumns(
        {"entity_type": F.lit("task"), "identifier": F.col("task_id")}
    )
    of_dags = sla_dag_daily(runs, thresholds, dag_limit_by_tier).withColumns(
        {"entity_type": F.lit("dag"), "identifier": F.lit(None).cast("string")}
    )
    return of_tasks.select(*SLA_COLUMNS).unionByName(of_dags.select(*SLA_COLUMNS))


def in_report_order(model: str, df: DataFrame) -> DataFrame:
    """Sort a mart for display.  A stored table keeps no order, so marts do not sort."""
    orders = {
        "dag_failure_rates": [F.asc_nulls_last("dag_id"), F.desc_nulls_first("execution_day")],
        "slowest_tasks": [F.asc("rank_by_avg_duration")],
        "sla_misses": [
            F.desc_nulls_first("execution_day"),
            F.desc_nulls_first("sla_miss_rate_percent"),
        ],
    }
    return df.orderBy(*orders[model]) if model in orders else df
