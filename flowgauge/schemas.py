"""Fixed schemas, state sets and thresholds of the run-history data model."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values: must equal the source system's for right results ----------
RUN_STATES = (
    "success",
    "failed",
    "running",
    "queued",
    "scheduled",
    "skipped",
    "up_for_retry",
    "up_for_reschedule",
    "upstream_failed",
    "none",
)
TASK_STATES = (
    "success",
    "failed",
    "running",
    "queued",
    "scheduled",
    "skipped",
    "up_for_retry",
    "up_for_reschedule",
    "upstream_failed",
    "removed",
    "restarting",
    "none",
)
IN_PROGRESS_STATES = ("running", "queued", "scheduled")
MAX_AGE_HOURS = 25
JDBC_BATCH_ROWS = 1000
TOP_SLOWEST = 10
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class SlaThresholds:
    """Allowed seconds per tier; ``dag_level`` holds for whole runs of any tier."""

    # The documented service levels.
    critical: int = 3600
    daily: int = 7200
    default: int = 10800
    dag_level: int = 7200


def _field(name: str, dtype: T.DataType, comment: str, nullable: bool = True) -> T.StructField:
    return T.StructField(name, dtype, nullable, {"comment": comment})


_NTZ = T.TimestampNTZType()

DAG_RUNS = T.StructType(
    [
        _field("dag_id", T.StringType(), "workflow this run belongs to"),
        _field("execution_date", _NTZ, "logical time the run was scheduled for (UTC)"),
        _field("state", T.StringType(), "last known state of the run"),
        _field("start_date", _NTZ, "when work began (UTC)"),
        _field("end_date", _NTZ, "when work stopped; empty while in progress (UTC)"),
        _field("duration", T.DoubleType(), "seconds from start to end, when both are known"),
        _field("extracted_at", _NTZ, "when this copy was taken (UTC)"),
    ]
)

TASK_INSTANCES = T.StructType(
    [
        _field("dag_id", T.StringType(), "workflow the task belongs to"),
        _field("task_id", T.StringType(), "task inside the workflow"),
        _field("execution_date", _NTZ, "logical time the task was scheduled for (UTC)"),
        _field("state", T.StringType(), "last known state of the task"),
        _field("start_date", _NTZ, "when work began (UTC)"),
        _field("end_date", _NTZ, "when work stopped; empty while in progress (UTC)"),
        _field("duration", T.DoubleType(), "seconds of work as reported by the scheduler"),
        _field("try_number", T.IntegerType(), "attempt count, starting at 1"),
        _field("extracted_at", _NTZ, "when this copy was taken (UTC)"),
    ]
)

LOAD_DATE = _field("load_date", T.DateType(), "day of the load that wrote the row; partition column")

LOAD_ID = _field("load_id", T.StringType(), "window of the load that wrote the row; partition column")

CHECK_RESULT = T.StructType(
    [
        _field("suite", T.StringType(), "group of checks this one ran in"),
        _field("check_name", T.StringType(), "unique name of the check inside its suite"),
        _field("check_type", T.StringType(), "kind of rule"),
        _field("table_name", T.StringType(), "table that was checked"),
        _field("column_name", T.StringType(), "column that was checked"),
        _field("passed", T.BooleanType(), "verdict"),
        _field("evaluated", T.LongType(), "rows the rule looked at"),
        _field("failed", T.LongType(), "rows (or values) that broke the rule"),
        _field("observed", T.DoubleType(), "measured figure"),
        _field("threshold", T.DoubleType(), "limit for the measured figure"),
        _field("error", T.StringType(), "why the check could not be evaluated"),
        _field("message", T.StringType(), "verdict in words"),
    ]
)

TABLE_COMMENTS = {
    "dag_runs": "copied history of workflow runs",
    "task_instances": "copied history of task runs",
}

#: Table and column descriptions of the models; stored with the tables.
MODEL_COMMENTS: dict[str, tuple[str, dict[str, str]]] = {
    "stg_dag_runs": (
        "workflow runs with one dependable duration",
        {"calculated_duration": "stored duration, or end minus start in seconds"},
    ),
    "stg_task_instances": (
        "task runs with one dependable duration",
        {"calculated_duration": "stored duration, or end minus start in seconds"},
    ),
    "dag_runtime_metrics": (
        "runtime statistics per workflow and day",
        {
            "dag_id": "workflow",
            "execution_day": "midnight of the scheduled day",
            "total_runs": "runs with a known duration",
            "successful_runs": "of these, runs that succeeded",
            "failed_runs": "of these, runs that failed",
            "avg_duration_seconds": "mean runtime",
            "min_duration_seconds": "shortest runtime",
            "max_duration_seconds": "longest runtime",
            "median_duration_seconds": "interpolated median runtime",
            "p95_duration_seconds": "interpolated 95th percentile of runtime",
            "total_duration_seconds": "summed runtime",
        },
    ),
    "dag_failure_rates": (
        "failure and success rates per workflow and day, with rolling means",
        {
            "dag_id": "workflow",
            "execution_day": "midnight of the scheduled day",
            "total_runs": "all runs of the day",
            "failed_runs": "runs that failed",
            "successful_runs": "runs that succeeded",
            "failure_rate_percent": "failed share of the day's runs, in percent",
            "success_rate_percent": "successful share of the day's runs, in percent",
            "rolling_7d_failure_rate": "mean failure rate of the latest 7 days with runs",
            "rolling_30d_failure_rate": "mean failure rate of the latest 30 days with runs",
        },
    ),
    "slowest_tasks": (
        "tasks with the longest mean runtime",
        {
            "dag_id": "workflow",
            "task_id": "task",
            "total_executions": "task runs with a known duration",
            "avg_duration_seconds": "mean runtime",
            "max_duration_seconds": "longest runtime",
            "p95_duration_seconds": "interpolated 95th percentile of runtime",
            "total_duration_seconds": "summed runtime",
            "failed_executions": "task runs that failed",
            "successful_executions": "task runs that succeeded",
            "failure_rate_percent": "failed share, in percent",
            "last_updated": "newest load time among the task's rows",
            "rank_by_avg_duration": "place by mean runtime among all tasks",
            "rank_by_max_duration": "place by longest runtime among all tasks",
        },
    ),
    "sla_misses": (
        "service-level misses per day, for tasks and for whole workflows",
        {
            "entity_type": "'task' or 'dag'",
            "dag_id": "workflow",
            "identifier": "task; empty for workflow rows",
            "execution_day": "midnight of the scheduled day",
            "total_count": "runs with a known duration",
            "sla_misses": "runs longer than allowed",
            "sla_meets": "runs within the limit",
            "sla_miss_rate_percent": "missed share, in percent",
            "avg_duration_seconds": "mean runtime",
            "max_duration_seconds": "longest runtime",
            "sla_threshold_seconds": "seconds allowed",
        },
    ),
}


def with_comments(df: DataFrame, model: str) -> DataFrame:
    """Attach the descriptions of ``model``; ``saveAsTable`` stores them."""
    _, columns = MODEL_COMMENTS[model]

    def described(name: str) -> Column:
        if name not in columns:
            return F.col(name)
        return F.col(name).alias(name, metadata={"comment": columns[name]})

    return df.select(*[described(name) for name in df.columns])
