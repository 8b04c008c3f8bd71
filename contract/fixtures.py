"""Run history derived by Spark from the ``events`` table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowgauge.schemas import DAG_RUNS, TASK_INSTANCES

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns in use, under a fixed schema: no file is opened to plan a query."""
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


_BASE = (
    "event_id",
    "event_type",
    """concat(CASE WHEN user_id % 10 = 0 THEN 'critical_' WHEN user_id % 10 IN (1, 2) THEN 'daily_'
              ELSE 'adhoc_' END, string(user_id % 10)) AS dag_id""",
    "ts AS execution_date",
    "bigint(round(value * 100)) AS secs",
    "ts + (event_id % 60) * INTERVAL '1' SECOND AS start_date",
    "ts + INTERVAL '1' DAY AS extracted_at",
)


def dag_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run per event."""
    return (
        events(spark, sf_dir)
        .selectExpr(
            *_BASE,
            """CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'running'
               WHEN 'signup' THEN 'queued' ELSE 'success' END AS state""",
        )
        .selectExpr(
            "*",
            """CASE WHEN state NOT IN ('running', 'queued')
               THEN start_date + secs * INTERVAL '1' SECOND END AS end_date""",
            """CASE WHEN state NOT IN ('running', 'queued') AND event_id % 5 <> 0
               THEN double(secs) END AS duration""",
        )
        .select(*DAG_RUNS.names)
    )


def task_instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three task runs per event; made by a generator, not by a join."""
    return (
        events(spark, sf_dir)
        .selectExpr(
            *_BASE,
            "stack(3, 'extract', 1, 'transform', 2, 'load', 3) AS (task_id, k)",
        )
        .selectExpr(
            "* EXCEPT (secs)",
            "secs * k AS secs",
            """CASE WHEN event_type = 'error' AND k = 3 THEN 'failed'
                    WHEN event_type = 'error' AND k = 2 THEN 'up_for_retry'
                    WHEN event_type = 'purchase' AND k = 3 THEN 'running'
                    ELSE 'success' END AS state""",
        )
        .selectExpr(
            "*",
            """CASE WHEN state <> 'running'
               THEN start_date + secs * INTERVAL '1' SECOND END AS end_date""",
            "CASE WHEN state <> 'running' AND event_id % 5 <> 0 THEN double(secs) END AS duration",
            "int(1 + (event_id + k) % 3) AS try_number",
        )
        .select(*TASK_INSTANCES.names)
    )


def dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Task-like rows with planted faults, for the quality checks."""
    return (
        events(spark, sf_dir)
        .selectExpr(
            "*", "CASE WHEN event_id % 79 = 0 THEN -60 ELSE bigint(round(value * 100)) END AS secs"
        )
        .selectExpr(
            "CASE WHEN event_id % 97 <> 0 THEN concat('d', user_id % 10) END AS dag_id",
            "'load' AS task_id",
            "ts AS execution_date",
            """CASE WHEN event_id % 89 = 0 THEN 'bogus' WHEN event_id % 83 = 0 THEN NULL
                    WHEN event_type = 'error' THEN 'failed'
                    WHEN event_type = 'purchase' THEN 'running' ELSE 'success' END AS state""",
            "ts AS start_date",
            """CASE WHEN event_type <> 'purchase'
               THEN ts + secs * INTERVAL '1' SECOND END AS end_date""",
            "CASE WHEN event_type <> 'purchase' THEN double(secs) END AS duration",
            "int(CASE WHEN event_id % 71 = 0 THEN 0 ELSE 1 + event_id % 3 END) AS try_number",
            "ts + INTERVAL '1' DAY AS extracted_at",
        )
    )
