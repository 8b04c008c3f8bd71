"""Staging models: the raw columns plus one dependable duration."""

from __future__ import annotations

from pyspark.sql import DataFrame

from flowgauge.functions import calculated_duration, has_duration
from flowgauge.operators import latest_per_key
from flowgauge.schemas import DAG_RUNS, TASK_INSTANCES


def stg_dag_runs(dag_runs: DataFrame, dedupe: bool = False) -> DataFrame:
    """``dedupe`` keeps the newest copy of a run; a run is known by workflow and logical time."""
    raw = dag_runs.select(*DAG_RUNS.names)
    if dedupe:
        raw = latest_per_key(raw, ["dag_id", "execution_date"])
    return raw.withColumn("calculated_duration", calculated_duration())


def stg_task_instances(task_instances: DataFrame, dedupe: bool = False) -> DataFrame:
    """``dedupe`` keeps the newest copy of a task run, attempts apart."""
    raw = task_instances.select(*TASK_INSTANCES.names)
    if dedupe:
        raw = latest_per_key(raw, ["dag_id", "task_id", "execution_date", "try_number"])
    return raw.withColumn("calculated_duration", calculated_duration())


def timed(staged: DataFrame) -> DataFrame:
    """Only rows whose duration is known."""
    return staged.where(has_duration())
