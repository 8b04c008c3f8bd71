"""Extracting one window of run history."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions import run_duration, time_literal
from flowgauge.schemas import DAG_RUNS, TASK_INSTANCES
from flowgauge.sources.readers import Source, scan

_DERIVED = ("duration", "extracted_at")  # set by the run extract itself
RUN_SOURCE = T.StructType([f for f in DAG_RUNS if f.name not in _DERIVED])
TASK_SOURCE = T.StructType([f for f in TASK_INSTANCES if f.name != "extracted_at"])


def incremental_window(
    df: DataFrame,
    start: datetime | None = None,
    end: datetime | None = None,
    column: str = "execution_date",
) -> DataFrame:
    """Rows from ``start`` to ``end``, both included and both optional.

    The bounds are literals of the column's own type, which lets the filter
    reach the Parquet or database scan.
    """
    dtype = df.schema[column].dataType
    if start is not None:
        df = df.where(F.col(column) >= time_literal(start, dtype))
    if end is not None:
        df = df.where(F.col(column) <= time_literal(end, dtype))
    return df


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as plain times of the session's zone, which is how raw history is stored."""
    instants = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in instants})


def _load_time(as_of: datetime | None) -> Column:
    """One load time for the whole extract: given, or the time the query starts."""
    if as_of is None:
        return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()).cast("timestamp_ntz")
    return time_literal(as_of, T.TimestampNTZType())


def extract_dag_runs(
    spark: SparkSession,
    source: Source,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Runs scheduled in the window, with their duration and the load time."""
    raw = scan(spark, source, RUN_SOURCE, start, end).select(*RUN_SOURCE.names)
    return (
        _plain_times(incremental_window(raw, start, end))
        .withColumn("duration", run_duration(F.col("start_date"), F.col("end_date")))
        .withColumn("extracted_at", _load_time(as_of))
    )


def extract_task_instances(
    spark: SparkSession,
    source: Source,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: datetime | None = None,
) -> DataFrame:
    """Task runs scheduled in the window; their duration is the source's own."""
    raw = scan(spark, source, TASK_SOURCE, start, end).select(*TASK_SOURCE.names)
    windowed = _plain_times(incremental_window(raw, start, end))
    return windowed.withColumn("extracted_at", _load_time(as_of))
