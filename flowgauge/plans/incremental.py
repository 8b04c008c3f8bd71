"""Marts that follow the loads: only the days that a load touched are computed again.

Two tables hold partial aggregates: how many runs (task runs) of a workflow (task) and a
day ended in each state with each duration.  Such counts can be added and taken away, so
what a merge put in and took out of the raw tables is all that is needed to bring the
counts of a day up to date; the raw tables are not read.  The marts of the touched days
are then made from the counts of these days.  Partials and marts are split by day, and
only partitions of touched days are read and replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions import calculated_duration, day_of, rate_percent, sla_threshold
from flowgauge.operators import counts_by_group
from flowgauge.plans import marts
from flowgauge.schemas import SlaThresholds
from flowgauge.session import ensure_checkpoint_dir
from flowgauge.sources.merge import MergeResult
from flowgauge.sources.partitions import is_one_of, replace_partitions, stored_partitions

#: The partition column of partials and marts: the day as text, and a name for runs without a time.
DAY, NO_DAY = "day", "none"
RUN_PARTIALS, TASK_PARTIALS = "run_partials", "task_partials"
#: Raw table and what a count of its partials is of.
PARTIALS: dict[str, tuple[str, tuple[str, ...]]] = {
    RUN_PARTIALS: ("dag_runs", ("dag_id",)),
    TASK_PARTIALS: ("task_instances", ("dag_id", "task_id")),
}
MARTS = ("dag_runtime_metrics", "dag_failure_rates", "sla_misses")

_VALUE, _WEIGHT = "duration", "weight"


def _day_name(day: str = "execution_day") -> Column:
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NO_DAY)).alias(DAY)


def partial_counts(rows: DataFrame, names: Sequence[str], sign: str | None = None) -> DataFrame:
    """(names, execution_day, state, duration, weight, day): raw rows counted, or their signs added up.

    ``duration`` is null where none is known.  Runs of all states are counted: rates need them.
    """
    weight = F.sum(F.col(sign).cast("long")) if sign else F.count(F.lit(1))
    return (
        rows.groupBy(
            *names,
            day_of(F.col("execution_date")).alias("execution_day"),
            "state",
            calculated_duration().alias(_VALUE),
        )
        .agg(weight.alias(_WEIGHT))
        .withColumn(DAY, _day_name())
    )


def _ensure(df: DataFrame, table: str) -> None:
    """The table, split by day, if it is absent."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(table):
        rest = [c for c in df.columns if c != DAY]
        df.where("false").select(*rest, DAY).write.partitionBy(DAY).saveAsTable(table)


def _days(names: Iterable[str]) -> list[tuple[str, ...]]:
    return [(name,) for name in sorted(set(names))]


def _of_days(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.where(is_one_of([DAY], _days(names)))


def merge_partials(spark: SparkSession, table: str, names: Sequence[str], changes: DataFrame) -> set[str]:
    """Add signed rows to the stored counts of their days; returns the days that changed.

    The days are collected: one row for each day that a load touches.  A count that comes to nothing goes, and
    with its last count a day.
    """
    ensure_checkpoint_dir(spark)
    delta = partial_counts(changes, names, "sign").where(f"{_WEIGHT} <> 0").checkpoint()
    touched = {row[0] for row in delta.select(DAY).distinct().collect()}
    _ensure(delta, table)
    if touched:
        keys = [c for c in delta.columns if c != _WEIGHT]
        stored = _of_days(spark.table(table), touched).select(*delta.columns)
        summed = stored.unionByName(delta).groupBy(*keys).agg(F.sum(_WEIGHT).alias(_WEIGHT))
        replace_partitions(summed.where(f"{_WEIGHT} <> 0"), table, _days(touched), [DAY])
    return touched


def rebuild_partials(spark: SparkSession, database: str, days: Iterable[str] | None = None) -> dict[str, set[str]]:
    """Count the given days (all, if none are) afresh from the raw tables, e.g. after a run that broke off.

    Returns the days whose partitions were written, per table of partials.
    """
    found = {}
    for table, (raw, names) in PARTIALS.items():
        counted = partial_counts(spark.table(f"{database}.{raw}"), names)
        _ensure(counted, f"{database}.{table}")
        if days is None:
            wanted = {row[0] for row in counted.select(DAY).distinct().collect()}
            wanted |= {p[0] for p in stored_partitions(spark, f"{database}.{table}", [DAY])}
        else:
            wanted = set(days)
        replace_partitions(_of_days(counted, wanted), f"{database}.{table}", _days(wanted), [DAY])
        found[table] = wanted
    return found


def runtime_metrics(partials: DataFrame) -> DataFrame:
    """``marts.dag_runtime_metrics`` from counts."""
    known = partials.where(F.col(_VALUE).isNotNull())
    return marts.runtime_metrics_of_counts(
        counts_by_group(known, marts.RUNTIME_KEYS, _VALUE, _WEIGHT, ["state"])
    )


def _outcomes(partials: DataFrame) -> DataFrame:
    def ended(state: str) -> Column:
        return F.sum(F.when(F.col("state") == state, F.col(_WEIGHT)).otherwise(0))

    return partials.groupBy("dag_id", "execution_day").agg(
        F.sum(_WEIGHT).alias("total_runs"), ended("failed").alias("failed_runs"), ended("success").alias("successful_runs")
    )


def failure_rates(stored: DataFrame, partials: DataFrame, touched: Iterable[str]) -> DataFrame:
    """``marts.dag_failure_rates`` of the touched days and all later ones, whose rolling means see them.

    ``partials`` are those of the touched days; the outcomes of the other days come from the mart
    itself, one row per workflow and day.
    """
    columns = ["dag_id", "execution_day", "total_runs", "failed_runs", "successful_runs"]
    others = stored.where(~is_one_of([DAY], _days(touched))).select(*columns)
    rates = marts.failure_rates_of(marts.with_rates(others.unionByName(_outcomes(partials).select(*columns))))
    first = min((d for d in touched if d != NO_DAY), default=None)
    now = rates.withColumn(DAY, _day_name())
    # Null days come first in a frame, so that all days come after them.
    return now if NO_DAY in touched or first is None else now.where((F.col(DAY) >= first) & (F.col(DAY) != NO_DAY))


def _sla(partials: DataFrame, names: Sequence[str], limit: Column) -> DataFrame:
    known = partials.where(F.col(_VALUE).isNotNull()).withColumn("sla_threshold_seconds", limit)
    over = F.col(_VALUE) > F.col("sla_threshold_seconds")
    grouped = known.groupBy(*names, "execution_day", "sla_threshold_seconds").agg(
        F.sum(_WEIGHT).alias("total_count"),
        F.sum(F.when(over, F.col(_WEIGHT)).otherwise(0)).alias("sla_misses"),
        F.sum(F.when(~over, F.col(_WEIGHT)).otherwise(0)).alias("sla_meets"),
        (F.sum(F.col(_VALUE) * F.col(_WEIGHT)) / F.sum(_WEIGHT)).alias("avg_duration_seconds"),
        F.max(_VALUE).alias("max_duration_seconds"),
    )
    rate = rate_percent(F.col("sla_misses"), F.col("total_count")).cast("double")
    return grouped.withColumn("sla_miss_rate_percent", rate)


def sla_misses(runs: DataFrame, tasks: DataFrame, thresholds: SlaThresholds = SlaThresholds()) -> DataFrame:
    """``marts.sla_misses`` from counts; its means come from sums of durations, so a last bit may differ."""
    named = tasks.where(F.col("dag_id").isNotNull() & F.col("task_id").isNotNull())
    of_tasks = _sla(named, ("dag_id", "task_id"), sla_threshold(F.col("dag_id"), thresholds))
    of_dags = _sla(runs, ("dag_id",), F.lit(thresholds.dag_level))
    of_tasks = of_tasks.withColumns({"entity_type": F.lit("task"), "identifier": F.col("task_id")})
    of_dags = of_dags.withColumns({"entity_type": F.lit("dag"), "identifier": F.lit(None).cast("string")})
    return of_tasks.select(*marts.SLA_COLUMNS).unionByName(of_dags.select(*marts.SLA_COLUMNS))


def refresh_marts(
    spark: SparkSession,
    database: str,
    touched: Mapping[str, Iterable[str]],
    thresholds: SlaThresholds = SlaThresholds(),
) -> None:
    """Make the marts of the touched days anew from the partials of these days."""
    run_days, task_days = (set(touched.get(name, ())) for name in (RUN_PARTIALS, TASK_PARTIALS))
    runs, tasks = (spark.table(f"{database}.{name}") for name in (RUN_PARTIALS, TASK_PARTIALS))

    def replace(name: str, df: DataFrame, days: Iterable[str]) -> None:
        with_day = df if DAY in df.columns else df.withColumn(DAY, _day_name())
        _ensure(with_day, f"{database}.{name}")
        replace_partitions(with_day, f"{database}.{name}", _days(days), [DAY])

    if run_days:
        replace("dag_runtime_metrics", runtime_metrics(_of_days(runs, run_days)), run_days)
        rates = f"{database}.dag_failure_rates"
        if not spark.catalog.tableExists(rates):
            _ensure(marts.failure_rates_of(marts.with_rates(_outcomes(runs))).withColumn(DAY, _day_name()), rates)
        later = {d for d, in stored_partitions(spark, rates, [DAY]) if NO_DAY in run_days or d != NO_DAY and d >= min(run_days)}
        replace("dag_failure_rates", failure_rates(spark.table(rates), _of_days(runs, run_days), run_days), run_days | later)
    if either := run_days | task_days:
        replace("sla_misses", sla_misses(_of_days(runs, either), _of_days(tasks, either), thresholds), either)


def apply_merges(
    spark: SparkSession,
    database: str,
    merged: Mapping[str, MergeResult],
    thresholds: SlaThresholds = SlaThresholds(),
) -> dict[str, set[str]]:
    """Bring partials and marts up to date after ``extract_and_merge``; returns the days touched.

    The marts are those of ``MARTS``, each with the column ``day`` beside its own.  If a run breaks off
    between the merge and this, what the merge changed is known to the raw tables alone:
    ``rebuild_partials`` of the load's days, and ``refresh_marts`` with what it returns, put that right.
    """
    touched = {}
    for table, (raw, names) in PARTIALS.items():
        if raw in merged:
            touched[table] = merge_partials(spark, f"{database}.{table}", names, merged[raw].changes)
        else:
            _ensure(partial_counts(spark.table(f"{database}.{raw}"), names), f"{database}.{table}")
    refresh_marts(spark, database, touched, thresholds)
    return touched

