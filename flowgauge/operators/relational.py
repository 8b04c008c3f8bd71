"""Distinct tasks, thresholds, the thresholds join, and newest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.functions import sla_threshold
from flowgauge.schemas import SlaThresholds
from flowgauge.session import ensure_checkpoint_dir

BROADCAST_ROWS = 50_000
#: Runs of one task that one task of a join takes; and the most tasks that may count as hot.
HOT_ROWS, MOST_HOT = 4_000_000, 1000


def distinct_tasks(tasks: DataFrame) -> DataFrame:
    """Every (workflow, task) pair once; duplicates are dropped before the shuffle."""
    return tasks.select("dag_id", "task_id").distinct()


def sla_thresholds(tasks: DataFrame, thresholds: SlaThresholds = SlaThresholds()) -> DataFrame:
    """Allowed seconds of every task seen, by the tier of its workflow."""
    return distinct_tasks(tasks).withColumn(
        "sla_threshold_seconds", sla_threshold(F.col("dag_id"), thresholds)
    )


def hot_tasks(tasks: DataFrame, above: int = HOT_ROWS) -> DataFrame:
    """(dag_id, task_id, _salts): tasks with so many runs that these are spread, and over how many parts.

    A task is hot above ``above`` runs, and above a thousandth of all runs: so there are
    fewer than a thousand of them in a table of any size.
    """
    ensure_checkpoint_dir(tasks.sparkSession)
    named = tasks.where(F.col("dag_id").isNotNull() & F.col("task_id").isNotNull())
    counts = named.groupBy("dag_id", "task_id").agg(F.count(F.lit(1)).alias("n")).checkpoint()
    bound = max(above, (counts.agg(F.sum("n")).first()[0] or 0) // MOST_HOT)
    return counts.where(F.col("n") > bound).select("dag_id", "task_id", F.ceil(F.col("n") / bound).cast("int").alias("_salts"))


def join_thresholds(
    tasks: DataFrame,
    thresholds: DataFrame,
    broadcast_rows: int = BROADCAST_ROWS,
    salts: int | None = None,
    how: str = "inner",
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Task runs with the threshold of their task; without one they drop out, or get NULL with ``how='left'``.

    ``thresholds`` has (dag_id, task_id, sla_threshold_seconds).  Of several rows for
    one task the strictest counts, so that no run is counted twice.  The reduced
    table, one row per task, is computed once and kept; it is counted, and up to
    ``broadcast_rows`` it is broadcast and the task runs stay where they are.

    Beyond it the join shuffles.  One task may own a third of all runs, so the runs per task are
    counted first.  Those of a hot task (see ``hot_tasks``) are spread by a hash of their
    times over as many parts as hold ``hot_rows`` each, or ``salts`` if given, and the
    thresholds of hot tasks, and no others, are repeated once per part.  The hash
    depends on the row alone, so a task that is run again reproduces it; and because
    the salt is part of the join key, adaptive execution may split a partition that
    is still too large.
    """
    spark, keys = tasks.sparkSession, ["dag_id", "task_id"]
    ensure_checkpoint_dir(spark)
    limits = (
        thresholds.groupBy(*keys)
        .agg(F.min("sla_threshold_seconds").alias("sla_threshold_seconds"))
        .checkpoint()
    )
    if limits.count() <= broadcast_rows:
        return tasks.join(F.broadcast(limits), keys, how)
    hot = hot_tasks(tasks, hot_rows).checkpoint()
    parts = F.lit(1)
    if not hot.isEmpty():
        marked = F.broadcast(hot)  # fewer than MOST_HOT rows
        tasks, limits = tasks.join(marked, keys, "left"), limits.join(marked, keys, "left")
        parts = F.when(F.col("_salts").isNull(), 1).otherwise(F.lit(salts) if salts else F.col("_salts"))
    run_hash = F.xxhash64("execution_date", "start_date", "end_date")
    salted = tasks.withColumn("_salt", F.pmod(run_hash, parts).cast("int")).drop("_salts")
    repeated = limits.select(*keys, "sla_threshold_seconds", F.explode(F.sequence(F.lit(0), parts - 1)).alias("_salt"))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest_by: str = "extracted_at") -> DataFrame:
    """Keep the newest copy of each key, e.g. where two load windows share a boundary.

    ``max_by`` combines before the shuffle, unlike a ``row_number`` filter, so
    many copies of one key do not meet in one task.
    """
    rest = [name for name in df.columns if name not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(newest_by, *rest)).alias("_row")
    picked = df.groupBy(*keys).agg(newest)
    return picked.select(
        *[F.col(name) if name in keys else F.col("_row")[name].alias(name) for name in df.columns]
    )
