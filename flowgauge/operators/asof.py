"""Thresholds that hold for a time: an as-of join as one sorted stream."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Seconds of time that one task's rows are sorted together for.
STRETCH_SECONDS = 86_400

_TASK = ("dag_id", "task_id")


def _stretch(moment: str, seconds: int) -> Column:
    """The number of the stretch of time that a moment lies in."""
    return F.floor(F.unix_micros(F.col(moment).cast("timestamp")) / (seconds * 1_000_000))


def join_thresholds_asof(
    tasks: DataFrame,
    thresholds: DataFrame,
    how: str = "inner",
    keys: Sequence[str] = _TASK,
    moment: str = "execution_date",
    stretch_seconds: int = STRETCH_SECONDS,
) -> DataFrame:
    """Task runs with the threshold that held for their task when they were scheduled.

    ``thresholds`` has the keys, ``valid_from``, ``valid_to`` and ``sla_threshold_seconds``.  For a run the
    threshold with the latest ``valid_from`` not after it counts, unless its ``valid_to``
    has been reached by then (null: it holds until the next one).  Of several from one moment
    on the strictest counts.  Runs without one drop out, or get null with ``how='left'``; so do runs
    without a name or a time, and thresholds without them are ignored.

    Both sides go into one stream, sorted by time, and the last threshold seen is carried
    on.  A task may own a third of all runs, so its stream is cut into stretches of
    time, each sorted by itself.  What holds when a stretch begins is carried there from one row
    per task and stretch: the last threshold of each, combined before the shuffle.  Runs meet no
    more thresholds than lie in their own stretch, and no pair is made that does not count.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    names = list(keys)
    stretch = _stretch(moment, stretch_seconds)
    named = F.lit(True)
    for name in [*names, moment]:
        named &= F.col(name).isNotNull()
    runs = tasks.where(named)

    # One threshold per task and moment; a struct orders by its first field.
    limit = F.struct("valid_from", "valid_to", "sla_threshold_seconds").alias("limit")
    strictest = F.min(F.struct("sla_threshold_seconds", "valid_to"))
    present = F.col("valid_from").isNotNull()
    for name in names:
        present &= F.col(name).isNotNull()
    levels = (
        thresholds.where(present)
        .groupBy(*names, "valid_from")
        .agg(strictest.alias("least"))
        .select(*names, "valid_from", "least.*")
        .select(*names, limit, _stretch("valid_from", stretch_seconds).alias("stretch"))
    )

    # What holds when a stretch begins: the last threshold of all earlier ones.
    seen = runs.select(*names, stretch.alias("stretch"), F.lit(None).cast(levels.schema["limit"].dataType).alias("limit"))
    last = levels.select(*names, "stretch", "limit").unionByName(seen).groupBy(*names, "stretch").agg(F.max("limit").alias("limit"))
    earlier = Window.partitionBy(*names).orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    carried = last.select(*names, "stretch", F.max("limit").over(earlier).alias("limit")).where("limit is not null")

    # The stream of a stretch: what holds at its begin, then thresholds and runs by time, thresholds first.
    row = F.struct(*[F.col(f"`{c}`") for c in tasks.columns])
    no_row = F.lit(None).cast(runs.select(row.alias("r")).schema[0].dataType)
    marks = levels.unionByName(carried.select(*names, "limit", "stretch")).select(
        *names, "stretch", F.col("limit.valid_from").alias("at"), F.lit(0).alias("side"), "limit", no_row.alias("row")
    )
    facts = runs.select(
        *names, stretch.alias("stretch"), F.col(moment).alias("at"), F.lit(1).alias("side"), F.lit(None).alias("limit"), row.alias("row")
    )
    so_far = Window.partitionBy(*names, "stretch").orderBy("at", "side").rowsBetween(Window.unboundedPreceding, 0)
    stream = marks.unionByName(facts).withColumn("limit", F.last("limit", ignorenulls=True).over(so_far))
    holds = F.col("limit.valid_to").isNull() | (F.col("at") < F.col("limit.valid_to"))
    level = F.when(holds, F.col("limit.sla_threshold_seconds")).alias("sla_threshold_seconds")
    joined = stream.where("side = 1").select("row.*", level)
    if how == "inner":
        return joined.where("sla_threshold_seconds is not null")
    return joined.unionByName(tasks.where(~named).withColumn("sla_threshold_seconds", F.lit(None).cast(joined.schema[-1].dataType)))
