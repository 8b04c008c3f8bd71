"""Merging a reloaded extract into a raw table, so that runs which ended late get their end."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.functions import is_in_progress, time_literal
from flowgauge.operators import latest_per_key
from flowgauge.schemas import LOAD_DATE, LOAD_ID
from flowgauge.session import ensure_checkpoint_dir
from flowgauge.sources.extract import extract_dag_runs, extract_task_instances
from flowgauge.sources.load import ensure_table, load_id
from flowgauge.sources.partitions import is_one_of, replace_partitions, stored_partitions
from flowgauge.sources.readers import Source

#: What a row of either raw table is known by.
RUN_KEY = ("dag_id", "execution_date")
TASK_KEY = ("dag_id", "task_id", "execution_date", "try_number")

_PLACE = (LOAD_DATE.name, LOAD_ID.name)


@dataclass(frozen=True)
class MergeResult:
    """What a merge did; ``changes`` are the rows that it took out (sign -1) and put in (sign +1)."""

    inserted: int
    updated: int
    unchanged: int
    partitions: tuple[tuple[str, ...], ...]
    changes: DataFrame


def open_since(stored: DataFrame) -> datetime | None:
    """When the oldest run that is still open was scheduled; none is: None.

    A run is open if it has no end and its state is one of those in progress, or unknown.
    """
    unended = F.col("end_date").isNull() & (is_in_progress(F.col("state")) | F.col("state").isNull())
    return stored.where(unended).agg(F.min("execution_date")).first()[0]


def _same(columns: Sequence[str], one: str, two: str) -> Column:
    return F.struct(*[F.col(f"{one}.{c}") for c in columns]).eqNullSafe(F.struct(*[F.col(f"{two}.{c}") for c in columns]))


def merge_load(
    df: DataFrame,
    table: str,
    keys: Sequence[str],
    load_date: date,
    name: str,
    newest_by: str = "extracted_at",
) -> MergeResult:
    """Bring the rows of an extract into a raw table, one row per key.

    A key that the table does not have is added under ``load_date`` and the load ``name``.  One that it
    has in another state is replaced where it lies; if overlapping windows left several
    copies, one stays, in the earliest of their partitions.  A row that differs in
    ``newest_by`` alone is not a change, and one that is older than what is stored changes
    nothing.  Null keys are equal to one another.  Of several rows of an extract for one
    key the newest counts.

    The stored keys are read between the earliest and the latest ``execution_date`` of the extract
    only, which Parquet's statistics answer for most files.  Of the table's partitions those
    that hold a changed key are read whole and written anew, and no others: see
    ``replace_partitions`` for what a reader or a retry meets.  A merge that is repeated finds nothing to change.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    payload = [c for c in df.columns if c not in keys and c != newest_by]
    ensure_table(spark, table, df.schema)
    stored = spark.table(table)

    # Both sides as structs: key, payload, time; and where the stored row lies.
    fresh = latest_per_key(df, list(keys), newest_by).checkpoint()
    bounds = fresh.agg(F.min("execution_date"), F.max("execution_date"), F.count_if(F.col("execution_date").isNull())).first()
    low, high = (None if b is None else time_literal(b, df.schema["execution_date"].dataType) for b in bounds[:2])
    near = F.lit(False) if low is None else F.col("execution_date").between(low, high)
    if bounds[2]:
        near |= F.col("execution_date").isNull()
    place = F.struct(*[F.col(c).cast("string").alias(c) for c in _PLACE])
    old = stored.where(near).select(F.struct(*keys).alias("key"), F.struct(*df.columns).alias("old"), place.alias("place"))
    new = fresh.select(F.struct(*keys).alias("key"), F.struct(*df.columns).alias("new"))
    met = new.join(old, "key", "left").withColumn(
        "verdict",
        F.when(F.col("old").isNull(), "inserted")
        .when(_same(payload, "old", "new") | (F.col(f"old.{newest_by}") > F.col(f"new.{newest_by}")), "unchanged")
        .otherwise("updated"),
    )
    # Copies of one key share a verdict: where one copy is out of date, all are replaced.
    own = F.struct(F.lit(str(load_date)).alias(_PLACE[0]), F.lit(name).alias(_PLACE[1]))
    decided = (
        met.groupBy("key")
        .agg(
            F.max_by("verdict", F.when(F.col("verdict") == "updated", 2).otherwise(1)).alias("verdict"),
            F.sort_array(F.collect_list("place")).alias("places"),
            F.collect_list("old").alias("copies"),
            F.first("new").alias("new"),
        )
        .withColumn("places", F.when(F.size("places") > 0, F.col("places")).otherwise(F.array(own)))
        .checkpoint()
    )
    # One row per load that holds a changed key, and its changed keys by their first place.
    counts, touched = Counter(), set()
    homes = F.when(F.col("verdict") == "unchanged", F.array(own)).otherwise(F.col("places"))
    spread = decided.select("verdict", F.posexplode(homes).alias("at", "place"))
    for row in spread.groupBy("verdict", "place").agg(F.count_if(F.col("at") == 0).alias("n")).collect():
        counts[row["verdict"]] += row["n"]
        if row["verdict"] != "unchanged":
            touched.add(tuple(row["place"]))
    changed = decided.where("verdict <> 'unchanged'")
    taken_out = changed.select(F.explode("copies").alias("old")).select("old.*", F.lit(-1).alias("sign"))
    changes = taken_out.unionByName(changed.select("new.*", F.lit(1).alias("sign")))
    if touched:
        there = touched & stored_partitions(spark, table, _PLACE)
        kept = (
            stored.where(is_one_of(_PLACE, there))
            .withColumn("key", F.struct(*keys))
            .join(changed.select("key"), "key", "left_anti")
            .select(*df.columns, *_PLACE)
        )
        home = F.col("places")[0]
        added = changed.select("new.*", home[_PLACE[0]].cast("date").alias(_PLACE[0]), home[_PLACE[1]].alias(_PLACE[1]))
        replace_partitions(kept.unionByName(added), table, touched, _PLACE)
    return MergeResult(counts["inserted"], counts["updated"], counts["unchanged"], tuple(sorted(touched)), changes)


def reload_start(spark: SparkSession, table: str, start: datetime | None) -> datetime | None:
    """From when on a window has to be read so that runs still open in ``table`` get their end.

    Not later than ``start``; a run that never ends keeps the window long, which costs a longer read
    of the source, but no writing.
    """
    if start is None or not spark.catalog.tableExists(table):
        return start
    oldest = open_since(spark.table(table))
    return start if oldest is None else min(start, oldest)


def extract_and_merge(
    spark: SparkSession,
    runs_source: Source,
    tasks_source: Source,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: datetime | None = None,
    database: str = "default",
) -> dict[str, MergeResult]:
    """Extract a window of both tables, from the oldest open run on, and merge it into them."""
    stamp = end or as_of or datetime.now(timezone.utc)
    found = {}
    for name, extract, source, keys in (
        ("dag_runs", extract_dag_runs, runs_source, RUN_KEY),
        ("task_instances", extract_task_instances, tasks_source, TASK_KEY),
    ):
        table = f"{database}.{name}"
        df = extract(spark, source, reload_start(spark, table, start), end, as_of)
        found[name] = merge_load(df, table, keys, stamp.date(), load_id(start, end))
    return found
