"""Loading extracts into target tables, safely repeatable."""

from __future__ import annotations

import logging
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.schemas import LOAD_DATE, LOAD_ID, TABLE_COMMENTS
from flowgauge.sources.extract import extract_dag_runs, extract_task_instances
from flowgauge.sources.readers import JdbcSource, Source, write_jdbc

log = logging.getLogger(__name__)

WRITE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}
WINDOW = timedelta(days=1)


def load_window(logical_time: datetime) -> tuple[datetime, datetime]:
    """The day that ends at the logical time of a run."""
    return logical_time - WINDOW, logical_time


def load_id(start: datetime | None, end: datetime | None) -> str:
    """The name of a window: its whole bounds, so that no two windows share one."""
    return "_".join("open" if t is None else t.strftime("%Y%m%dT%H%M%S.%f") for t in (start, end))


def _describe(spark: SparkSession, table: str) -> None:
    description = TABLE_COMMENTS.get(table.split(".")[-1])
    if description:
        spark.sql(f"COMMENT ON TABLE {table} IS '{description}'")


def ensure_table(spark: SparkSession, table: str, schema: T.StructType) -> bool:
    """Create the table from its fixed schema if it is absent, split by load date and load.

    Trouble is only warned about: the load that follows reports real errors.
    """
    try:
        with_load = T.StructType([*schema.fields, LOAD_DATE, LOAD_ID])
        empty = spark.createDataFrame([], with_load)
        empty.write.mode("ignore").partitionBy(LOAD_DATE.name, LOAD_ID.name).saveAsTable(table)
        _describe(spark, table)
        return True
    except Exception as problem:  # noqa: BLE001 - see above
        log.warning("could not create table %s: %s", table, problem)
        return False


def load(
    df: DataFrame,
    target: str | JdbcSource,
    if_exists: str = "append",
    load_date: date | None = None,
    even_out: bool = False,
    load_id: str = "append",
) -> int:
    """Write an extract to a table and return the number of rows written.

    ``append``, ``replace`` and ``fail`` behave as usual for an existing table;
    ``replace`` and ``fail`` skip an empty extract, as does the first load into a table, which they find
    out from its first row before they write.  ``refresh`` overwrites the partition of ``load_date``
    (today if not given) and ``load_id`` and no other.  So a load that is repeated
    leaves one copy, an empty repeat leaves none, and loads of different windows
    never touch one another.  Nothing to load is warned about.

    A ``target`` in a database is written in batches.  It has no partitions to
    refresh, and a task that is run again after its commit repeats its rows
    there; tables of the catalog have neither limit.

    ``even_out`` shuffles the rows into well-sized files first.  A window leaves
    only a few rows in each split of a large source, and every later scan would
    pay for the small files; a full copy has full splits and does without.

    Rows are counted in the writing tasks, so ``append`` and ``refresh`` run the
    extract once.
    """
    spark = df.sparkSession
    if if_exists != "refresh" and if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be refresh or one of {', '.join(WRITE_MODES)}")
    if if_exists == "refresh" and isinstance(target, JdbcSource):
        raise ValueError("a database table cannot be refreshed by load")
    added = if_exists in ("append", "refresh")
    if not (added and (isinstance(target, JdbcSource) or spark.catalog.tableExists(target))) and df.isEmpty():
        log.warning("nothing to load into %s", target)
        return 0
    day = load_date or datetime.now(timezone.utc).date()
    counter = Observation()
    sized = df.hint("rebalance") if even_out else df
    counted = sized.observe(counter, F.count(F.lit(1)).alias("rows"))
    if isinstance(target, JdbcSource):
        write_jdbc(counted, target, WRITE_MODES[if_exists])
    elif if_exists == "refresh":
        ensure_table(spark, target, df.schema)
        partition = (LOAD_DATE.name, LOAD_ID.name)
        columns = [name for name in spark.table(target).columns if name not in partition]
        spark.sql(
            f"INSERT OVERWRITE TABLE {target} "
            f"PARTITION ({LOAD_DATE.name} = DATE'{day}', {LOAD_ID.name} = '{load_id}') "
            "SELECT * FROM {extract}",
            extract=counted.select(*columns),
        )
    else:
        if if_exists == "append":
            ensure_table(spark, target, df.schema)
        marked = counted.withColumns({LOAD_DATE.name: F.lit(day), LOAD_ID.name: F.lit(load_id)})
        writer = marked.write.mode(WRITE_MODES[if_exists])
        writer.partitionBy(LOAD_DATE.name, LOAD_ID.name).saveAsTable(target)
        _describe(spark, target)
    rows = counter.get["rows"]
    if not rows:
        log.warning("nothing to load into %s", target)
    return rows


def extract_and_load(
    spark: SparkSession,
    runs_source: Source,
    tasks_source: Source,
    start: datetime | None = None,
    end: datetime | None = None,
    as_of: datetime | None = None,
    database: str = "default",
    if_exists: str = "refresh",
) -> dict[str, int]:
    """Extract and load both tables; returns the row counts.

    A load is known by its window, and is stored under the day the window ends,
    whenever it really runs.  A load that is tried again therefore replaces what
    its first try wrote, even if that broke off between the two tables, and any
    number of windows may end on one day.  Windows that overlap repeat the rows
    they share (as do plain appends); ``operators.latest_per_key`` drops such copies.

    ``if_exists="merge"`` keeps one row per run instead (see ``sources.merge``): the window is read from
    the oldest run on that is still open in the table, so that runs which end after their
    window was loaded get their end, and the counts are of rows added or replaced.
    """
    if if_exists == "merge":
        from flowgauge.sources.merge import extract_and_merge

        merged = extract_and_merge(spark, runs_source, tasks_source, start, end, as_of, database)
        return {f"{name}_count": found.inserted + found.updated for name, found in merged.items()}
    windowed = start is not None or end is not None
    stamp = end or as_of
    load_date = stamp.date() if stamp else None
    extracts = {
        "dag_runs": extract_dag_runs(spark, runs_source, start, end, as_of),
        "task_instances": extract_task_instances(spark, tasks_source, start, end, as_of),
    }
    return {
        f"{name}_count": load(
            df, f"{database}.{name}", if_exists, load_date, even_out=windowed, load_id=load_id(start, end)
        )
        for name, df in extracts.items()
    }
