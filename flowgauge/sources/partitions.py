"""Replacing some partitions of a catalog table, each as a whole."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A partition: the values of the partition columns, in their order, as text.
Partition = tuple[str, ...]


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def _quoted(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _spec(columns: Sequence[str], partition: Partition) -> str:
    return ", ".join(f"`{c}` = {_quoted(v)}" for c, v in zip(columns, partition, strict=True))


def is_one_of(columns: Sequence[str], partitions: Iterable[Partition]) -> Column:
    """A condition on partition columns alone, which the scan answers from the list of partitions."""
    found = sorted(set(partitions))
    if not found:
        return F.lit(False)
    if len(columns) == 1:
        return F.col(f"`{columns[0]}`").cast("string").isin([p[0] for p in found])
    key = F.concat_ws("\x1f", *[F.col(f"`{c}`").cast("string") for c in columns])
    return key.isin(["\x1f".join(p) for p in found])


def stored_partitions(spark: SparkSession, table: str, columns: Sequence[str] | None = None) -> set[Partition]:
    """The partitions that a table has, from the catalog; ``columns``, where known, save a look at the table."""
    columns, found = columns or partition_columns(spark, table), set()
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    for row in spark.sql(f"SHOW PARTITIONS {table}").collect():
        values = dict(part.split("=", 1) for part in row[0].split("/"))
        found.add(tuple(unescape(values[c]) for c in columns))
    return found


def _location(spark: SparkSession, table: str) -> str:
    rows = spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"]


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _partition_location(spark: SparkSession, table: str, spec: str) -> str | None:
    rows = spark.sql(f"DESCRIBE FORMATTED {table} PARTITION ({spec})").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def replace_partitions(
    df: DataFrame, table: str, partitions: Iterable[Partition], columns: Sequence[str] | None = None
) -> None:
    """Put the rows of ``df`` in the place of ``partitions`` of ``table``, and touch no other one.

    ``df`` has the table's columns; its rows lie in ``partitions``.  All rows are written to a
    new folder of the table first; then the catalog is pointed, partition by partition, from
    the old folder to the new one, and a partition without rows is dropped.  So a reader
    sees a partition as it was or as it is, never in part; a job that breaks off leaves each
    partition whole, and may be run again.  ``df`` may read the table itself: the old files
    go last.  ``columns`` are the partition columns, where known.
    """
    spark, found = df.sparkSession, sorted(set(partitions))
    if not found:
        return
    columns = columns or partition_columns(spark, table)
    folder = f"{_location(spark, table)}/_replaced-{uuid.uuid4().hex}"
    order = spark.table(table).columns
    # Files of a fitting size, one task for each unless a partition is large.
    sized = df.select(*[F.col(f"`{c}`") for c in order]).hint("rebalance", *[F.col(f"`{c}`") for c in columns])
    sized.write.partitionBy(*columns).parquet(folder)
    escape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    present, old = stored_partitions(spark, table, columns), []
    for partition in found:
        spec = _spec(columns, partition)
        new = f"{folder}/" + "/".join(f"{c}={escape(v)}" for c, v in zip(columns, partition))
        files, place = _files(spark, new)
        if partition in present:
            old.append(_partition_location(spark, table, spec))
        if files.exists(place):
            kind = "SET LOCATION" if partition in present else "LOCATION"
            add = "" if partition in present else "ADD IF NOT EXISTS "
            spark.sql(f"ALTER TABLE {table} {add}PARTITION ({spec}) {kind} {_quoted(new)}")
        elif partition in present:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION ({spec})")
    spark.catalog.refreshTable(table)
    for path in filter(None, old):
        files, place = _files(spark, path)
        files.delete(place, True)
