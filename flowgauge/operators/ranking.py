"""Ranks over a whole table, and the top of one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgauge.session import ensure_checkpoint_dir

_ROW_BITS = 33  # monotonically_increasing_id(): partition above bit 33, row number below


def global_row_number(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``row_number`` over the whole table without moving it into one task.

    ``Window.orderBy`` without keys pulls every row into one partition.  Instead
    the rows are range-partitioned on the order keys and sorted in place; a
    row's number is its place in the partition plus the rows of all earlier
    partitions.  The counts table has one row per partition, so broadcasting it
    is safe at any data size.

    The order must end in a unique key.  The sorted rows are checkpointed: both
    readers then see the same partitions, and a lost executor cannot change
    them.
    """
    ensure_checkpoint_dir(df.sparkSession)
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
        .checkpoint()
        .withColumn("_part", F.shiftright("_place", _ROW_BITS))
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    row_in_part = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return placed.join(F.broadcast(offsets), "_part").select(
        *df.columns, (F.col("_offset") + row_in_part + 1).cast("bigint").alias(name)
    )


def top_k(df: DataFrame, order: Sequence[Column], k: int, rank_name: str | None = None) -> DataFrame:
    """The first ``k`` rows in ``order``; each task keeps only its own best ``k``.

    With ``rank_name`` the rows also get their place, counted over these ``k``
    rows only.
    """
    best = df.orderBy(*order).limit(k)
    if rank_name is None:
        return best
    return best.withColumn(rank_name, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
