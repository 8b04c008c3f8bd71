"""Rolling means over ordered rows of one group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def rolling_mean(value: str, rows: int, key: str = "dag_id", order: str = "execution_day") -> Column:
    """Mean of the current and the ``rows - 1`` preceding rows of the group.

    The frame counts rows, not days: a day without runs does not shorten it.
    Use it on daily aggregates, where a group has one row per day and is
    therefore small however many runs lie behind it.  An exact decimal sum is
    divided once, so the order of summation cannot show.
    """
    frame = Window.partitionBy(key).orderBy(order).rowsBetween(1 - rows, 0)
    return F.sum(value).over(frame).cast("double") / F.count(value).over(frame)
