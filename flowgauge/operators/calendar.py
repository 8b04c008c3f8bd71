"""Rolling means over days of the calendar, beside those over rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def calendar_spine(daily: DataFrame, key: str = "dag_id", day: str = "execution_day") -> DataFrame:
    """A row for every day from a group's first to its last: its own rows, and rows of nulls between them.

    ``daily`` has one row per group and day.  Groups and rows without a day are left as they are.
    The rows of a gap follow from the two days around it, so nothing is joined; the window
    holds a group's days, as many as the calendar has, not the runs behind them.
    """
    rest = [c for c in daily.columns if c not in (key, day)]
    following = F.lead(day).over(Window.partitionBy(key).orderBy(F.col(day).asc_nulls_first()))
    one_day = F.expr("INTERVAL '1' DAY")
    last = F.when(F.col(day).isNotNull(), F.coalesce(F.col("_next") - one_day, F.col(day)))
    days = F.coalesce(F.sequence(F.col(day), last, one_day), F.array(F.col(day)))
    filled = daily.withColumn("_next", following).withColumn("_day", F.explode(days))
    own = F.col("_day").eqNullSafe(F.col(day))
    columns = {c: F.when(own, F.col(c)) for c in rest} | {day: F.col("_day"), "_own": own}
    return filled.withColumns(columns).select(*daily.columns, F.col("_own").alias("has_rows"))


def calendar_means(
    daily: DataFrame, value: str, frames: Mapping[str, int], key: str = "dag_id", day: str = "execution_day"
) -> DataFrame:
    """The spine of ``daily`` with means of ``value`` over the last days of the calendar.

    ``frames`` maps a column name to its number of days, the day itself included.  A
    frame reaches back over time, not over rows: days without rows shorten what is
    averaged, and a frame without any value gives null.  An exact decimal sum is
    divided once.  Rows without a day are a frame of their own.
    """
    if any(days < 1 for days in frames.values()):
        raise ValueError("a frame has one day at least")

    def over(days: int) -> str:
        back = f"INTERVAL '{days - 1}' DAY PRECEDING" if days > 1 else "CURRENT ROW"
        return f"OVER (PARTITION BY `{key}` ORDER BY `{day}` RANGE BETWEEN {back} AND CURRENT ROW)"

    means = {
        name: F.expr(f"double(sum(`{value}`) {over(days)}) / nullif(count(`{value}`) {over(days)}, 0)")
        for name, days in frames.items()
    }
    return calendar_spine(daily, key, day).withColumns(means)
