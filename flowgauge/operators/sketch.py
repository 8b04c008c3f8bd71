"""Approximate percentiles from quantile sketches that are stored, merged and asked later.

A sketch (KLL) is a binary column: some kilobytes, whatever the number of values behind it.  Sketches of
days merge into one of a month without the days' rows.  What they answer is a value that occurs, whose
rank is off by a share of the rows that depends on the size of the sketch alone: see ``rank_error``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Size parameter of a sketch; a larger one is more exact.
SIZE = 800
SKETCH, ROWS = "sketch", "sketched_rows"


def rank_error(size: int = SIZE) -> float:
    """By how much a rank may be off, as a share of the rows, in 99 of 100 answers.

    Fixed values: the published error of KLL sketches, 2.296 / size ** 0.9021 for one answer.
    """
    return 2.296 / size**0.9021


def sketches(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    size: int = SIZE,
    totals: Mapping[str, Column] | None = None,
) -> DataFrame:
    """(keys, sketch, sketched_rows, totals): one sketch per group over its values; null and NaN count as none.

    A group without values has a null sketch and 0 rows.  Partial sketches are
    merged before and after the shuffle, so a hot group sends one of them per task.
    """
    column = (F.col(value) if isinstance(value, str) else value).cast("double")
    known = F.when(~F.isnan(column), column)
    n = F.count(known)
    return df.groupBy(*keys).agg(
        F.when(n > 0, F.kll_sketch_agg_double(known, F.lit(size))).alias(SKETCH),
        n.alias(ROWS),
        *[total.alias(name) for name, total in (totals or {}).items()],
    )


def merge_sketches(stored: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """Stored sketches of finer groups as one per group of ``keys``."""
    n = F.sum(ROWS)
    merged = stored.groupBy(*keys).agg(F.kll_merge_agg_double(SKETCH, F.lit(size)).alias(SKETCH), n.alias(ROWS))
    return merged.withColumn(SKETCH, F.when(F.col(ROWS) > 0, F.col(SKETCH)))


def quantiles_of(stored: DataFrame, quantiles: Mapping[str, float]) -> DataFrame:
    """The columns of ``stored`` without its sketch, and a column for each quantile; null without values."""
    rest = [c for c in stored.columns if c != SKETCH]
    found = [F.kll_sketch_get_quantile_double(SKETCH, F.lit(float(q))).alias(name) for name, q in quantiles.items()]
    return stored.select(*rest, *found)


def sketched_percentiles(
    df: DataFrame, keys: Sequence[str], value: str | Column, quantiles: Mapping[str, float], size: int = SIZE
) -> DataFrame:
    """One row per group: the keys and its approximate ``quantiles``, from one sketch."""
    return quantiles_of(sketches(df, keys, value, size), quantiles).drop(ROWS)
