"""Exact interpolated percentiles that no single hot group can break.

Spark's ``percentile`` keeps every distinct value of a group in one buffer, so
a workflow with a third of all rows would land in one task's memory.  Here a
group is spread over many tasks instead:

1. ``value_counts``: one row per (group, value) with its number of rows.  Equal
   values are combined before the shuffle and a group is hashed by value, so
   neither a hot group nor a hot value meets in one task.
2. Values fall into fixed buckets by magnitude, 0.0085 % wide.  A group has a
   bounded number of buckets, so a running count over them tells which bucket
   holds each wanted position.
3. Running counts inside the wanted buckets find the values themselves.

What one task may have to sort is bounded by the data model, not by the rows.
Durations are microseconds, so a day of range has some 300,000 buckets (step 2),
and the widest bucket below one day spans 7.3 seconds, that is at most 7.3
million distinct values (step 3), even if a third of all rows fall into it.

The buckets depend on the value alone.  Nothing is sampled, so a task that runs
again after a lost executor gives the same rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.sketch import ROWS, quantiles_of, sketches

BUCKETS_PER_DOUBLING = 8192
_LARGEST_EXPONENT = 1100  # beyond the exponent of any double, on either side of 1

GROUP, BUCKET, VALUE, WEIGHT = "_group", "_bucket", "value", "weight"
_AGGREGATES = ("sum", "min", "max")


def magnitude_bucket(column: str) -> Column:
    """A bucket number that never falls as the value grows; NaN counts as largest.

    NULL gets a bucket too.  A bucket that is never NULL keeps joins on it from
    adding a filter to one branch of the plan, and identical branches share
    their scan and shuffle.
    """
    zero_at = _LARGEST_EXPONENT * BUCKETS_PER_DOUBLING + 1

    def steps(positive: str) -> str:
        bounded = f"least(log2({positive}), {_LARGEST_EXPONENT}D)"
        return f"(floor({bounded} * {BUCKETS_PER_DOUBLING}) + {zero_at})"

    v = f"double({column})"
    return F.expr(
        f"""coalesce(CASE WHEN isnan({v}) THEN {3 * zero_at}L
                          WHEN {v} > 0 THEN {steps(v)}
                          WHEN {v} < 0 THEN -{steps('-' + v)} END, 0L)"""
    )


def value_counts(
    df: DataFrame, keys: Sequence[str], value: str | Column, facets: Sequence[str] = ()
) -> DataFrame:
    """Rows per (group, value, facets): columns ``_group _bucket value <facets> weight``.

    The keys travel as one struct.  Structs compare equal field by field, NULL
    included, so groups with a NULL key survive the join below.
    """
    measured = F.col(value) if isinstance(value, str) else value
    rows = df.select(F.struct(*keys).alias(GROUP), measured.alias(VALUE), *facets)
    return (
        rows.withColumn(BUCKET, magnitude_bucket(VALUE))
        .groupBy(GROUP, BUCKET, VALUE, *facets)
        .agg(F.count(F.lit(1)).alias(WEIGHT))
    )


def grouped_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str | Column,
    quantiles: Mapping[str, float],
    totals: Mapping[str, tuple[str, str]] | None = None,
    facets: Sequence[str] = (),
    exact: bool = True,
) -> DataFrame:
    """One row per group: the keys, ``totals`` and the exact ``quantiles`` as doubles.

    ``totals`` maps a name to ``(aggregate, expression)``: a sum, min or max over
    ``value``, ``weight`` (the rows with that value) and the ``facets``.  They
    come from the bucket sums that are needed anyway, so one scan and one large
    shuffle serve everything.  NULL values take no part in the percentiles; a
    group of NULLs only gets NULL.

    ``exact=False`` answers from one quantile sketch per group instead, with values that occur and whose
    ranks may be off by ``sketch.rank_error``; rows are not shuffled then.  Totals stay exact.
    """
    if not exact:
        measured = F.col(value) if isinstance(value, str) else value
        rows = df.select(*keys, measured.alias(VALUE), *facets, F.lit(1).alias(WEIGHT))
        wanted = {name: F.expr(f"{kind}({part})") for name, (kind, part) in dict(totals or {}).items()}
        return quantiles_of(sketches(rows, keys, VALUE, totals=wanted), quantiles).drop(ROWS)
    return percentiles_of_counts(value_counts(df, keys, value, facets), keys, quantiles, totals)


def counts_by_group(
    df: DataFrame, keys: Sequence[str], value: str, weight: str, facets: Sequence[str] = ()
) -> DataFrame:
    """Stored counts (keys, value, facets, weight) in the form that ``value_counts`` has."""
    rows = df.select(F.struct(*keys).alias(GROUP), F.col(value).alias(VALUE), *facets, F.col(weight).alias(WEIGHT))
    return rows.withColumn(BUCKET, magnitude_bucket(VALUE))


def percentiles_of_counts(
    counts: DataFrame,
    keys: Sequence[str],
    quantiles: Mapping[str, float],
    totals: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """``grouped_percentiles`` of rows that are counted already."""
    totals = dict(totals or {})
    if any(kind not in _AGGREGATES for kind, _ in totals.values()):
        raise ValueError(f"totals must be one of {', '.join(_AGGREGATES)}")
    facts = ["_total", *totals]  # the same in every row of a group
    counted = "if(value IS NULL, 0, weight)"
    position = {name: f"({float(q)!r}D * (_total - 1))" for name, q in quantiles.items()}

    # Which buckets hold the wanted positions (positions count from 0).
    ordered = "OVER (PARTITION BY _group ORDER BY _bucket ROWS BETWEEN UNBOUNDED PRECEDING AND"
    holds_any = " OR ".join(
        f"{edge}({place}) BETWEEN _before AND _before + _size - 1"
        for place in position.values()
        for edge in ("floor", "ceil")
    )
    targets = (
        counts.groupBy(GROUP, BUCKET)
        .agg(
            F.expr(f"sum({counted})").alias("_size"),
            *[F.expr(f"{kind}({part})").alias(name) for name, (kind, part) in totals.items()],
        )
        .selectExpr(
            GROUP,
            BUCKET,
            "_size",
            f"sum(_size) {ordered} CURRENT ROW) - _size AS _before",
            f"sum(_size) {ordered} UNBOUNDED FOLLOWING) AS _total",
            *[
                f"{kind}({name}) {ordered} UNBOUNDED FOLLOWING) AS {name}"
                for name, (kind, _) in totals.items()
            ],
        )
        .where(f"_total = 0 OR {holds_any}")
        .select(GROUP, BUCKET, "_before", *facts)
    )

    # Running counts inside those buckets, then the values at the positions.
    placed = counts.join(targets, [GROUP, BUCKET]).selectExpr(
        GROUP,
        VALUE,
        *facts,
        f"{counted} AS _weight",
        f"""_before + sum({counted}) OVER (PARTITION BY _group, _bucket ORDER BY value
            ROWS UNBOUNDED PRECEDING) AS _end""",
    )

    def value_at(place: str) -> Column:
        return F.expr(f"max(if({place} BETWEEN _end - _weight AND _end - 1, double(value), NULL))")

    picks = [F.max(fact).alias(fact) for fact in facts]
    for name, place in position.items():
        picks.append(value_at(f"floor({place})").alias(f"_low_{name}"))
        picks.append(value_at(f"ceil({place})").alias(f"_high_{name}"))
    interpolated = [
        f"""CASE WHEN _low_{name} = _high_{name} THEN _low_{name}
            ELSE _low_{name} + (_high_{name} - _low_{name}) * ({place} - floor({place})) END AS {name}"""
        for name, place in position.items()
    ]
    named_keys = [F.col(GROUP)[key].alias(key) for key in keys]
    return (
        placed.groupBy(GROUP)
        .agg(*picks)
        .select(*named_keys, *totals, *map(F.expr, interpolated))
    )
