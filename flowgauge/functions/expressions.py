"""Column expressions.  All run inside whole-stage code generation."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.schemas import IN_PROGRESS_STATES, SlaThresholds


def seconds_between(start: Column, end: Column) -> Column:
    """Elapsed seconds with microseconds kept.

    The subtraction stays an interval, so zone-free timestamps are never turned
    into instants on the way (that would cost time, and depend on the session
    time zone).
    """
    return (end - start).cast("interval second").cast("decimal(18,6)").cast("double")


def run_duration(start: Column, end: Column) -> Column:
    """Duration of a run at extract time; NULL while either end is missing."""
    return F.when(start.isNotNull() & end.isNotNull(), seconds_between(start, end))


def calculated_duration(
    duration: str = "duration", start: str = "start_date", end: str = "end_date"
) -> Column:
    """The stored duration, or else end minus start."""
    return F.coalesce(F.col(duration), seconds_between(F.col(start), F.col(end)))


def has_duration(duration: str = "duration", start: str = "start_date", end: str = "end_date") -> Column:
    """True where ``calculated_duration`` is not NULL.

    Spelled over the stored columns, because Parquet and JDBC accept this form
    as a pushed filter, while a test of the ``coalesce`` reads every row.
    """
    return F.col(duration).isNotNull() | (F.col(start).isNotNull() & F.col(end).isNotNull())


def day_of(moment: Column) -> Column:
    """Midnight of the day, as a zone-free timestamp."""
    return moment.cast("date").cast("timestamp_ntz")


def sla_threshold(dag_id: Column, thresholds: SlaThresholds = SlaThresholds()) -> Column:
    """Allowed seconds by the name of the workflow; the strictest tier is tried first."""
    return (
        F.when(dag_id.like("%critical%"), F.lit(thresholds.critical))
        .when(dag_id.like("%daily%"), F.lit(thresholds.daily))
        .otherwise(F.lit(thresholds.default))
    )


def is_in_progress(state: Column) -> Column:
    return state.isin(*IN_PROGRESS_STATES)


def state_bucket(state: Column) -> Column:
    """Coarse outcome of a run."""
    return (
        F.when(state == "success", F.lit("success"))
        .when(state == "failed", F.lit("failed"))
        .when(is_in_progress(state), F.lit("in_progress"))
        .otherwise(F.lit("other"))
    )


def rate_percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent, rounded half up to two places; NULL over zero.

    Decimal throughout: binary floating point turns 23 of 160 into 14.37
    instead of 14.38.  With 18 digits the quotient keeps 17 decimals, enough to
    round correctly for any count below 10**15.
    """
    share = part.cast("decimal(18,0)") * 100 / F.nullif(whole.cast("decimal(18,0)"), F.lit(0))
    return F.round(share, 2).cast("decimal(7,2)")


def parse_timestamp(text: Column) -> Column:
    """Timestamp from text; NULL where the text is no timestamp."""
    return text.try_cast("timestamp_ntz")


def time_literal(moment: datetime, dtype: T.DataType) -> Column:
    """A literal of exactly the column's type, so that comparisons stay pushable."""
    if moment.tzinfo is not None:
        moment = moment.astimezone(timezone.utc).replace(tzinfo=None)
    text = moment.isoformat(sep=" ")
    if isinstance(dtype, T.TimestampType):
        return F.lit(text + "Z").cast("timestamp")
    return F.lit(text).cast("timestamp_ntz")


def age_hours(moment: Column, as_of: Column) -> Column:
    """Hours from ``moment`` to ``as_of``."""
    micros = (as_of - moment).cast("interval second").cast("decimal(18,6)") * 1_000_000
    return micros.cast("double") / F.lit(3.6e9)


def percent_text(fraction: Column) -> Column:
    """A fraction of 1 as percent text with two decimals."""
    return F.format_string("%.2f%%", fraction * 100)
