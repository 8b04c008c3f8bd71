"""Rules, and how a list of them becomes one aggregate over the table.

A rule names the columns it reads, the figures it measures (aggregates) and the
verdict drawn from them.  All measures of a table go into a single ``agg``: one
scan, combined inside each task, one row shuffled.  Only ``Unique`` needs a
shuffle by value of its own.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions import age_hours, parse_timestamp, percent_text, time_literal
from flowgauge.schemas import CHECK_RESULT, MAX_AGE_HOURS

log = logging.getLogger(__name__)

_NTZ = T.TimestampNTZType()


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.StringType)


@dataclass(frozen=True, kw_only=True)
class Rule:
    """Base of all rules; ``name`` overrides the generated check name."""

    kind = "rule"
    name: str | None = None
    note: str | None = None

    @property
    def reads(self) -> tuple[str, ...]:
        return ()

    @property
    def column_label(self) -> str | None:
        return ", ".join(self.reads) or None

    def check_name(self, table: str) -> str:
        return self.name or "_".join([self.kind, table, *self.reads])

    def measures(self, df: DataFrame) -> list[Column]:
        raise NotImplementedError

    def verdict(self, *measured: Column) -> dict[str, Column]:
        raise NotImplementedError


@dataclass(frozen=True, kw_only=True)
class RowCount(Rule):
    """At least ``min_rows`` rows."""

    kind = "row_count"
    min_rows: int = 0

    def measures(self, df):
        return [F.count(F.lit(1))]

    def verdict(self, rows):
        return {
            "passed": rows >= self.min_rows,
            "evaluated": rows,
            "observed": rows,
            "threshold": F.lit(self.min_rows),
            "message": F.format_string(f"%d rows, at least {self.min_rows} expected", rows),
        }


@dataclass(frozen=True, kw_only=True)
class TableExists(Rule):
    """The table is there.  It can only be put to a table that is, so it holds."""

    kind = "table_exists"

    def measures(self, df):
        return [F.count(F.lit(1))]

    def verdict(self, rows):
        return {"passed": F.lit(True), "message": F.lit("table is there")}


@dataclass(frozen=True, kw_only=True)
class NullShare(Rule):
    """At most ``max_share`` (0 to 1) of the rows are NULL; an empty table fails."""

    kind = "null_check"
    column: str
    max_share: float = 0.0

    @property
    def reads(self):
        return (self.column,)

    def measures(self, df):
        return [F.count(F.lit(1)), F.count_if(F.col(self.column).isNull())]

    def verdict(self, rows, nulls):
        share = F.coalesce(F.try_divide(nulls.cast("double"), rows.cast("double")), F.lit(0.0))
        words = F.format_string(
            "%s of rows are null, at most %s allowed",
            percent_text(share),
            percent_text(F.lit(float(self.max_share))),
        )
        return {
            "passed": (rows > 0) & (share <= self.max_share),
            "evaluated": rows,
            "failed": nulls,
            "observed": share,
            "threshold": F.lit(float(self.max_share)),
            "message": F.when(rows == 0, F.lit("table is empty")).otherwise(words),
        }


@dataclass(frozen=True, kw_only=True)
class FreshWithin(Rule):
    """The newest timestamp is at most ``max_age_hours`` old at ``as_of``.

    Text columns are accepted; their largest value is parsed.
    """

    kind = "freshness_check"
    as_of: datetime
    column: str = "extracted_at"
    max_age_hours: float = MAX_AGE_HOURS

    @property
    def reads(self):
        return (self.column,)

    def measures(self, df):
        newest = F.max(self.column)
        dtype = df.schema[self.column].dataType
        is_text = _is_text(df, self.column)
        moment = parse_timestamp(newest) if is_text else newest
        as_of = time_literal(self.as_of, _NTZ if is_text else dtype)
        return [F.count(F.lit(1)), F.count(self.column), age_hours(moment, as_of)]

    def verdict(self, rows, stamped, age):
        limit = f"{self.max_age_hours:g}"
        fresh = F.format_string(f"newest row is %.2f hours old, at most {limit} allowed", age)
        return {
            "passed": F.coalesce(age <= self.max_age_hours, F.lit(False)),
            "evaluated": stamped,
            "observed": age,
            "threshold": F.lit(float(self.max_age_hours)),
            "error": F.when((stamped > 0) & age.isNull(), F.lit("newest value is no timestamp")),
            "message": F.when(stamped == 0, F.lit("no timestamp found"))
            .when(age.isNull(), F.lit("newest value is no timestamp"))
            .otherwise(fresh),
        }


@dataclass(frozen=True, kw_only=True)
class ValueRule(Rule):
    """A condition on single rows that at least the share ``mostly`` must meet.

    Rows where the condition cannot be judged (a NULL) are not evaluated, and
    with nothing to evaluate the rule holds.
    """

    column: str
    mostly: float = 1.0

    @property
    def reads(self):
        return (self.column,)

    def judged(self, df: DataFrame) -> Column:
        return F.col(self.column).isNotNull()

    def broken(self, df: DataFrame) -> Column:
        raise NotImplementedError

    def measures(self, df):
        judged = self.judged(df)
        return [F.count_if(judged), F.count_if(judged & self.broken(df))]

    def verdict(self, judged, broken):
        share = F.try_divide((judged - broken).cast("double"), judged.cast("double"))
        return {
            "passed": F.coalesce(share >= self.mostly, F.lit(True)),
            "evaluated": judged,
            "failed": broken,
            "observed": F.coalesce(share, F.lit(1.0)),
            "threshold": F.lit(float(self.mostly)),
            "message": F.format_string("%d of %d values break the rule", broken, judged),
        }


@dataclass(frozen=True, kw_only=True)
class NotNull(ValueRule):
    kind = "not_null"

    def judged(self, df):
        return F.lit(True)

    def broken(self, df):
        return F.col(self.column).isNull()


@dataclass(frozen=True, kw_only=True)
class InSet(ValueRule):
    kind = "in_set"
    values: tuple[str, ...]

    def broken(self, df):
        return ~F.col(self.column).cast("string").isin(*self.values)


@dataclass(frozen=True, kw_only=True)
class Between(ValueRule):
    """Inclusive bounds; leave one out for an open side.  Text that is no number breaks the rule."""

    kind = "between"
    min_value: float | None = None
    max_value: float | None = None

    def broken(self, df):
        is_text = _is_text(df, self.column)
        number = F.col(self.column).try_cast("double") if is_text else F.col(self.column)
        outside = number.isNull()
        if self.min_value is not None:
            outside |= number < self.min_value
        if self.max_value is not None:
            outside |= number > self.max_value
        return outside


@dataclass(frozen=True, kw_only=True)
class PairOrder(ValueRule):
    """``column`` is greater than ``other``, or equal with ``or_equal``.

    Text is read as timestamps; text that is none breaks the rule.
    """

    kind = "pair_order"
    other: str
    or_equal: bool = True

    @property
    def reads(self):
        return (self.column, self.other)

    def judged(self, df):
        return F.col(self.column).isNotNull() & F.col(self.other).isNotNull()

    def broken(self, df):
        a, b = (
            parse_timestamp(F.col(name)) if _is_text(df, name) else F.col(name)
            for name in self.reads
        )
        kept = a >= b if self.or_equal else a > b
        return ~F.coalesce(kept, F.lit(False))


@dataclass(frozen=True, kw_only=True)
class Unique(Rule):
    """No value twice; NULLs are ignored.  ``failed`` counts the repeated values."""

    kind = "unique"
    column: str

    @property
    def reads(self):
        return (self.column,)

    def tallied(self, df: DataFrame) -> DataFrame:
        """One row per value.  Equal values combine before the shuffle, so none can be too hot."""
        per_value = df.where(F.col(self.column).isNotNull()).groupBy(self.column)
        return per_value.agg(F.count(F.lit(1)).alias("_copies"))

    def measures(self, df):
        return [F.coalesce(F.sum("_copies"), F.lit(0)), F.count_if(F.col("_copies") > 1)]

    def verdict(self, rows, repeated):
        return {
            "passed": repeated == 0,
            "evaluated": rows,
            "failed": repeated,
            "observed": repeated,
            "threshold": F.lit(0.0),
            "message": F.format_string("%d values occur more than once", repeated),
        }


def result_row(rule: Rule, suite: str, table: str, fields: dict[str, Column]) -> Column:
    """A row of ``schemas.CHECK_RESULT`` as a struct."""
    fields = {
        "suite": F.lit(suite),
        "check_name": F.lit(rule.check_name(table)),
        "check_type": F.lit(rule.kind),
        "table_name": F.lit(table),
        "column_name": F.lit(rule.column_label),
        "evaluated": F.lit(0),
        "failed": F.lit(0),
        **fields,
    }
    return F.struct(
        *[
            fields.get(field.name, F.lit(None)).cast(field.dataType).alias(field.name)
            for field in CHECK_RESULT
        ]
    )


def _failure(text: str) -> dict[str, Column]:
    return {"passed": F.lit(False), "error": F.lit(text), "message": F.lit(text)}


def failed_result(df: DataFrame, rule: Rule, suite: str, table: str, text: str) -> DataFrame:
    """One failed row for a rule that cannot be evaluated."""
    one = df.sparkSession.range(1)
    return one.select(F.inline(F.array(result_row(rule, suite, table, _failure(text)))))


def run_rules(df: DataFrame, rules: Sequence[Rule], suite: str, table: str) -> DataFrame:
    """Result rows (``schemas.CHECK_RESULT``) of all rules, lazily.

    A rule that does not fit the table (a column is missing or of the wrong type)
    becomes a failed row with an error; the others run as usual.
    """
    return run_rule_sets(df, {suite: rules}, table)


def run_rule_sets(df: DataFrame, rule_sets: Mapping[str, Sequence[Rule]], table: str) -> DataFrame:
    """``run_rules`` for several suites on one table, still in a single scan."""

    def fits(rules: Sequence[Rule]) -> str | None:
        """Why the rules cannot be put to this table; found by analysis, nothing runs."""
        absent = [name for rule in rules for name in rule.reads if name not in df.columns]
        if absent:
            return f"column not found: {', '.join(absent)}"
        try:
            df.agg(*[m for rule in rules for m in rule.measures(df)]).schema
        except AnalysisException as problem:
            return str(problem).splitlines()[0]
        return None

    def misfit(rule: Rule) -> str | None:
        if not isinstance(rule, Unique):
            return fits([rule])
        absent = [name for name in rule.reads if name not in df.columns]
        return f"column not found: {', '.join(absent)}" if absent else None

    def compiled(source: DataFrame, chosen: Sequence[tuple[str, Rule]]) -> DataFrame:
        figures: list[Column] = []
        rows: list[Column] = []
        for number, (suite, rule) in enumerate(chosen):
            if rule in misfits:
                rows.append(result_row(rule, suite, table, _failure(misfits[rule])))
                continue
            measured = rule.measures(source)
            names = [f"m{number}_{part}" for part in range(len(measured))]
            figures += [column.alias(name) for column, name in zip(measured, names)]
            rows.append(result_row(rule, suite, table, rule.verdict(*map(F.col, names))))
        if not figures:
            return df.sparkSession.range(1).select(F.inline(F.array(*rows)))
        return source.agg(*figures).select(F.inline(F.array(*rows)))

    labelled = [(suite, rule) for suite, rules in rule_sets.items() for rule in rules]
    # Analysis costs more than the rest of planning: all rules together, one by one only if that fails.
    plain = [rule for _, rule in labelled if not isinstance(rule, Unique)]
    suspects = [rule for _, rule in labelled if isinstance(rule, Unique)] + (plain if plain and fits(plain) else [])
    misfits = {rule: why for rule in suspects if (why := misfit(rule))}
    lone = [pair for pair in labelled if isinstance(pair[1], Unique) and pair[1] not in misfits]
    shared = [pair for pair in labelled if pair not in lone]
    parts = [compiled(df, shared)] if shared else []
    parts += [compiled(rule.tallied(df), [(suite, rule)]) for suite, rule in lone]
    return reduce(DataFrame.unionByName, parts)


def settled(df: DataFrame, rule_sets: Mapping[str, Sequence[Rule]], table: str) -> DataFrame:
    """``run_rule_sets``, run now, with errors kept to the rule that meets them.

    All rules run in one scan.  If that breaks off (a value cannot be computed, say),
    each rule runs by itself, and those that fail become failed rows with the
    error.  The rows, one per rule, come back through the driver.
    """
    spark = df.sparkSession
    try:
        rows = run_rule_sets(df, rule_sets, table).collect()
    except Exception as problem:  # noqa: BLE001 - any error of a rule is a result here
        log.warning("checks of %s run one by one: %s", table, _first_line(problem))
        rows = []
        for suite, rules in rule_sets.items():
            for rule in rules:
                try:
                    rows += run_rule_sets(df, {suite: [rule]}, table).collect()
                except Exception as problem:  # noqa: BLE001
                    rows += failed_result(df, rule, suite, table, _first_line(problem)).collect()
    return spark.createDataFrame(rows, CHECK_RESULT)


def _first_line(problem: Exception) -> str:
    condition = getattr(problem, "getCondition", lambda: None)()
    return condition or (str(problem).splitlines() or [type(problem).__name__])[0]
