"""Row counts, NULL shares and freshness from the footers of Parquet files.

Counts come from the footers alone: the aggregate is pushed into the scan, which reads no
column.  The newest moment is not taken from a footer, whose numbers do not tell their
unit to a reader of numbers; the greatest number there is a lower bound, and only row
groups that reach it are read.  Where statistics are absent, the usual scan answers.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.functions import age_hours, time_literal
from flowgauge.quality.rules import FreshWithin, NullShare, RowCount, Rule, TableExists, result_row, run_rules

log = logging.getLogger(__name__)

_TIMES = (T.TimestampType, T.TimestampNTZType)


def _quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def footer_aggregate(df: DataFrame, path: str, counted: Sequence[str], bounded: Sequence[str]) -> DataFrame:
    """One row: ``rows``, then the values of each ``counted`` column, then the greatest number of each ``bounded`` one.

    ``df`` is the table at ``path``; times in ``bounded`` are read as the numbers they are stored as.
    """
    side = df.sparkSession.newSession()  # the two settings below are no one else's
    side.conf.set("spark.sql.sources.useV1SourceList", "")
    side.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    fields = [T.StructField(f.name, T.LongType() if f.name in bounded else f.dataType) for f in df.schema]
    return side.read.schema(T.StructType(fields)).parquet(path).agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count(_quoted(c)).alias(f"values_{n}") for n, c in enumerate(counted)],
        *[F.max(_quoted(c)).alias(f"bound_{n}") for n, c in enumerate(bounded)],
    )


def _moment(micros: int, dtype: T.DataType) -> Column:
    return F.timestamp_micros(F.lit(micros)).cast(dtype)


def at_least(df: DataFrame, column: str, bound: int) -> DataFrame:
    """One row: the newest moment, in microseconds, of the rows that reach ``bound``."""
    newest = F.max(_quoted(column)).cast("timestamp")
    return df.where(_quoted(column) >= _moment(bound, df.schema[column].dataType)).agg(F.unix_micros(newest).alias("newest"))


def _figures(df: DataFrame, path: str, rules: Iterable[Rule]) -> tuple[int, dict, dict] | None:
    """(rows, values by column, newest by column), or None if the footers do not tell."""
    bounded = sorted({r.column for r in rules if isinstance(r, FreshWithin)})
    counted = sorted({r.column for r in rules if isinstance(r, NullShare)}.union(bounded))
    try:
        found = footer_aggregate(df, path, counted, bounded).first()
    except (Py4JJavaError, PySparkException):  # a real fault comes up again in the scan
        log.info("footers of %s do not tell; the table is scanned", path)
        return None
    # Without a file there is no footer to add up, and sums of nothing are null.
    values = {c: found[f"values_{n}"] or 0 for n, c in enumerate(counted)}
    newest = {}
    for n, column in enumerate(bounded):
        bound = found[f"bound_{n}"]
        newest[column] = None if bound is None else at_least(df, column, bound).first()["newest"]
        if newest[column] is None and values[column]:
            return None  # no moment reaches the bound: numbers of another unit
    return found["rows"] or 0, values, newest


def _folder_columns(df: DataFrame) -> set[str]:
    """Columns whose values are names of folders, in lower case; a NULL there counts as a value in a pushed count."""
    file = df.select("_metadata.file_path").first()
    names = [part.partition("=")[0] for part in file[0].split("/")[:-1] if "=" in part] if file else []
    return {unquote(unquote(name)).lower() for name in names}


def _answerable(df: DataFrame, rule: Rule, folders: set[str]) -> bool:
    if isinstance(rule, (RowCount, TableExists)):
        return True
    if not isinstance(rule, (NullShare, FreshWithin)) or rule.column not in df.columns or rule.column.lower() in folders:
        return False
    return isinstance(rule, NullShare) or isinstance(df.schema[rule.column].dataType, _TIMES)


def run_footer_rules(
    spark: SparkSession, path: str, rules: Sequence[Rule], suite: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """``run_rules`` on the Parquet table at ``path``, answered from footers as far as they tell.

    Row counts, NULL shares and the freshness of times need no scan; all other rules,
    freshness of text and columns that the table is partitioned by go into the usual one.  Footers are read when this is called.
    Files without statistics (INT96 times, a file with no value in a column) send all
    rules to the scan.  With a ``schema`` the folder may be empty.
    """
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    folders = _folder_columns(df)
    easy = [rule for rule in rules if _answerable(df, rule, folders)]
    figures = _figures(df, path, easy) if easy else None
    if figures is None:
        return run_rules(df, rules, suite, table)
    rows, values, newest = figures

    def measured(rule: Rule) -> list[Column]:
        if isinstance(rule, NullShare):
            return [F.lit(rows), F.lit(rows - values[rule.column])]
        if isinstance(rule, FreshWithin):
            dtype, micros = df.schema[rule.column].dataType, newest[rule.column]
            moment = F.lit(None).cast(dtype) if micros is None else _moment(micros, dtype)
            return [F.lit(rows), F.lit(values[rule.column]), age_hours(moment, time_literal(rule.as_of, dtype))]
        return [F.lit(rows)]

    answers = [result_row(rule, suite, table, rule.verdict(*measured(rule))) for rule in easy]
    told = spark.range(1).select(F.inline(F.array(*answers)))
    rest = [rule for rule in rules if rule not in easy]
    return told.unionByName(run_rules(df, rest, suite, table)) if rest else told
