"""Fingerprints of models: what they compute and which files they are built from."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The table property that keeps a model's fingerprint.
PROPERTY = "flowgauge.fingerprint"
_FIELDS = "spark.sql.debug.maxToStringFields"


def files_of(source: DataFrame) -> DataFrame:
    """(file_path, file_size, file_modification_time) of the files with rows; no column of the source is read."""
    parts = ("file_path", "file_size", "file_modification_time")
    return source.select(*[F.col(f"_metadata.{part}").alias(part) for part in parts]).distinct()


def source_state(source: DataFrame) -> str | None:
    """A mark that changes with the files of a table or path; None for sources that are not files."""
    try:
        files = files_of(source)
    except AnalysisException:
        return None
    marks = F.bit_xor(F.xxhash64(*files.columns))
    row = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(marks, F.lit(0)).alias("mark")).first()
    return f"{row['n']}:{row['mark']}"


def plan_text(df: DataFrame) -> str:
    """The analyzed plan in full, with expression numbers in order of appearance, so equal queries read alike."""
    conf = df.sparkSession.conf
    before = conf.get(_FIELDS)
    conf.set(_FIELDS, "1000000")
    try:
        text = df._jdf.queryExecution().analyzed().toString()
    finally:
        conf.set(_FIELDS, before)
    text = re.sub(r"\b([xyz])_\d+#", r"\1#", text)  # names of lambda variables count up over the whole session
    numbers: dict[str, int] = {}
    return re.sub(r"#(\d+)", lambda m: f"#{numbers.setdefault(m[1], len(numbers))}", text)


def fingerprint(df: DataFrame, states: Iterable[str | None]) -> str | None:
    """A hash of the query, its columns with their comments, and its sources' states; None if one is unknown."""
    states = list(states)
    if None in states:
        return None
    return hashlib.sha256("\n".join([plan_text(df), df.schema.json(), *states]).encode()).hexdigest()


def stored_fingerprint(spark: SparkSession, table: str) -> str | None:
    """The fingerprint that ``table`` was built with; None if there is no such table or it has none."""
    if not spark.catalog.tableExists(table):
        return None
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PROPERTY).collect()
    return rows[0]["value"] if rows else None


def store_fingerprint(spark: SparkSession, table: str, mark: str) -> None:
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{mark}')")
