"""Checks answered from footers equal those of a scan, and read no column."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowgauge.quality import Between, FreshWithin, NullShare, RowCount, run_rules
from flowgauge.quality.footers import at_least, footer_aggregate, run_footer_rules

AS_OF = datetime(2024, 3, 1)
RULES = [
    RowCount(min_rows=5),
    NullShare(column="state", max_share=0.2),
    FreshWithin(as_of=AS_OF, column="at"),
    FreshWithin(as_of=AS_OF, column="at", max_age_hours=1e6, name="old_is_fine"),
]


def _frame(spark, n, kind="timestamp", start=0):
    moment = F.timestamp_micros(F.lit(1_706_000_000_000_000) + F.col("id") * 1_500_000)
    return spark.range(start, start + n).select(
        "id",
        F.when(F.col("id") % 4 > 0, "ok").alias("state"),
        F.when(F.col("id") % 5 > 0, moment).cast(kind).alias("at"),
        moment.cast("string").alias("told"),
    )


def _write(spark, df, path, stored="TIMESTAMP_MICROS"):
    key = "spark.sql.parquet.outputTimestampType"
    before = spark.conf.get(key)
    spark.conf.set(key, stored)
    try:
        df.write.mode("append").parquet(path)
    finally:
        spark.conf.set(key, before)


def _same(spark, path, rules=RULES, schema=None):
    df = (spark.read.schema(schema) if schema else spark.read).parquet(path)
    found = run_footer_rules(spark, path, rules, "s", "t", schema)
    assert found.schema.names == run_rules(df, rules, "s", "t").schema.names
    assert sorted(found.collect(), key=str) == sorted(run_rules(df, rules, "s", "t").collect(), key=str)
    return found


@pytest.mark.parametrize(
    "kind, stored",
    [("timestamp", "TIMESTAMP_MICROS"), ("timestamp", "TIMESTAMP_MILLIS"), ("timestamp", "INT96"), ("timestamp_ntz", "TIMESTAMP_MICROS")],
)
def test_equals_the_scan(spark, tmp_path, kind, stored):
    path = str(tmp_path / "t")
    _write(spark, _frame(spark, 1000, kind), path, stored)
    found = _same(spark, path)
    scans = "Scan parquet" in found._jdf.queryExecution().executedPlan().toString()
    assert scans == (stored == "INT96")  # times without statistics are read


def test_files_with_times_in_several_units(spark, tmp_path):
    path = str(tmp_path / "t")
    _write(spark, _frame(spark, 100), path, "TIMESTAMP_MICROS")
    _write(spark, _frame(spark, 100, start=1000), path, "TIMESTAMP_MILLIS")
    newest = {r.check_name: r.observed for r in _same(spark, path).collect()}
    assert newest["old_is_fine"] < (AS_OF.timestamp() - 1_706_000_000) / 3600  # that of the second file


def test_columns_without_a_value_and_empty_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    _write(spark, _frame(spark, 20).withColumn("at", F.lit(None).cast("timestamp")), path)
    _same(spark, path)
    empty = str(tmp_path / "empty")
    _write(spark, _frame(spark, 0), empty)
    _same(spark, empty)
    nothing = tmp_path / "nothing"
    nothing.mkdir()
    _same(spark, str(nothing), schema=_frame(spark, 1).schema)


def test_other_rules_and_missing_columns(spark, tmp_path):
    path = str(tmp_path / "t")
    _write(spark, _frame(spark, 50).withColumnRenamed("state", "a.b"), path)
    _same(
        spark,
        path,
        [
            RowCount(),
            NullShare(column="nope"),
            FreshWithin(as_of=AS_OF, column="nope"),
            FreshWithin(as_of=AS_OF, column="told"),
            Between(column="id", min_value=3),
            FreshWithin(as_of=AS_OF, column="at"),
        ],
    )
    dotted = footer_aggregate(spark.read.parquet(path), path, ["a.b"], []).first()
    assert (dotted["rows"], dotted["values_0"]) == (50, 37)


def test_partitioned_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    df = _frame(spark, 200).withColumn("day", F.when(F.col("id") % 3 > 0, F.col("id") % 3))
    df.write.partitionBy("day").parquet(path)
    _same(spark, path, [RowCount(), NullShare(column="day", max_share=0.5), NullShare(column="state", max_share=0.2)])


def test_no_column_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    _write(spark, _frame(spark, 1000), path)
    df = spark.read.parquet(path)
    plan = footer_aggregate(df, path, ["at", "state"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(at), COUNT(state), MAX(at)]" in plan
    assert "ReadSchema: struct<count(*):bigint,count(at):bigint,count(state):bigint,max(at):bigint>" in plan
    near = at_least(df, "at", 1_706_000_000_000_000)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at," in near and "ReadSchema: struct<at:timestamp>" in near
    # The settings of the reader stay its own.
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")
