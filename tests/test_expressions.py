from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge import functions as fx
from flowgauge.plans.staging import stg_dag_runs, timed


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "part, whole, percent",
    [(23, 160, 14.38), (1, 3, 33.33), (2, 3, 66.67), (0, 5, 0.0), (5, 5, 100.0), (1, 0, None)],
)
def test_rate_rounds_half_up(spark, part, whole, percent):
    rate = fx.rate_percent(F.lit(part).cast("bigint"), F.lit(whole).cast("bigint"))
    assert one(spark, rate.cast("double")) == percent


def test_rate_equals_integer_rounding_for_all_small_pairs(spark):
    pairs = spark.range(301).withColumnRenamed("id", "n").select(
        "n", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n"))).alias("k")
    )
    exact = F.expr("(k * 20000 + n) div (2 * n)")
    wrong = pairs.where("n > 0").where(
        (fx.rate_percent(F.col("k"), F.col("n")) * 100).cast("bigint") != exact
    )
    assert wrong.count() == 0


@pytest.mark.parametrize(
    "name, seconds",
    [
        ("critical_etl", 3600),
        ("my_daily_job", 7200),
        ("critical_daily_x", 3600),
        ("Critical_x", 10800),
        ("adhoc", 10800),
        (None, 10800),
    ],
)
def test_first_matching_tier_wins(spark, name, seconds):
    assert one(spark, fx.sla_threshold(F.lit(name).cast("string"))) == seconds


def test_seconds_keep_microseconds_and_ignore_the_session_zone(spark):
    # 02:00 to 03:00 does not exist in New York on that day.
    start = F.lit("2024-03-10 01:00:00").cast("timestamp_ntz")
    end = F.lit("2024-03-10 04:00:00.25").cast("timestamp_ntz")
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert one(spark, fx.seconds_between(start, end)) == 10800.25
        assert one(spark, fx.day_of(end)) == datetime(2024, 3, 10)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_negative_span(spark):
    start = F.lit("2024-01-01 00:01:00").cast("timestamp_ntz")
    end = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    assert one(spark, fx.seconds_between(start, end)) == -60.0


def test_duration_is_stored_else_computed(make_runs):
    begin = datetime(2024, 1, 1, 3)
    rows = stg_dag_runs(
        make_runs(
            {"dag_id": "stored", "duration": 5.0, "start_date": begin, "end_date": begin},
            {"dag_id": "computed", "start_date": begin, "end_date": begin + timedelta(seconds=90)},
            {"dag_id": "running", "start_date": begin},
            {"dag_id": "no_start", "end_date": begin},
        )
    )
    found = {r.dag_id: r.calculated_duration for r in rows.collect()}
    assert found == {"stored": 5.0, "computed": 90.0, "running": None, "no_start": None}
    assert {r.dag_id for r in timed(rows).collect()} == {"stored", "computed"}


def test_parse_timestamp(spark):
    assert one(spark, fx.parse_timestamp(F.lit("2024-01-02 03:04:05.6"))) == datetime(
        2024, 1, 2, 3, 4, 5, 600000
    )
    assert one(spark, fx.parse_timestamp(F.lit("soon"))) is None


def test_time_literal_follows_the_column_type(spark):
    aware = datetime(2024, 1, 1, 5, tzinfo=timezone(timedelta(hours=2)))
    ntz = spark.range(1).select(fx.time_literal(aware, T.TimestampNTZType()).alias("x"))
    ltz = spark.range(1).select(fx.time_literal(aware, T.TimestampType()).alias("x"))
    assert ntz.schema["x"].dataType == T.TimestampNTZType()
    assert ltz.schema["x"].dataType == T.TimestampType()
    assert ntz.first()["x"] == datetime(2024, 1, 1, 3)
    assert ltz.select(F.unix_seconds("x").alias("s")).first()["s"] == 1704078000


def test_state_buckets(spark):
    states = ["success", "failed", "running", "queued", "scheduled", "skipped"]
    found = [one(spark, fx.state_bucket(F.lit(s))) for s in states]
    assert found == ["success", "failed"] + ["in_progress"] * 3 + ["other"]


def test_age_and_percent_text(spark):
    old = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    now = F.lit("2024-01-02 01:30:00").cast("timestamp_ntz")
    assert one(spark, fx.age_hours(old, now)) == 25.5
    assert one(spark, fx.percent_text(F.lit(0.0104))) == "1.04%"
