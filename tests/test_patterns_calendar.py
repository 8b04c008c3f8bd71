"""Levels from a table of patterns, and means over days of the calendar."""

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from flowgauge.operators import calendar_means, calendar_spine, matched_levels, sla_from_patterns
from tests.conftest import final_plan

PATTERNS = "priority int, pattern string, sla_threshold_seconds int"
DAY = datetime(2024, 1, 1)


def test_first_pattern_by_priority(spark):
    rng = random.Random(4)

    def word(most):
        return "".join(rng.choice("abäB_%") for _ in range(rng.randrange(0, most)))

    names = [word(12) for _ in range(200)] + ["", None, "a", "%", "abab" * 50]
    patterns = [(rng.choice([1, 2, 3, None]), word(7), rng.randrange(1, 9)) for _ in range(60)] + [(1, None, 5)]
    frame = spark.createDataFrame([(n,) for n in names], "dag_id string")
    levels = spark.createDataFrame(patterns, PATTERNS)

    def best(name):
        if name is None:
            return None
        found = [(p if p is not None else 1 << 70, s, t) for p, t, s in patterns if t is not None and t in name]
        return min(found)[1:] if found else None

    got = {r.dag_id: (r.sla_threshold_seconds, r.pattern) for r in matched_levels(frame, levels).collect()}
    assert got == {n: best(n) for n in set(names) if best(n) is not None}
    for bound in (0, 100):
        rows = sla_from_patterns(frame, levels, default=77, broadcast_rows=bound).collect()
        assert sorted(map(repr, rows)) == sorted(repr(type(rows[0])(dag_id=n, sla_threshold_seconds=(best(n) or (77,))[0])) for n in names)


def test_no_patterns_and_no_names(spark):
    names = spark.createDataFrame([("a",), (None,)], "dag_id string")
    none = spark.createDataFrame([], PATTERNS)
    assert matched_levels(names, none).count() == 0
    assert [r.sla_threshold_seconds for r in sla_from_patterns(names, none).collect()] == [None, None]
    assert sla_from_patterns(names.limit(0), spark.createDataFrame([(1, "a", 2)], PATTERNS)).count() == 0


def test_distinct_names_are_matched_not_rows(spark):
    """5,000 patterns and 20,000 rows of four names: what meets patterns are the four names' pieces."""
    rows = spark.range(20_000).select(F.concat(F.lit("flow_"), F.col("id") % 4).alias("dag_id"))
    patterns = spark.range(5000).select(
        F.col("id").cast("int").alias("priority"), F.concat(F.lit("p"), "id").alias("pattern"), F.lit(5).alias("sla_threshold_seconds")
    )
    plan = final_plan(matched_levels(rows, patterns))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan and "CASE WHEN contains" not in plan
    # Names are made distinct below the step that cuts them into pieces.
    assert plan.index("Generate explode(sequence") < plan.index("HashAggregate(keys=[name")


def daily(spark, *rows):
    data = [(k, None if d is None else DAY + timedelta(days=d), None if v is None else Decimal(str(v)), "x") for k, d, v in rows]
    return spark.createDataFrame(data, "dag_id string, execution_day timestamp_ntz, rate decimal(7,2), note string")


def test_spine_fills_gaps(spark):
    df = daily(spark, ("a", 0, 1), ("a", 3, 2), ("b", 5, 3), (None, 1, 4), (None, 3, 5), ("c", None, 6), ("c", 2, 7))
    got = sorted(
        (str(r.dag_id), -1 if r.execution_day is None else (r.execution_day - DAY).days, r.note, r.has_rows)
        for r in calendar_spine(df).collect()
    )
    assert got == sorted(
        [("a", 0, "x", True), ("a", 1, None, False), ("a", 2, None, False), ("a", 3, "x", True), ("b", 5, "x", True),
         ("None", 1, "x", True), ("None", 2, None, False), ("None", 3, "x", True), ("c", -1, "x", True), ("c", 2, "x", True)],
        key=lambda r: (r[0], r[1], str(r[2])),
    )


def test_means_reach_back_over_days(spark):
    rng = random.Random(8)
    rows = [(k, d, rng.randrange(0, 10_000) / 100) for k in ("a", None) for d in range(60) if rng.random() < 0.4]
    rows = [(k, d, None if rng.random() < 0.1 else v) for k, d, v in rows]
    df = daily(spark, *rows)
    got = calendar_means(df, "rate", {"one": 1, "week": 7, "month": 30}).collect()
    for key in ("a", None):
        own = {d: v for k, d, v in rows if k == key}
        found = [r for r in got if r.dag_id == key]
        assert [(r.execution_day - DAY).days for r in sorted(found, key=lambda r: r.execution_day)] == list(range(min(own), max(own) + 1))
        for r in found:
            d = (r.execution_day - DAY).days
            for name, days in (("one", 1), ("week", 7), ("month", 30)):
                values = [own[x] for x in range(d - days + 1, d + 1) if own.get(x) is not None]
                assert r[name] == (pytest.approx(sum(values) / len(values)) if values else None)


def test_frames_and_empty_tables(spark):
    assert calendar_means(daily(spark), "rate", {"week": 7}).count() == 0
    with pytest.raises(ValueError):
        calendar_means(daily(spark), "rate", {"week": 0})
