"""Marts that follow the loads, against full rebuilds."""

import re
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.plans import incremental as inc
from flowgauge.plans import marts
from flowgauge.plans.staging import stg_dag_runs, stg_task_instances
from flowgauge.sources import extract_and_merge
from tests.conftest import final_plan
from tests.test_load import T0, at, database  # noqa: F401


def full(spark, database, name):
    runs = stg_dag_runs(spark.table(f"{database}.dag_runs"))
    tasks = stg_task_instances(spark.table(f"{database}.task_instances"))
    return {
        "dag_runtime_metrics": lambda: marts.dag_runtime_metrics(runs),
        "dag_failure_rates": lambda: marts.dag_failure_rates(runs),
        "sla_misses": lambda: marts.sla_misses(runs, tasks),
    }[name]()


def assert_equal_to_full_rebuild(spark, database):
    for name in inc.MARTS:
        wanted = full(spark, database, name)
        got = spark.table(f"{database}.{name}")
        assert {c for c in got.columns} == {*wanted.columns, "day"}
        assert sorted(map(repr, got.select(*wanted.columns).collect())) == sorted(map(repr, wanted.collect()))


def loads(spark, database, make_runs, make_tasks, rows, day):
    end = T0 + timedelta(days=day)
    merged = extract_and_merge(spark, make_runs(*rows), make_tasks(*rows), end - timedelta(days=1), end, end, database)
    return inc.apply_merges(spark, database, merged)


@pytest.fixture
def three_days(spark, make_runs, make_tasks, database):
    """Loads over days with gaps, late ends, null names and null times; returns what the last one touched."""
    history = [
        at(-20, dag_id="a", duration=4000.0),
        at(-19, dag_id="a", state="failed", duration=8000.0),
        at(-18, dag_id=None, duration=5.0),
        at(-17, dag_id="b", state="running"),
        {"execution_date": None, "dag_id": "b", "duration": 3.0},
        at(3, dag_id="a", state="queued"),
        at(70, dag_id="a", duration=1.5),
    ]
    loads(spark, database, make_runs, make_tasks, history, 0)
    history[3] = at(-17, dag_id="b", duration=11000.0, extracted_at=T0 + timedelta(days=1))
    loads(spark, database, make_runs, make_tasks, history, 1)
    history[5] = at(3, dag_id="a", state="failed", duration=7200.0, extracted_at=T0 + timedelta(days=3))
    return loads(spark, database, make_runs, make_tasks, history, 3)


def test_equal_to_a_full_rebuild(spark, database, three_days):
    assert_equal_to_full_rebuild(spark, database)
    assert three_days == {"run_partials": {"2024-01-10", "2024-01-13"}, "task_partials": {"2024-01-10", "2024-01-13"}}
    # What broke off is put right from the raw tables.
    spark.sql(f"ALTER TABLE {database}.run_partials DROP PARTITION (day = '2024-01-10')")
    days = inc.rebuild_partials(spark, database, ["2024-01-10"])
    inc.refresh_marts(spark, database, days)
    assert_equal_to_full_rebuild(spark, database)


def test_counts_that_come_to_nothing_go(spark, make_runs, database):
    table, runs = f"{database}.p", make_runs(at(0, duration=1.0), at(0, duration=1.0), at(30, duration=2.0))
    assert inc.merge_partials(spark, table, ["dag_id"], runs.withColumn("sign", F.lit(1))) == {"2024-01-10", "2024-01-11"}
    assert sorted(r.weight for r in spark.table(table).collect()) == [1, 2]
    gone = make_runs(at(30, duration=2.0)).withColumn("sign", F.lit(-1))
    assert inc.merge_partials(spark, table, ["dag_id"], gone) == {"2024-01-11"}
    assert [(r.day, r.weight) for r in spark.table(table).collect()] == [("2024-01-10", 2)]
    both = make_runs(at(0, duration=1.0)).withColumn("sign", F.explode(F.array(F.lit(1), F.lit(-1))))
    assert inc.merge_partials(spark, table, ["dag_id"], both) == set()


def test_untouched_days_are_not_scanned(spark, make_runs, database):
    table = f"{database}.run_partials"
    runs = make_runs(*[at(24 * k, duration=float(k)) for k in range(6)])
    inc.merge_partials(spark, table, ["dag_id"], runs.withColumn("sign", F.lit(1)))
    some = inc._of_days(spark.table(table), ["2024-01-11"])
    for df in (inc.runtime_metrics(some), inc._outcomes(some)):
        plan = final_plan(df)
        assert re.search(r"PartitionFilters: \[[^\]]*day#\d+[^\]]*2024-01-11", plan)
    assert some.select(F.input_file_name()).distinct().count() == 1
    files = set(spark.table(table).inputFiles())
    inc.merge_partials(spark, table, ["dag_id"], make_runs(at(24, duration=9.0)).withColumn("sign", F.lit(1)))
    assert len(files & set(spark.table(table).inputFiles())) == 5
