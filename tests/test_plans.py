"""The physical plans: what is pushed down, scanned, shuffled and gathered."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from contract import fixtures
from contract.queries import QUERIES
from flowgauge.operators import join_thresholds, sla_thresholds
from flowgauge.plans import marts
from flowgauge.plans.staging import stg_dag_runs, stg_task_instances, timed
from flowgauge.quality import dag_runs_suite, run_suite, task_instances_suite
from flowgauge.schemas import DAG_RUNS, TASK_INSTANCES
from flowgauge.sources import extract_dag_runs
from tests.conftest import final_plan

SCAN = r"FileScan parquet"


@pytest.fixture(scope="module")
def stored(spark, sf_dir, tmp_path_factory):
    """The two raw tables as Parquet, as they would be on a cluster."""
    folder = tmp_path_factory.mktemp("raw")
    fixtures.dag_runs(spark, sf_dir).write.parquet(f"{folder}/dag_runs")
    fixtures.task_instances(spark, sf_dir).write.parquet(f"{folder}/task_instances")
    runs = spark.read.schema(DAG_RUNS).parquet(f"{folder}/dag_runs")
    tasks = spark.read.schema(TASK_INSTANCES).parquet(f"{folder}/task_instances")
    return runs, tasks


@pytest.fixture
def no_broadcast(spark):
    """Plans as for tables too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def scans(plan):
    """Scans that really run; a reused shuffle does not read again."""
    return len(re.findall(SCAN, plan))


def shuffles(plan):
    return len(re.findall(r"[-+] Exchange (?:hash|range|Single)", plan))


def test_window_filter_reaches_the_scan(spark, stored):
    plan = final_plan(
        extract_dag_runs(spark, stored[0], datetime(2024, 1, 2), datetime(2024, 1, 3))
    )
    assert "GreaterThanOrEqual(execution_date,2024-01-02T00:00)" in plan
    assert "LessThanOrEqual(execution_date,2024-01-03T00:00)" in plan


def test_known_duration_filter_reaches_the_scan(stored):
    plan = final_plan(timed(stg_dag_runs(stored[0])))
    assert "Or(IsNotNull(duration),And(IsNotNull(start_date),IsNotNull(end_date)))" in plan


def test_only_needed_columns_are_read(stored):
    plan = final_plan(marts.dag_failure_rates(stg_dag_runs(stored[0])))
    (read,) = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert {column.split(":")[0] for column in read.split(",")} == {"dag_id", "execution_date", "state"}


def test_runtime_metrics_scan_once_and_gather_nothing(stored, no_broadcast):
    plan = final_plan(marts.dag_runtime_metrics(stg_dag_runs(stored[0])))
    assert scans(plan) == 1 and "ReusedExchange" in plan
    assert "SinglePartition" not in plan
    # Values are hashed, not gathered by group: no object aggregate holds a group.
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_failure_rates_shuffle_twice(stored):
    """Once to the day, once to the workflow: the second carries one row per day."""
    plan = final_plan(marts.dag_failure_rates(stg_dag_runs(stored[0])))
    assert scans(plan) == 1 and shuffles(plan) == 2
    assert "SinglePartition" not in plan


def test_sla_misses_do_not_join(stored):
    runs, tasks = stg_dag_runs(stored[0]), stg_task_instances(stored[1])
    plan = final_plan(marts.sla_misses(runs, tasks))
    assert "Join" not in plan and "SinglePartition" not in plan
    assert scans(plan) == 2 and shuffles(plan) == 2


def test_top_list_keeps_k_rows_per_task(stored):
    from flowgauge.operators import top_k

    totals = marts.task_totals(stg_task_instances(stored[1]))
    plan = final_plan(top_k(totals, marts.slowest_first("avg_duration_seconds"), 10))
    assert "TakeOrderedAndProject(limit=10" in plan


def test_ranks_gather_only_partition_counts(stored):
    """The one-partition window sees the per-partition counts, not the rows."""
    from flowgauge.operators import global_row_number

    totals = marts.task_totals(stg_task_instances(stored[1]))
    plan = final_plan(global_row_number(totals, marts.slowest_first("max_duration_seconds"), "r"))
    gathered = plan[plan.index("SinglePartition") :]
    assert re.search(r"HashAggregate\(keys=\[_part", gathered)
    assert scans(plan) == 0  # the rows come from the checkpoint


def test_slowest_tasks_starts_no_job_and_sorts_no_totals(spark, stored):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("slowest", "")
    df = marts.slowest_tasks(stg_task_instances(stored[1]))
    assert not tracker.getJobIdsForGroup("slowest")
    plan = final_plan(df)
    assert "rangepartitioning" not in plan and "ReusedExchange" in plan
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_threshold_join_scans_facts_twice_at_most(spark, stored):
    tasks = stg_task_instances(stored[1])
    plan = final_plan(join_thresholds(tasks, sla_thresholds(tasks)))
    # One scan reduced the thresholds to a checkpoint; what is left reads the facts once.
    assert scans(plan) == 1


def test_suite_is_one_scan_and_one_aggregate(stored):
    for df, suite in ((stored[0], dag_runs_suite()), (stored[1], task_instances_suite())):
        plan = final_plan(run_suite(df, suite))
        assert scans(plan) == 1 and shuffles(plan) == 1
        assert "extracted_at" not in re.findall(r"ReadSchema: struct<([^>]*)>", plan)[0]


def test_daily_checks_scan_each_table_once(spark, stored):
    from flowgauge.plans.pipeline import run_all_rules

    tables = {"dag_runs": stored[0], "task_instances": stored[1]}
    results = run_all_rules(spark, tables, datetime(2024, 2, 1))
    plan = final_plan(results)
    assert results.count() == 20 and scans(plan) == 2 and shuffles(plan) == 2


def test_large_threshold_tables_join_by_salted_shuffle(stored, no_broadcast):
    tasks = stg_task_instances(stored[1])
    small = final_plan(join_thresholds(tasks, sla_thresholds(tasks)))
    assert "BroadcastHashJoin" in small
    large = final_plan(join_thresholds(tasks, sla_thresholds(tasks), broadcast_rows=0))
    assert "SortMergeJoin" in large and "_salt" in large and "Broadcast" not in large


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, sf_dir, name):
    plan = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "Python" not in plan


def test_only_thresholds_of_hot_tasks_are_repeated(spark, make_tasks, no_broadcast):
    """300 tasks, one of which has most runs: its threshold is repeated, the others are not."""
    tasks = make_tasks(
        *[{"dag_id": f"d{i}", "execution_date": datetime(2024, 1, 1)} for i in range(300)],
        *[{"dag_id": "hot", "execution_date": datetime(2024, 1, 1, i % 24, i % 60, i // 60)} for i in range(1000)],
        {"dag_id": None},
    )
    limits = sla_thresholds(tasks).where("dag_id is not null")
    for how, rows in (("inner", 1300), ("left", 1301)):
        joined = join_thresholds(tasks, limits, broadcast_rows=0, how=how, hot_rows=100)
        plan = final_plan(joined)
        assert joined.count() == rows and "SortMergeJoin" in plan
        assert sorted(map(repr, joined.collect())) == sorted(map(repr, join_thresholds(tasks, limits, how=how).collect()))
    from flowgauge.operators import hot_tasks

    (hot,) = hot_tasks(tasks, 100).collect()
    assert (hot.dag_id, hot._salts) == ("hot", 10)
    spark.conf.set("spark.sql.shuffle.partitions", "64")  # copies do not grow with it
    repeated = join_thresholds(tasks, limits, broadcast_rows=0, hot_rows=100)
    metrics = repeated._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "64" not in re.findall(r"sequence\([^)]*\)", metrics)
