from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract import fixtures
from flowgauge.plans import marts
from flowgauge.plans.staging import stg_dag_runs, stg_task_instances
from flowgauge.schemas import SlaThresholds

DAY = datetime(2024, 1, 1)


def run(n=0, **more):
    return {"execution_date": DAY + timedelta(hours=n), **more}


def test_runtime_counts_only_timed_runs(make_runs):
    runs = stg_dag_runs(
        make_runs(
            run(1, duration=10.0),
            run(2, duration=20.0, state="failed"),
            run(3, state="running", start_date=DAY),
            run(4, dag_id="idle", state="queued"),
        )
    )
    (row,) = marts.dag_runtime_metrics(runs).collect()
    assert (row.dag_id, row.execution_day) == ("a", DAY)
    assert (row.total_runs, row.successful_runs, row.failed_runs) == (2, 1, 1)
    assert (row.min_duration_seconds, row.max_duration_seconds) == (10.0, 20.0)
    assert (row.avg_duration_seconds, row.total_duration_seconds) == (15.0, 30.0)
    assert row.median_duration_seconds == 15.0
    assert row.p95_duration_seconds == 10.0 + 10.0 * 0.95


def test_one_run_is_its_own_percentile(make_runs):
    (row,) = marts.dag_runtime_metrics(stg_dag_runs(make_runs(run(duration=42.0)))).collect()
    assert row.median_duration_seconds == row.p95_duration_seconds == 42.0


def test_runs_without_a_workflow_form_a_group(make_runs):
    runs = stg_dag_runs(make_runs(run(dag_id=None, duration=1.0), run(1, dag_id=None, duration=3.0)))
    (row,) = marts.dag_runtime_metrics(runs).collect()
    assert row.dag_id is None and row.total_runs == 2 and row.median_duration_seconds == 2.0


def test_failure_rates_count_all_runs(make_runs):
    rows = [run(duration=1.0, state="failed")] * 23 + [run(state="running")] * 137
    (row,) = marts.dag_failure_rates(stg_dag_runs(make_runs(*rows))).collect()
    assert (row.total_runs, row.failed_runs, row.successful_runs) == (160, 23, 0)
    assert row.failure_rate_percent == row.rolling_7d_failure_rate == 14.38
    assert row.success_rate_percent == 0.0
    assert "in_progress_runs" not in row


def test_rolling_means_skip_missing_days(make_runs):
    days = [0, 1, 5, 9, 12, 20, 21, 30]
    rows = [
        run(24 * day, state="failed" if n == 0 else "success", duration=1.0)
        for n, day in enumerate(days)
    ]
    found = marts.dag_failure_rates(stg_dag_runs(make_runs(*rows))).orderBy("execution_day").collect()
    assert [round(r.rolling_7d_failure_rate, 6) for r in found][-2:] == [round(100 / 7, 6), 0.0]
    assert found[-1].rolling_30d_failure_rate == 100 / 8


def test_slowest_tasks_ranks_and_ties(make_tasks):
    tasks = make_tasks(
        run(task_id="b", duration=10.0),
        run(task_id="a", duration=10.0),
        run(task_id="spiky", duration=1.0),
        run(task_id="spiky", duration=17.0, state="failed"),
        run(task_id="quick", duration=1.0),
        run(task_id="untimed"),
    )
    found = marts.slowest_tasks(stg_task_instances(tasks), k=3).orderBy("rank_by_avg_duration").collect()
    assert [r.task_id for r in found] == ["a", "b", "spiky"]
    assert [r.rank_by_avg_duration for r in found] == [1, 2, 3]
    assert [r.rank_by_max_duration for r in found] == [2, 3, 1]
    assert found[2].failure_rate_percent == 50.0
    assert found[2].p95_duration_seconds == 1.0 + 16.0 * 0.95
    assert (found[2].failed_executions, found[2].successful_executions) == (1, 1)


def test_slowest_tasks_keeps_a_task_without_a_name(make_tasks):
    tasks = make_tasks(run(task_id=None, duration=5.0), run(task_id="t", duration=1.0))
    found = marts.slowest_tasks(stg_task_instances(tasks)).orderBy("rank_by_avg_duration").collect()
    assert [(r.task_id, r.p95_duration_seconds) for r in found] == [(None, 5.0), ("t", 1.0)]


@pytest.mark.parametrize("dag, limit", [("critical_1", 3600), ("daily_1", 7200), ("x", 10800)])
def test_exactly_the_limit_meets_it(make_runs, make_tasks, dag, limit):
    tasks = make_tasks(run(dag_id=dag, duration=float(limit)), run(1, dag_id=dag, duration=limit + 1.0))
    found = marts.sla_misses(
        stg_dag_runs(make_runs(run(dag_id=dag, duration=7200.0))), stg_task_instances(tasks)
    )
    rows = {r.entity_type: r for r in found.collect()}
    task, dag_row = rows["task"], rows["dag"]
    assert (task.sla_misses, task.sla_meets, task.sla_threshold_seconds) == (1, 1, limit)
    assert task.sla_miss_rate_percent == 50.0 and task.identifier == "t"
    assert (dag_row.sla_misses, dag_row.sla_meets, dag_row.sla_threshold_seconds) == (0, 1, 7200)
    assert dag_row.identifier is None


def test_sla_thresholds_are_parameters(make_runs, make_tasks):
    runs = stg_dag_runs(make_runs(run(dag_id="critical", duration=50.0)))
    tasks = stg_task_instances(make_tasks(run(dag_id="critical", duration=50.0)))
    limits = SlaThresholds(critical=40, dag_level=60)
    rows = {r.entity_type: r for r in marts.sla_misses(runs, tasks, limits).collect()}
    assert rows["task"].sla_misses == 1 and rows["dag"].sla_misses == 0
    tiered = marts.sla_misses(runs, tasks, limits, dag_limit_by_tier=True)
    assert tiered.where("entity_type = 'dag'").first().sla_misses == 1


def test_sla_with_a_threshold_table_equals_the_rules(spark, sf_dir):
    from flowgauge.operators import sla_thresholds

    tasks = stg_task_instances(fixtures.task_instances(spark, sf_dir))
    joined = marts.sla_task_daily(tasks, task_thresholds=sla_thresholds(tasks))
    ruled = marts.sla_task_daily(tasks).select(*joined.columns)
    assert joined.exceptAll(ruled).count() == 0 and ruled.exceptAll(joined).count() == 0


def test_unnamed_tasks_have_no_service_level(make_tasks):
    tasks = make_tasks(run(dag_id=None, duration=1.0), run(task_id=None, duration=1.0))
    assert marts.sla_task_daily(stg_task_instances(tasks)).count() == 0


def test_empty_input(make_runs, make_tasks):
    runs = stg_dag_runs(make_runs(run()).where("false"))
    tasks = stg_task_instances(make_tasks(run()).where("false"))
    for df in (
        marts.dag_runtime_metrics(runs),
        marts.dag_failure_rates(runs),
        marts.slowest_tasks(tasks),
        marts.sla_misses(runs, tasks),
    ):
        assert df.count() == 0


def test_partitioning_does_not_change_results(spark, sf_dir):
    runs = fixtures.dag_runs(spark, sf_dir)
    tasks = fixtures.task_instances(spark, sf_dir)
    for build, sources in (
        (marts.dag_runtime_metrics, [stg_dag_runs(runs)]),
        (marts.dag_failure_rates, [stg_dag_runs(runs)]),
        (marts.slowest_tasks, [stg_task_instances(tasks)]),
        (marts.sla_misses, [stg_dag_runs(runs), stg_task_instances(tasks)]),
    ):
        plain, spread = build(*sources), build(*[s.repartition(11, "start_date") for s in sources])
        assert plain.exceptAll(spread).count() == 0 and spread.exceptAll(plain).count() == 0


def test_report_order(spark, sf_dir):
    runs = stg_dag_runs(fixtures.dag_runs(spark, sf_dir))
    rows = marts.in_report_order("dag_failure_rates", marts.dag_failure_rates(runs)).collect()
    keys = [(r.dag_id, -r.execution_day.timestamp()) for r in rows]
    assert keys == sorted(keys)
    unsorted = marts.dag_runtime_metrics(runs)
    assert marts.in_report_order("dag_runtime_metrics", unsorted) is unsorted


def test_hot_workflow_matches_the_builtin(spark, sf_dir):
    """One workflow holds a third of all runs; its days agree with Spark's own percentile."""
    from flowgauge.functions import day_of
    from flowgauge.plans.staging import timed

    runs = fixtures.dag_runs(spark, sf_dir)
    hot = runs.withColumn("dag_id", F.lit("hot")).withColumn("duration", F.col("duration") / 7)
    mixed = stg_dag_runs(runs.unionByName(hot))
    wanted = (
        timed(mixed)
        .groupBy("dag_id", day_of(F.col("execution_date")).alias("execution_day"))
        .agg(F.percentile("calculated_duration", F.lit(0.95)).alias("wanted"), F.count("*").alias("n"))
    )
    both = marts.dag_runtime_metrics(mixed).join(wanted, ["dag_id", "execution_day"])
    assert both.count() == wanted.count()
    assert both.where("abs(wanted - p95_duration_seconds) > 1e-6 or n <> total_runs").count() == 0
