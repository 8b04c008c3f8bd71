"""Selecting related models, and building only those whose query or files changed."""

from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.plans import models
from flowgauge.plans.changes import files_of, plan_text, source_state
from flowgauge.plans.models import build_models, selected_models, source_names
from flowgauge.schemas import SlaThresholds

STAGING = ["stg_dag_runs", "stg_task_instances"]
MARTS = {"dag_runtime_metrics", "dag_failure_rates", "slowest_tasks", "sla_misses"}
BEGIN = datetime(2024, 1, 1, 3)


@pytest.fixture()
def database(spark):
    spark.sql("CREATE DATABASE changes")
    yield "changes"
    spark.sql("DROP DATABASE changes CASCADE")


@pytest.fixture()
def build(spark, make_runs, make_tasks, database):
    """Stores both sources and returns a build of what changed, without the views."""
    days = [{"execution_date": BEGIN + timedelta(days=k), "duration": 60.0 + k} for k in range(4)]
    make_runs(*days).write.saveAsTable(f"{database}.dag_runs")
    make_tasks(*days).write.saveAsTable(f"{database}.task_instances")

    def run(**settings):
        sources = {n: spark.table(f"{database}.{n}") for n in ("dag_runs", "task_instances")}
        return set(build_models(spark, sources, database=database, only_changed=True, **settings)) - set(STAGING)

    return run


def test_related_models():
    assert set(selected_models(["+sla_misses"])) == {*STAGING, "sla_misses"}
    assert set(selected_models(["stg_task_instances+"])) == {"stg_task_instances", "slowest_tasks", "sla_misses"}
    assert set(selected_models(["+stg_task_instances+"])) == {"stg_task_instances", "slowest_tasks", "sla_misses"}
    assert set(selected_models(["tag:staging+"])) == {*STAGING, *MARTS}
    assert set(selected_models(["+tag:dag_metrics"])) == {"stg_dag_runs", "dag_runtime_metrics", "dag_failure_rates"}
    assert set(selected_models(["+slowest_tasks", "dag_failure_rates"])) == {"stg_task_instances", "slowest_tasks", "dag_failure_rates"}
    assert selected_models([]) == []
    with pytest.raises(ValueError):
        selected_models(["nothing+"])
    assert source_names("sla_misses") == ["dag_runs", "task_instances"] and source_names("slowest_tasks") == ["task_instances"]


def test_unchanged_models_are_skipped(build):
    assert build() == MARTS
    assert build() == set()


def test_new_files_of_one_source(spark, build, make_tasks, database):
    build()
    make_tasks({"execution_date": BEGIN, "duration": 9.0}).write.mode("append").saveAsTable(f"{database}.task_instances")
    assert build() == {"slowest_tasks", "sla_misses"}
    assert spark.table(f"{database}.slowest_tasks").first().total_executions == 5
    # The same rows in other files count as a change.
    rows = spark.table(f"{database}.dag_runs").collect()
    spark.createDataFrame(rows, spark.table(f"{database}.dag_runs").schema).write.mode("overwrite").saveAsTable(f"{database}.dag_runs")
    assert build() == MARTS - {"slowest_tasks"}


def test_a_change_of_one_model_or_setting(monkeypatch, build):
    build()
    old = models.MODELS["slowest_tasks"]
    monkeypatch.setitem(models.MODELS, "slowest_tasks", replace(old, build=lambda tasks: old.build(tasks).limit(3)))
    assert build() == {"slowest_tasks"}
    staged = models.MODELS["stg_dag_runs"]
    without_failed = replace(staged, build=lambda runs, **s: staged.build(runs, **s).where(F.col("state") != "failed"))
    monkeypatch.setitem(models.MODELS, "stg_dag_runs", without_failed)
    assert build() == MARTS - {"slowest_tasks"}
    assert build(thresholds=SlaThresholds(critical=10)) == {"sla_misses"}
    assert build(thresholds=SlaThresholds(critical=10)) == set()


def test_a_missing_table_or_a_plain_build_is_built(spark, build, database):
    build()
    spark.sql(f"DROP TABLE {database}.dag_failure_rates")
    assert build() == {"dag_failure_rates"}
    sources = {n: spark.table(f"{database}.{n}") for n in ("dag_runs", "task_instances")}
    assert set(build_models(spark, sources, ["slowest_tasks"], database)) == {"slowest_tasks"}
    assert build() == {"slowest_tasks"}  # built without a fingerprint


def test_sources_without_files_always_count_as_changed(spark, make_runs, make_tasks, database):
    sources = {"dag_runs": make_runs({}), "task_instances": make_tasks({})}
    assert source_state(sources["dag_runs"]) is None
    for _ in range(2):
        assert MARTS <= set(build_models(spark, sources, database=database, only_changed=True))


def test_no_column_is_read_for_the_state(spark, build, database):
    files = files_of(spark.table(f"{database}.dag_runs"))
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<>" in plan
    assert source_state(spark.table(f"{database}.dag_runs").where("false")) == "0:0"


def test_equal_queries_read_alike(spark):
    def made(limit):
        return spark.range(10).select(*[(F.col("id") + k).alias(f"c{k}") for k in range(60)]).where(f"c59 > {limit}")

    assert plan_text(made(3)) == plan_text(made(3)) != plan_text(made(4))
    assert "more fields" not in plan_text(made(3))
