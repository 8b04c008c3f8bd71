"""The contract's queries on history that the given tables lack: 45 days with gaps, ties, rows without a workflow."""

import duckdb
import pytest
from pyspark.sql import functions as F

import contract.compare as compare
from contract.oracle import ORACLE_SQL, RUN_STATES, TASK_STATES
from contract.queries import QUERIES

KEYS = ("win_rolling_7", "win_rolling_30", "win_rank_avg", "win_rank_max", "dag_failure_rates", "slowest_tasks", "sla_misses", "top_k_slowest")


@pytest.fixture(scope="module")
def variant(spark, tmp_path_factory):
    """Events on 45 of 60 days; few different values, so that means and maxima tie; some users unknown."""
    folder = str(tmp_path_factory.mktemp("variant"))
    spark.range(4000).selectExpr(
        "id AS event_id",
        "TIMESTAMP_NTZ'2024-01-01' + make_interval(0, 0, 0, int(id % 60), int(id * 7 % 24)) AS ts",
        "CASE WHEN id % 41 <> 0 THEN id * 13 % 97 END AS user_id",
        "element_at(array('view', 'error', 'purchase', 'signup', 'click'), int(1 + id * 31 % 101 % 5)) AS event_type",
        "CAST(10 AS DOUBLE) AS value",
    ).where("dayofyear(ts) % 4 <> 3").coalesce(1).write.parquet(f"{folder}/events.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{folder}/events.parquet/*.parquet'")
    return folder, connection


@pytest.mark.parametrize("name", KEYS)
def test_equals_sql(spark, variant, name):
    assert compare.differences(spark, variant[1], name, variant[0]) == []


@pytest.mark.parametrize(
    ("name", "right", "wrong"),
    [
        ("win_rolling_30", "ROWS 29 PRECEDING", "ROWS 28 PRECEDING"),
        ("win_rolling_30", "ROWS 29 PRECEDING", "ROWS 30 PRECEDING"),
        ("win_rank_avg", "avg_duration_seconds DESC NULLS LAST, dag_id NULLS FIRST, task_id", "avg_duration_seconds DESC NULLS LAST, dag_id DESC, task_id"),
        ("win_rank_max", "max_duration_seconds DESC NULLS LAST, dag_id NULLS FIRST, task_id", "max_duration_seconds DESC NULLS LAST, dag_id NULLS LAST, task_id"),
    ],
)
def test_a_wrong_frame_or_tie_break_would_show(spark, variant, name, right, wrong, monkeypatch):
    assert right in ORACLE_SQL[name]
    monkeypatch.setitem(compare.ORACLE_SQL, name, ORACLE_SQL[name].replace(right, wrong))
    assert compare.differences(spark, variant[1], name, variant[0]) != []


@pytest.mark.parametrize(("name", "states"), [("exp_suite_dag_runs", RUN_STATES), ("exp_suite_task_instances", TASK_STATES)])
def test_every_state_is_known_and_no_other(spark, name, states):
    from flowgauge.quality import dag_runs_suite, run_rules, task_instances_suite

    suite = dag_runs_suite() if "dag" in name else task_instances_suite()
    rule = next(r for r in suite.rules if r.kind == "in_set")
    rows = spark.createDataFrame([(s,) for s in (*states, "unheard_of", None)], "state string")
    (row,) = run_rules(rows, [rule], "s", "t").collect()
    assert (row.evaluated, row.failed) == (len(states) + 1, 1)
    assert QUERIES[name] and rows.where(F.col("state").isin(*rule.values)).count() == len(states)
