from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from contract import fixtures
from flowgauge.quality import (
    MODEL_TESTS,
    Between,
    FreshWithin,
    InSet,
    NotNull,
    NullShare,
    PairOrder,
    RowCount,
    Unique,
    dag_runs_suite,
    run_model_tests,
    run_rules,
    run_standard_checks,
    run_suite,
    statistics,
    suite_dict,
    suite_from_rows,
    suite_rows,
    summarize,
    task_instances_suite,
)
from flowgauge.schemas import CHECK_RESULT

NOW = datetime(2024, 1, 6)
BEGIN = datetime(2024, 1, 1)


def check(df, *rules):
    result = run_rules(df, rules, "s", "t")
    assert [f.name for f in result.schema] == CHECK_RESULT.names
    assert [f.dataType for f in result.schema] == [f.dataType for f in CHECK_RESULT]
    return {r.check_name: r for r in result.collect()}


def only(df, rule):
    (row,) = check(df, rule).values()
    return row


def test_row_count(make_runs):
    runs = make_runs({}, {})
    assert only(runs, RowCount(min_rows=2)).passed
    row = only(runs, RowCount(min_rows=3))
    assert not row.passed and row.observed == 2 and row.threshold == 3
    assert only(runs.where("false"), RowCount()).passed


def test_null_share_and_empty_table(make_runs):
    runs = make_runs({"state": None}, {}, {}, {})
    row = only(runs, NullShare(column="state", max_share=0.2))
    assert not row.passed and (row.evaluated, row.failed, row.observed) == (4, 1, 0.25)
    assert row.message == "25.00% of rows are null, at most 20.00% allowed"
    assert only(runs, NullShare(column="state", max_share=0.25)).passed
    empty = only(runs.where("false"), NullShare(column="state", max_share=1.0))
    assert not empty.passed and empty.message == "table is empty"


def test_freshness(make_runs):
    runs = make_runs({"extracted_at": NOW - timedelta(hours=25)}, {"extracted_at": BEGIN})
    assert only(runs, FreshWithin(as_of=NOW)).passed
    late = only(runs, FreshWithin(as_of=NOW + timedelta(seconds=1)))
    assert not late.passed and late.observed > 25
    none = only(make_runs({"extracted_at": None}), FreshWithin(as_of=NOW))
    assert not none.passed and none.message == "no timestamp found" and none.error is None


def test_freshness_of_text(make_runs):
    text = make_runs({"extracted_at": NOW}).withColumn("at", F.col("extracted_at").cast("string"))
    assert only(text, FreshWithin(column="at", as_of=NOW)).passed
    row = only(text.withColumn("at", F.lit("soon")), FreshWithin(column="at", as_of=NOW))
    assert not row.passed and row.error == "newest value is no timestamp"


def test_missing_column_fails_alone(make_runs):
    rows = check(make_runs({}), NullShare(column="run_id"), RowCount(), Unique(column="nope"))
    assert rows["null_check_t_run_id"].error == "column not found: run_id"
    assert not rows["null_check_t_run_id"].passed and not rows["unique_t_nope"].passed
    assert rows["row_count_t"].passed
    assert not only(make_runs({}), NotNull(column="nope")).passed


def test_rule_of_the_wrong_type_fails_alone(make_runs):
    rows = check(
        make_runs({}),
        FreshWithin(column="duration", as_of=NOW),
        Between(column="extracted_at", min_value=0),
        NotNull(column="dag_id"),
    )
    assert rows["not_null_t_dag_id"].passed
    for name in ("freshness_check_t_duration", "between_t_extracted_at"):
        assert not rows[name].passed and "DATATYPE_MISMATCH" in rows[name].error


def test_text_columns_are_parsed(make_runs):
    text = make_runs({}, {}, {}).selectExpr(
        "explode(array(named_struct('n', '7', 'a', '2024-01-02', 'b', '2024-01-01 23:00:00'),"
        "named_struct('n', '-1', 'a', '2024-01-02', 'b', '2024-01-03'),"
        "named_struct('n', 'x', 'a', 'soon', 'b', '2024-01-01'),"
        "named_struct('n', null, 'a', null, 'b', '2024-01-01'))) as r"
    ).select("r.*")
    number = only(text, Between(column="n", min_value=0))
    assert (number.evaluated, number.failed) == (9, 6)
    pair = only(text, PairOrder(column="a", other="b"))
    assert (pair.evaluated, pair.failed) == (9, 6)


@pytest.mark.parametrize(
    "rule, evaluated, failed",
    [
        (NotNull(column="state"), 4, 1),
        (InSet(column="state", values=("success", "none")), 3, 1),
        (Between(column="duration", min_value=0), 3, 1),
        (Between(column="duration", min_value=0, max_value=10), 3, 2),
        (Between(column="duration"), 3, 0),
        (PairOrder(column="end_date", other="start_date"), 2, 1),
        (PairOrder(column="end_date", other="start_date", or_equal=False), 2, 2),
        (Unique(column="state"), 3, 1),
    ],
)
def test_value_rules(make_runs, rule, evaluated, failed):
    runs = make_runs(
        {"state": "success", "duration": -1.0, "start_date": BEGIN, "end_date": BEGIN},
        {"state": "success", "duration": 11.0, "start_date": NOW, "end_date": BEGIN},
        {"state": "bogus", "duration": 0.0, "start_date": BEGIN},
        {"state": None},
    )
    row = only(runs, rule)
    assert (row.evaluated, row.failed, row.passed) == (evaluated, failed, failed == 0)


def test_mostly(make_runs):
    runs = make_runs(*[{"state": None}] + [{}] * 9)
    assert only(runs, NotNull(column="state", mostly=0.9)).passed
    assert not only(runs, NotNull(column="state", mostly=0.91)).passed


def test_nothing_to_evaluate_passes(make_runs):
    empty = make_runs({}).where("false")
    assert only(empty, NotNull(column="state")).passed
    assert only(make_runs({"duration": None}), Between(column="duration", min_value=0)).passed
    assert only(empty, Unique(column="dag_id")).passed


def test_planted_faults_are_counted(spark):
    """Counts known from the derivation at this scale."""
    dirty = fixtures.dirty_rows(spark, "/root/testdata/sf0.01")
    rows = check(
        dirty,
        NotNull(column="dag_id"),
        InSet(column="state", values=("success", "failed", "running")),
        Between(column="duration", min_value=0),
        PairOrder(column="end_date", other="start_date"),
        Between(column="try_number", min_value=1),
    )
    assert {(r.column_name, r.evaluated, r.failed) for r in rows.values()} == {
        ("dag_id", 10000, 104),
        ("state", 9881, 113),
        ("duration", 8019, 98),
        ("end_date, start_date", 8019, 98),
        ("try_number", 10000, 141),
    }


def test_standard_battery(spark, make_runs, make_tasks):
    tables = {"dag_runs": make_runs({}), "task_instances": make_tasks({"task_id": None})}
    results = run_standard_checks(spark, tables, NOW)
    failed = [r.check_name for r in results.where("not passed").collect()]
    assert results.count() == 8 and failed == ["null_check_task_instances_task_id"]
    assert tuple(summarize(results).first()) == (False, 7, 8)


def test_missing_table_stops_the_battery(spark, make_runs):
    results = run_standard_checks(spark, {"dag_runs": make_runs({}), "task_instances": None}, NOW)
    (row,) = results.collect()
    assert row.table_name == "task_instances" and row.error == "required table is missing"
    assert tuple(summarize(results).first()) == (False, 0, 1)


def test_suites_have_the_documented_rules(make_runs, make_tasks):
    assert [r.kind for r in dag_runs_suite().rules] == [
        "not_null", "not_null", "in_set", "between", "pair_order",
    ]
    assert len(task_instances_suite().rules) == 7
    assert run_suite(make_runs({}), dag_runs_suite()).where("not passed").count() == 0
    bad = make_tasks({"try_number": 0, "state": "restarting"})
    failed = run_suite(bad, task_instances_suite()).where("not passed").collect()
    assert [r.column_name for r in failed] == ["try_number"]


def test_suite_survives_a_table(spark):
    from flowgauge.quality.suites import RULES_TABLE

    for suite in (dag_runs_suite(), task_instances_suite()):
        stored = spark.createDataFrame(suite_rows(suite), RULES_TABLE)
        assert suite_from_rows(stored.repartition(3).collect()) == suite
        assert suite_from_rows(suite_rows(suite)) == suite


def test_suite_as_plain_data():
    import json

    plain = json.loads(json.dumps(suite_dict(task_instances_suite())))
    assert plain["suite"] == "task_instances_suite" and len(plain["rules"]) == 7
    tries = next(rule for rule in plain["rules"] if rule["column"] == "try_number")
    assert tries["kind"] == "between" and tries["min_value"] == 1 and tries["mostly"] == 1.0
    assert tries["note"]


def test_statistics(make_runs):
    results = run_suite(make_runs({"dag_id": None, "duration": -1.0}), dag_runs_suite())
    assert tuple(statistics(results).first()) == ("dag_runs_suite", False, 5, 3, 2, 60.0)


def test_declared_tests(spark, make_runs):
    assert sum(len(rules) for rules in MODEL_TESTS.values()) == 27
    runs = make_runs({}, {})
    results = run_model_tests({"dag_runs": runs, "other": runs})
    assert results.count() == 2 and results.where("not passed").count() == 0
