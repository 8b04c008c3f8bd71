"""What broke a rule, and which rows: from the scan that judges it."""

import json
from collections import Counter

import pytest

from flowgauge.quality import Between, InSet, NotNull, PairOrder
from flowgauge.quality.evidence import evidence
from tests.conftest import final_plan
from tests.test_plans import scans, shuffles, stored  # noqa: F401

RULES = [
    NotNull(column="dag_id"),
    InSet(column="state", values=("success",)),
    Between(column="try_number", min_value=2),
    PairOrder(column="end_date", other="start_date"),
]
KEY = ["dag_id", "execution_date", "try_number"]


def rows_of(make_tasks, n=200):
    states = ["success", "failed", "running", None, "bogus"]
    return make_tasks(
        *[{"dag_id": f"d{i % 7}" if i % 5 else None, "state": states[i % 11 % 5], "try_number": i} for i in range(n)]
    )


def test_values_and_examples(make_tasks):
    frame = rows_of(make_tasks)
    found = {r.check_type: r for r in evidence(frame, RULES, "s", "t", KEY).collect()}
    plain = frame.collect()
    bad = [r for r in plain if r.state not in ("success", None)]
    assert found["in_set"].failed == len(bad)
    wanted = sorted(Counter(r.state for r in bad).items(), key=lambda x: (-x[1], x[0]))
    assert [tuple(x) for x in found["in_set"].top_values] == wanted
    assert [tuple(x) for x in found["not_null"].top_values] == [("null", 40)]
    assert [tuple(x) for x in found["between"].top_values] == [("0", 1), ("1", 1)]
    assert found["pair_order"].failed == 0 and found["pair_order"].top_values == [] == found["pair_order"].examples
    # Examples are keys of rows that broke the rule.
    keys = {(r.dag_id, r.try_number) for r in bad}
    shown = [json.loads(x) for x in found["in_set"].examples]
    assert 1 <= len(shown) <= 5 and all((x.get("dag_id"), x["try_number"]) in keys for x in shown)
    assert len({x["try_number"] for x in shown}) == len(shown)
    assert {json.loads(x)["try_number"] for x in found["between"].examples} <= {0, 1}


def test_reruns_agree_and_the_seed_counts(make_tasks):
    frame = rows_of(make_tasks)
    first = evidence(frame, RULES, "s", "t", KEY).collect()
    assert first == evidence(frame.repartition(13), RULES, "s", "t", KEY).collect()
    other = evidence(frame, RULES, "s", "t", KEY, seed=1).collect()
    assert [r.top_values for r in first] == [r.top_values for r in other]
    assert first[1].examples != other[1].examples


@pytest.mark.parametrize("n", [0, 1])
def test_few_rows(make_tasks, n):
    frame = rows_of(make_tasks, 2).limit(n)
    found = evidence(frame, RULES, "s", "t", KEY, examples=1).collect()
    assert [r.failed for r in found] == ([0] * 4 if n == 0 else [1, 0, 1, 0])
    assert [len(r.examples) for r in found] == [r.failed for r in found]


def test_frequent_values_within_their_error(spark, make_tasks):
    """Ten thousand different bad values, some of them frequent: these are found, within the bound."""
    frame = spark.range(60_000).selectExpr(
        "id as k", "if(id % 4 = 0, concat('hot', id % 3), concat('v', id % 10007)) as state"
    )
    (found,) = evidence(frame, [InSet(column="state", values=("ok",))], "s", "t", ["k"]).collect()
    assert found.failed == 60_000 and found.count_error == 205
    best = {x["value"]: x["rows"] for x in found.top_values}
    for name in ("hot0", "hot1", "hot2"):
        assert abs(best[name] - 5000) <= found.count_error


def test_one_scan(stored):  # noqa: F811
    plan = final_plan(evidence(stored[1], RULES, "s", "t", KEY))
    assert scans(plan) == 1 and shuffles(plan) == 1
