"""Thresholds with a time of validity, against a plain walk over all of them."""

import random
from datetime import datetime, timedelta

import pytest

from flowgauge.operators.asof import join_thresholds_asof
from tests.conftest import final_plan

T = datetime(2024, 1, 1)
LEVELS = "dag_id string, task_id string, valid_from timestamp_ntz, valid_to timestamp_ntz, sla_threshold_seconds int"


def hours(h):
    return None if h is None else T + timedelta(hours=h)


def levels(spark, *rows):
    return spark.createDataFrame([(d, t, hours(a), hours(b), s) for d, t, a, b, s in rows], LEVELS)


def walk(task, known):
    """The latest level not after the run, the strictest of equal ones, while it holds."""
    dag, name, moment = task
    if None in (dag, name, moment):
        return None
    before = [(a, -s, b) for d, t, a, b, s in known if (d, t) == (dag, name) and a is not None and hours(a) <= moment]
    if not before:
        return None
    start, least, until = max(before, key=lambda x: (x[0], x[1]))
    return None if until is not None and moment >= hours(until) else -least


def test_against_a_plain_walk(spark, make_tasks):
    rng = random.Random(1)
    for width in (3600, 86_400, 10**9):
        known, seen = [], set()
        for _ in range(120):
            key = (rng.choice("ab"), rng.choice(["t", "u", None]), rng.choice([None, *range(0, 100, 3)]))
            if key not in seen or rng.random() < 0.3:
                end = None if rng.random() < 0.5 or key[2] is None else key[2] + rng.randrange(1, 40)
                known.append((*key, end, rng.randrange(1, 10**6)))
            seen.add(key)
        tasks = [
            {"dag_id": rng.choice(["a", "b", "c", None]), "task_id": rng.choice(["t", "u", None]), "execution_date": hours(rng.choice([None, -5, *range(0, 120)])), "try_number": i}
            for i in range(300)
        ]
        frame = make_tasks(*tasks)
        got = join_thresholds_asof(frame, levels(spark, *known), "left", stretch_seconds=width).collect()
        assert len(got) == 300 and got[0].asDict().keys() == {*frame.columns, "sla_threshold_seconds"}
        wanted = {i: walk((t["dag_id"], t["task_id"], t["execution_date"]), known) for i, t in enumerate(tasks)}
        assert {r.try_number: r.sla_threshold_seconds for r in got} == wanted
        inner = join_thresholds_asof(frame, levels(spark, *known), stretch_seconds=width).collect()
        assert {r.try_number for r in inner} == {i for i, s in wanted.items() if s is not None}


def test_edges(spark, make_tasks):
    tasks = make_tasks({"execution_date": hours(5)}, {"execution_date": hours(5)})
    # From its first moment on, until just before its last; nothing before, nothing without levels.
    for level, wanted in (((5, None), 60), ((5, 6), 60), ((4, 5), None), ((6, None), None), ((-99999, None), 60)):
        got = join_thresholds_asof(tasks, levels(spark, ("a", "t", *level, 60)), "left").collect()
        assert [r.sla_threshold_seconds for r in got] == [wanted] * 2
    assert join_thresholds_asof(tasks, levels(spark)).count() == 0
    assert join_thresholds_asof(tasks, levels(spark), "left").count() == 2
    assert join_thresholds_asof(tasks.limit(0), levels(spark, ("a", "t", 0, None, 60))).count() == 0
    # A level that ends is not followed by the one before it.
    two = levels(spark, ("a", "t", 1, None, 60), ("a", "t", 2, 3, 70))
    assert join_thresholds_asof(tasks, two).count() == 0
    with pytest.raises(ValueError):
        join_thresholds_asof(tasks, two, "right")


def test_plan_sorts_streams_and_pairs_nothing(spark, make_tasks):
    tasks = make_tasks(*[{"execution_date": hours(h)} for h in range(200)])
    plan = final_plan(join_thresholds_asof(tasks, levels(spark, ("a", "t", 0, None, 60))))
    assert "Join" not in plan and "Cartesian" not in plan and "SinglePartition" not in plan
    # A hot task is hashed by stretch as well as by name.
    assert "hashpartitioning(dag_id" in plan and "stretch" in plan[plan.index("hashpartitioning(dag_id") :][:80]
