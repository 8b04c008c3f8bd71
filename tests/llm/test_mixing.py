from __future__ import annotations

import math
import random

import pytest

from flowgauge.llm import mixing


def level(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), share * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        full = {s for s in open_ if left * weight[s] / total > most * sizes[s]}
        if not full:
            return target | {s: left * weight[s] / total for s in open_}
        for s in full:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_targets_and_words_taken(docs):
    rng = random.Random(1)
    rows = [(i, "w " * rng.randrange(0, 60), None, rng.choice(["a", "b", "c", "dé", "\U0001f600", "￿", None])) for i in range(400)]
    rows += [(1000, None, None, "empty"), (1001, "", None, "empty"), (1007, "x y z", None, "a"), (1007, "x y z", None, "a"), (1007, "x", None, "a")]
    plan = mixing.mixing_plan(docs(*rows)).collect()
    source_of = {}
    sizes = {}
    for doc, text, _, source in rows:
        sizes[source] = sizes.get(source, 0) + len((text or "").split())
        source_of[doc] = source
    want = level(sizes)
    taken = {}
    assert len(plan) == len(rows)
    for r in plan:
        assert r.target == pytest.approx(want[source_of[r.doc_id]]) and r.source_size == sizes[source_of[r.doc_id]]
        assert 0 <= r.taken <= 2 * r["size"]
        taken[source_of[r.doc_id]] = taken.get(source_of[r.doc_id], 0) + r.taken
    assert all(taken[s] == math.floor(want[s] + 1e-9) for s in want)


def test_reruns_agree_whatever_the_partitions(docs):
    rows = [(i, "a b c " * (i % 7), None, f"s{i % 5}") for i in range(200)]
    one = mixing.mixing_plan(docs(*rows)).collect()
    two = mixing.mixing_plan(docs(*rows[::-1]).repartition(7)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_mix_has_whole_texts_near_the_targets(docs):
    rows = [(i, "w " * (1 + i % 9), None, f"s{i % 4}") for i in range(600)]
    df = docs(*rows)
    mix = mixing.mixed(df).collect()
    assert mix[0].asDict().keys() == set(df.columns)
    want = level({f"s{k}": sum(1 + i % 9 for i in range(600) if i % 4 == k) for k in range(4)})
    for k in range(4):
        words = sum(len(r.text.split()) for r in mix if r.source == f"s{k}")
        assert abs(words - want[f"s{k}"]) <= 9
    text = dict((r[0], r[1]) for r in rows)
    assert all(r.text == text[r.doc_id] for r in mix)


def test_nothing_to_mix(docs):
    assert mixing.mixing_plan(docs()).count() == 0
    assert mixing.mixed(docs()).count() == 0
    assert [r.taken for r in mixing.mixing_plan(docs((1, None), (2, ""))).collect()] == [0, 0]
    assert mixing.mixed(docs((1, None), (2, ""))).count() == 0


def test_more_than_all_there_is(docs):
    plan = mixing.mixing_plan(docs((1, "a b", None, "x"), (2, "c", None, "y")), share=9.0).collect()
    assert sorted((r.doc_id, r.taken) for r in plan) == [(1, 4), (2, 2)]


def test_the_stream_is_sorted_by_range_and_cut_at_the_budget(spark, docs):
    """The cut that is found over many ranges is that of one sorted list."""
    rng = random.Random(4)
    entries = [(rng.randrange(40) / 8.0, rng.random() < 0.2, rng.randrange(1, 9)) for _ in range(300)]
    stream = spark.createDataFrame([((f, b), w) for f, b, w in entries], "at struct<finish double, beyond boolean>, words long")
    for budget in (0, 1, 40, 400, 700, 10_000):
        kept, upto = None, 0
        for at in sorted({(f, b) for f, b, _ in entries}):
            upto += sum(w for f, b, w in entries if (f, b) == at)
            kept = at if upto <= budget else kept
        found = mixing._cut_at(stream.repartition(5), spark.createDataFrame([(budget,)], "budget long")).collect()
        assert [tuple(r["at"]) if r["at"] else None for r in found] == [kept]
    queues = mixing._queues(docs(*[(i, "a b", None, f"s{i % 3}") for i in range(50)]), [], "doc_id", "text", "source", (1,), 1.0, 2, "x")
    ranged = queues.select(mixing.F.inline(mixing._entries(2))).repartitionByRange("at")
    assert "rangepartitioning" in ranged._jdf.queryExecution().executedPlan().toString()
