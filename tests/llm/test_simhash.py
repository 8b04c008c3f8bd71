from __future__ import annotations

import random

import pytest
import xxhash

from flowgauge.llm import simhash


def plain_mark(text, words=3):
    found = (text or "").encode().lower().split()
    if not found:
        return 0
    parts = [b" ".join(found[i : i + words]) for i in range(max(1, len(found) - words + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(rows, bits=2):
    marks = [plain_mark(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (marks[i] ^ marks[j]).bit_count() <= bits:
                a, b = top(i), top(j)
                group[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return [(doc, f"{marks[i]:016x}", least[top(i)]) for i, (doc, _) in enumerate(rows)]


def test_given_documents(spark, table):
    df = table("documents")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    assert sorted(map(tuple, simhash.simhash_groups(df).collect())) == sorted(plain_groups(rows))


def test_edges(docs):
    rows = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "one two"), (6, "one two"), (7, "ÀB c d"),
        (8, "w " * 70_000), (9, "W " * 70_001), (10, "a\x0bb\x1cc d"),
    ]
    assert sorted(map(tuple, simhash.simhash_groups(docs(*rows)).collect())) == sorted(plain_groups(rows))


def test_empty_table(docs):
    assert simhash.simhash_groups(docs()).count() == 0


@pytest.mark.parametrize(("bits", "length"), [(1, None), (2, None), (3, None), (6, None), (6, 3)])
def test_pairs_equal_brute_force(spark, bits, length):
    rng = random.Random(bits)
    base = [rng.getrandbits(64) for _ in range(40)]
    marks = set(base)
    for b in base * 6:
        for _ in range(rng.randrange(9)):
            b ^= 1 << rng.randrange(64)
        marks.add(b)
    marks = sorted(m - (1 << 64 if m >> 63 else 0) for m in marks)
    found = simhash.close_pairs(spark.createDataFrame([(m,) for m in marks], "fingerprint long"), bits, length=length)
    want = {(a, b) for a in marks for b in marks if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
    assert {tuple(r) for r in found.collect()} == want


def test_crowded_keys_link_the_same_groups(spark, monkeypatch):
    from flowgauge.llm.graph import components
    from tests.llm.test_graph import brute

    monkeypatch.setattr(simhash, "HOT_KEY", 20)
    rng = random.Random(9)
    marks = {0}
    while len(marks) < 300:
        m = rng.choice(sorted(marks))
        for _ in range(rng.choice([1, 2, 2, 5])):
            m ^= 1 << rng.randrange(64)
        marks.add(m)
    marks = sorted(m - (1 << 64 if m >> 63 else 0) for m in marks)
    frame = spark.createDataFrame([(m,) for m in marks], "fingerprint long")
    want = brute([(a, b) for a in marks for b in marks if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= 2])
    found = {r.node: r.component for r in components(simhash.close_pairs(frame, 2)).collect()}
    assert found == want


def kept_by_brute_force(rows, bits=2):
    """Per group of near fingerprints the smallest id, found by comparing all of them."""
    marks = sorted({(d is None, d, plain_mark(t)) for d, t in rows}, key=lambda r: (r[0], r[1] or 0, r[2]))
    left, kept = list(marks), []
    while left:
        group, front = [left[0]], [left[0]]
        rest = left[1:]
        while front:
            x = front.pop()
            near = [y for y in rest if ((x[2] ^ y[2]) & (2**64 - 1)).bit_count() <= bits]
            rest = [y for y in rest if y not in near]
            group += near
            front += near
        kept.append(min(group)[1])
        left = rest
    return sorted(kept, key=str)


def test_near_duplicates_stay_once(docs):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(500)]
    rows = []
    for group in range(12):
        base = [rng.choice(words) for _ in range(400)]
        for i in range(rng.randrange(1, 6)):
            text = list(base)
            text[rng.randrange(400)] = rng.choice(words)
            rows.append((100 * i + group, " ".join(text)))
    rows += [(5000, None), (5001, ""), (5002, " \n"), (0, rows[0][1]), (None, rows[0][1].upper()), (None, "a null id alone")]
    kept = simhash.drop_near_duplicates(docs(*rows)).collect()
    assert sorted((r.doc_id for r in kept), key=str) == kept_by_brute_force(rows)
    assert {5001, 5002} & {r.doc_id for r in kept} == set() and len(kept) < len(rows)
    assert all(r["size"] == 1 and r.node is None or r.node == "x" and r.mark == 2.0 for r in kept)


def test_stage_keeps_one_of_each_group_of_the_operator(spark, table):
    groups = simhash.simhash_groups(table("documents")).collect()
    kept = simhash.drop_near_duplicates(table("documents")).collect()
    assert sorted(r.doc_id for r in kept) == sorted({r.component_id for r in groups})


def test_a_large_group_of_copies(docs):
    rows = [(i, "the same words over and over again") for i in range(3000)] + [(9000, "other words here")]
    assert sorted(r.doc_id for r in simhash.drop_near_duplicates(docs(*rows)).collect()) == [0, 9000]


def test_near_duplicates_of_nothing(docs):
    assert simhash.drop_near_duplicates(docs()).count() == 0


def test_texts_are_shuffled_once(docs):
    plan = simhash.drop_near_duplicates(docs((1, "a b c"), (2, "d"))).select("doc_id", "text")
    found = plan._jdf.queryExecution().executedPlan().toString()
    assert found.count("Exchange hashpartitioning(own_unnamed") <= 2
