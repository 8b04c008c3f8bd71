from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from flowgauge.llm import periodic, queries


def brute(words, min_length=6, exponent=4):
    """For every period, the longest stretches that keep it; the smallest period of a stretch counts."""
    n, found = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(min_length, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = max(j, i) + 1
    return sorted((a, n, q) for (a, n), q in found.items())


def shortened(words, runs):
    gone = {i for a, n, q in runs for i in range(a + q, a + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    words = []
    while len(words) < rng.randrange(0, 90):
        part = [rng.choice("abc") for _ in range(rng.randrange(1, 8))]
        words += part * rng.choice([1, 1, 2, 3, 4, 5, 9]) + part[: rng.randrange(0, len(part) + 1)]
    return words


def test_runs_against_brute_force():
    rng = random.Random(5)
    for trial in range(300):
        texts = [random_words(rng) for _ in range(rng.randrange(1, 6))]
        least, exponent = rng.choice([(6, 4), (6, 4), (2, 2), (9, 3), (1, 4), (20, 4)])
        runs = periodic.runs_of([[w.encode() for w in t] for t in texts], least, exponent)
        assert [[tuple(r) for r in x.tolist()] for x in runs] == [brute(t, least, exponent) for t in texts]


def test_sorted_suffixes():
    rng = random.Random(6)
    for least in (1, 4, 5, 6):
        keys = [rng.randrange(3) for _ in range(200)] + [99]
        order, shared = periodic.sorted_suffixes(np.array(keys), least)
        assert sorted(order, key=lambda i: keys[i:]) == order.tolist()

        def common(i, j):
            return next(k for k in range(200) if keys[i + k] != keys[j + k])

        whole = sorted(range(201), key=lambda i: keys[i:])
        near = {i for i, j in zip(whole, whole[1:]) if common(i, j) >= least} | {j for i, j in zip(whole, whole[1:]) if common(i, j) >= least}
        assert near <= set(order.tolist())
        wanted = [0] + [x if (x := common(i, j)) >= least else 0 for i, j in zip(order.tolist(), order[1:].tolist())]
        assert shared.tolist() == wanted


def test_long_and_hostile_texts():
    for words in (["x"] * 100_000, ["x", "y"] * 50_000, (["x"] * 6 + ["y"]) * 15_000):
        (runs,) = periodic.runs_of([[w.encode() for w in words]])
        assert [0, 100_000, 1] in runs.tolist() or [0, 100_000, 2] in runs.tolist() or [0, 105_000, 7] in runs.tolist()
    # Many runs of one word, each between words of their own.
    words = [w for i in range(20_000) for w in (*["x"] * 6, f"y{i}")]
    (runs,) = periodic.runs_of([[w.encode() for w in words]])
    assert runs.tolist() == [[7 * i, 6, 1] for i in range(20_000)]


def test_operator_on_odd_rows(docs, monkeypatch):
    monkeypatch.setattr(periodic, "BLOCK_WORDS", 40)
    rng = random.Random(7)
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a a a a a a"), (4, "a a a a a a"), (None, "b " * 9), (5, "ä ä ä ä ä ä ")]
    rows += [(10 + i, "  ".join(random_words(rng))) for i in range(40)]
    got = periodic.periodic_runs(docs(*rows)).collect()
    wanted = []
    for doc, text in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        runs = brute(words)
        wanted.append((doc, runs, shortened(words, runs)))
    found = [(r.doc_id, [tuple(x) for x in r.runs], r.collapsed) for r in got]
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert periodic.periodic_runs(docs()).count() == 0
    with pytest.raises(ValueError):
        periodic.periodic_runs(docs(), exponent=1)


def planted(doc, text):
    words = [w.decode() for w in (text or "").encode().split()]
    h, n = zlib.crc32(str(doc).encode()), len(words)
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return words


def test_query_against_brute_force(spark, table):
    """The whole of the small table, texts of up to 3,000 words in the quadratic check."""
    texts = {r.doc_id: r.text for r in table("documents").collect()}
    found = queries.op11_periodic_runs(spark, "/root/testdata/sf0.001").collect()
    assert len(found) == len(texts)
    with_runs = 0
    for row in found:
        words = planted(row.doc_id, texts[row.doc_id])
        if len(words) > 3000:
            continue
        runs = brute(words)
        with_runs += bool(runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
        assert row.n_runs == len(runs)
        assert (row.start, row.length, row.period) == (best or (None,) * 3)
        assert row.exponent_milli == (1000 * best[1] // best[2] if best else None)
        listed = "".join(f"{a},{n},{q}\n" for a, n, q in runs)
        assert row.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(shortened(words, runs).encode()).hexdigest()
    assert with_runs > 10
