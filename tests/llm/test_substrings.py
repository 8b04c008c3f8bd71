from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest

from flowgauge.llm import substrings


def brute(rows, words):
    split = [(doc, (text or "").encode().split()) for doc, text in rows]
    counts = Counter(tuple(t[i : i + words]) for _, t in split for i in range(len(t) - words + 1))
    out = []
    for doc, t in split:
        gone = {i + k for i in range(len(t) - words + 1) if counts[tuple(t[i : i + words])] > 1 for k in range(words)}
        left = b" ".join(w for i, w in enumerate(t) if i not in gone)
        out.append((doc, len(t), len(gone), left.decode()))
    return sorted(out, key=repr)


def found(frame, **settings):
    return sorted(map(tuple, substrings.without_repeats(frame, **settings).collect()), key=repr)


@pytest.mark.parametrize("period", [p for p in substrings.COVERS])
def test_covers_have_every_difference(period):
    cover = substrings.COVERS[period]
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_anchors_are_long_enough():
    assert substrings.cover_for(35) == (21, (0, 1, 4, 14, 16))
    for words in range(1, 200):
        period, _ = substrings.cover_for(words)
        assert words - period + 1 >= 1


@pytest.mark.parametrize("words", [4, 12, 35])
def test_against_brute_force(docs, words, monkeypatch):
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 300)
    monkeypatch.setattr(substrings, "PART_BYTES", 1000)
    rng = random.Random(words)
    shared = [[f"s{k}w{i}" for i in range(words + extra)] for k, extra in enumerate((-1, 0, 1, 5, 40))]
    rows = []
    for doc in range(60):
        text = []
        for _ in range(rng.randrange(0, 5)):
            text += [f"d{doc}x{rng.random()}" for _ in range(rng.randrange(0, 30))]
            if rng.random() < 0.4:
                text += rng.choice(shared)
        rows.append((doc, rng.choice([" ", "\n", " \t"]).join(text)))
    rows += [rows[7], rows[9], (100, "x " * 100), (101, "y " * words), (102, "y " * (words + 1))]
    assert found(docs(*rows), words=words) == brute(rows, words)


def test_odd_rows(docs):
    passage = " ".join(f"p{i}" for i in range(36))
    rows = [
        (1, None), (2, ""), (3, " \n "), (4, "a b"), (4, "a b"), (5, passage), (5, passage), (None, f"q {passage} r"),
        (None, None), (6, " ".join(["z"] * 35)), (7, " ".join(["v"] * 36)), (8, "ä ö " * 34 + "ü"),
    ]
    assert found(docs(*rows)) == brute(rows, 35)
    assert found(docs()) == []
    assert found(docs((1, None))) == [(1, 0, 0, "")]


def test_long_texts_and_large_groups(docs):
    """A text of 400,000 words, two thousand copies, and a passage that half of the texts share."""
    rng = np.random.default_rng(1)
    long = " ".join(map(str, rng.integers(0, 1 << 60, 400_000)))
    passage = " ".join(f"p{i}" for i in range(50))
    rows = [(1, long), (2, " ".join(long.split()[1000:1100]))]
    rows += [(10 + i, "the same text " * 5) for i in range(2000)]
    rows += [(5000 + i, f"a{i} {passage} b{i}") for i in range(2000)]
    got = {r[0]: r for r in found(docs(*rows))}
    assert got[1][1:3] == (400_000, 100) and got[2] == (2, 100, 100, "")
    assert all(got[10 + i] == (10 + i, 15, 0, " ".join(["the same text"] * 5)) for i in range(2000))
    assert all(got[5000 + i] == (5000 + i, 52, 50, f"a{i} b{i}") for i in range(2000))


def test_hash_parts_do_not_show(docs, monkeypatch):
    rng = random.Random(9)
    rows = [(i, " ".join(str(rng.randrange(3)) for _ in range(120))) for i in range(30)] + [(99, "0 1 2 " * 60)]
    whole = found(docs(*rows), words=7)
    monkeypatch.setattr(substrings, "PART_BYTES", 10)
    assert found(docs(*rows), words=7) == whole == brute(rows, 7)
