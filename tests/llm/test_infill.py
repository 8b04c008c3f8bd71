from __future__ import annotations

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from flowgauge.llm import infill

UNITS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(doc, text, seed=42):
    text = text or ""
    units = UNITS.findall(text)
    n, h = len(units), hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(h[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return n, "plain", None, None, text
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def random_text(rng):
    pieces = ["word", "ä", "日本", "😀x", " ", "  ", "\n", "\t", "\x0b", " ", "<", "P>", "a<b"]
    return "".join(rng.choice(pieces) for _ in range(rng.randrange(0, 200)))


def test_units_and_places():
    rng = random.Random(1)
    for _ in range(200):
        text = random_text(rng)
        units = UNITS.findall(text)
        assert "".join(units) == text
        ends = infill.unit_ends(text)
        assert ends.tolist() == np.cumsum([len(u) for u in units]).tolist()
        lanes = infill.SkipList(np.diff(ends, prepend=0))
        assert [lanes.place(k) for k in range(len(units) + 1)] == [0, *ends.tolist()]


def test_slices_do_not_show(monkeypatch):
    monkeypatch.setattr(infill, "SLICE", 7)
    rng = random.Random(2)
    for _ in range(100):
        text = random_text(rng)
        assert infill.unit_ends(text).tolist() == np.cumsum([len(u) for u in UNITS.findall(text)]).tolist()


def test_lanes_widen():
    lanes = infill.SkipList(np.full(1000, 3)).lanes
    assert [len(units) for units, _ in lanes] == [1000, 125, 16, 2]
    assert all(units.sum() == 1000 and points.sum() == 3000 for units, points in lanes)


def test_against_brute_force(docs):
    rng = random.Random(3)
    texts = [None, "", " ", "\n\t", "one", " one", "one ", "has <P> in it", "a<M>", "<S>", "word " * 200_000]
    rows = list(enumerate(texts + [random_text(rng) for _ in range(150)]))
    rows += [rows[20], rows[20], (None, "a null id"), (None, None)]
    frame = docs(*rows)
    found = infill.fill_in_middle(frame)
    assert found.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    got = found.withColumn("again", infill.restored(F.col("output"), F.col("form"))).collect()
    wanted = [(doc, *brute(doc, text), text or "") for doc, text in rows]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_no_rows_and_other_shares(docs):
    assert infill.fill_in_middle(docs()).count() == 0
    all_of_them = infill.fill_in_middle(docs(*[(i, "a b c") for i in range(30)]), percent=100, suffix_first=0)
    assert {r.form for r in all_of_them.collect()} == {"psm"}
    assert "Exchange" not in all_of_them._jdf.queryExecution().executedPlan().toString()
