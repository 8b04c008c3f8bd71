from __future__ import annotations

import random

from flowgauge.llm import line_dedup


def brute(rows, least):
    """A line goes if it lies in a passage of ``least`` words or more that came earlier and does not overlap it."""
    texts = [(doc, text.split("\n")) for doc, text in sorted(rows) if text is not None]
    seen, gone = {}, {}
    for pass_ in (0, 1):
        for doc, lines in texts:
            for i in range(len(lines)):
                words, body = 0, []
                for j in range(i, len(lines)):
                    n = len(lines[j].split())
                    if n == 0 and (j == i):
                        break
                    words += n
                    if n:
                        body.append(lines[j])
                    if n and words >= least:
                        key = tuple(body)
                        if pass_ == 0:
                            seen.setdefault(key, (doc, i, j))
                        elif (first := seen[key]) and (first[0] != doc or i > first[2]) and first < (doc, i, j):
                            gone.setdefault(doc, set()).update(range(i, j + 1))
    return {doc: "\n".join(x for i, x in enumerate(lines) if i not in gone.get(doc, ())) for doc, lines in texts}


def test_against_brute_force(docs):
    rng = random.Random(3)
    for trial in range(3):
        lines = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randrange(0, 7))) for _ in range(12)]
        rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(0, 14)))) for i in range(12)]
        rows += [(50 + k, r[1]) for k, r in enumerate(rows[:3])]
        found = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs(*rows), min_words=10).collect()}
        assert found == brute(rows, 10)


def test_edges(docs):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, f"a\n{long}\nb"), (5, f"c\n\n{long}\nd"), (6, long), (6, long),
        (7, f"{long}\n{long}"), (8, "short line\nshort line"), (9, "x\n" * 200),
    ]
    out = line_dedup.dedup_lines(docs(*rows), removed="gone").collect()
    found = sorted(((r.doc_id, r.text, r.gone) for r in out), key=str)
    # The 200 equal lines repeat without overlap from the 51st on.
    assert found == sorted(
        [
            (1, None, 0), (2, "", 0), (3, "\n\n", 0), (4, f"a\n{long}\nb", 0), (5, "c\n\nd", 1), (6, "", 1), (6, "", 1),
            (7, "", 2), (8, "short line\nshort line", 0), (9, "x\n" * 50, 150),
        ],
        key=str,
    )
    assert all(r["size"] == 1 and r.mark == 2.0 for r in out)


def test_no_rows_and_null_ids(docs):
    assert line_dedup.dedup_lines(docs()).count() == 0
    long = " ".join("abcdefghij" for _ in range(55))
    out = line_dedup.dedup_lines(docs((None, f"p\n{long}"), (3, f"{long}\nq"))).collect()
    assert sorted((r.text for r in out), key=len) == ["q", f"p\n{long}"]


def test_plan_is_native(docs):
    plan = line_dedup.dedup_lines(docs((1, "a")))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_texts_are_not_hashed_once_a_line(docs):
    """The hash of the whole text lies below the step that cuts it into lines."""
    plan = line_dedup._windows(docs((1, "a\nb")), "doc_id", "text", 50)._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate posexplode")]
    assert "xxhash64(text" not in above and "xxhash64(text" in plan


def test_very_long_texts(docs):
    lines = [f"line number {i} of a text" for i in range(40_000)]
    out = line_dedup.dedup_lines(docs((1, "\n".join(lines)), (2, "\n".join(["x", *lines[:20_000], "y"]))), removed="gone").collect()
    assert {(r.doc_id, r.gone, len(r.text)) for r in out} == {(1, 0, len("\n".join(lines))), (2, 20_000, 3)}


def test_only_windows_around_shared_minima_are_compared(docs):
    """Equal windows select the same line; a window whose minimum lies nowhere else is left out."""
    shared = [f"shared line {i}" for i in range(8)]
    rows = [(k, "\n".join([f"own {k} line {i}" for i in range(30)] + shared + [f"more {k} of {i}" for i in range(30)])) for k in range(4)]
    windows = line_dedup._windows(docs(*rows), "doc_id", "text", 12)
    of_content = {}
    for w in windows.collect():
        of_content.setdefault(w.content, set()).add((w.low, w.at - w.start))
    assert all(len(selected) == 1 for selected in of_content.values())
    left = line_dedup._around_shared(windows).collect()
    assert 4 * 5 <= len(left) < windows.count() / 2
    assert {w["at"] for w in left} <= set(range(30, 38))
    inside = {tuple(w) for w in windows.collect() if 30 <= w.start and w.end < 38}
    assert len(inside) == 4 * 5 and inside <= {tuple(w[c] for c in windows.columns) for w in left}
