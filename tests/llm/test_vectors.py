from __future__ import annotations

import numpy as np
import pytest

from flowgauge.llm import forest, itq
from tests.llm.test_graph import brute


def good(v):
    return v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def links(rows, least=0.95):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if good(v)]
    x = np.array([v / np.linalg.norm(v) for _, v in use])
    near = x @ x.T >= least
    np.fill_diagonal(near, False)
    ids = [i for i, _ in use]
    edges = [(ids[a], ids[b]) for a, b in zip(*np.nonzero(near))]
    return dict(zip(ids, near.sum(1))), brute(edges)


def crowd(rng, n, dims=64, noise=0.02, groups=1):
    rows = []
    for _ in range(groups):
        centre = rng.standard_normal(dims)
        centre /= np.linalg.norm(centre)
        rows += [(centre + noise * rng.standard_normal(dims)).tolist() for _ in range(n)]
    return rows


ODD = [None, [], [0.0] * 64, [None] + [1.0] * 63, [float("nan")] + [1.0] * 63, [float("inf")] + [1.0] * 63]


def test_links_of_pairs_and_copies(vectors):
    rng = np.random.default_rng(0)
    plain = [rng.standard_normal(64).tolist() for _ in range(400)]
    near = [(np.array(v) + 0.15 * rng.standard_normal(64)).tolist() for v in plain[:60]]
    rows = list(enumerate(plain + near + plain[:5] + plain[:2] + ODD + [[2 * x for x in plain[9]]]))
    rows = [(int(i) * 3, v) for i, v in rows]
    found = {r.vec_id: r for r in itq.near_vectors(vectors(*rows)).collect()}
    counts, groups = links(rows)
    assert len(found) == len(rows)
    total = sum(counts.values())
    assert sum(r.n_links for r in found.values()) >= 0.95 * total
    for i, r in found.items():
        assert r.n_links <= counts.get(i, 0)
        assert r.kept == (r.component_id == i)
        if r.n_links == counts.get(i, 0):
            assert r.component_id == groups.get(i, i) or r.n_links < total
    for i, v in rows:
        if not good(v):
            assert (found[i].n_links, found[i].component_id, found[i].kept) == (0, i, True)


@pytest.mark.parametrize("noise", [0.01, 0.03])
def test_crowds_are_counted_in_blocks(vectors, monkeypatch, noise):
    monkeypatch.setattr(itq, "HOT_KEY", 20)
    monkeypatch.setattr(itq, "BLOCK", 30)
    rng = np.random.default_rng(1)
    rows = list(enumerate(crowd(rng, 150, noise=noise, groups=2) + crowd(rng, 1, noise=1, groups=100)))
    found = {r.vec_id: r for r in itq.near_vectors(vectors(*rows)).collect()}
    counts, groups = links(rows)
    for i, r in found.items():
        assert r.n_links <= counts[i]
        assert r.component_id == groups.get(i, i)
    assert sum(r.n_links for r in found.values()) >= 0.98 * sum(counts.values())


def test_few_dimensions_and_nothing(vectors):
    rows = [(1, [1.0, 0.0]), (2, [1.0, 0.01]), (3, [0.0, 1.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0, 0.0])]
    got = {r.vec_id: (r.n_links, r.component_id) for r in itq.near_vectors(vectors(*rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (0, 3), 4: (0, 4), 5: (2, 1)}
    assert itq.near_vectors(vectors()).count() == 0
    assert [tuple(r) for r in itq.near_vectors(vectors((7, None))).collect()] == [(7, 0, 7, True)]


def exact(rows, asked, k):
    use = [(i, np.array(v, np.float32).astype(float)) for i, v in rows if good(v)]
    ids, x = np.array([i for i, _ in use]), np.array([v for _, v in use])
    out = {}
    for q, v in use:
        if asked(q):
            d = np.sqrt(((x - v) ** 2).sum(1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != q][:k]
            out[q] = [(int(ids[j]), d[j]) for j in order]
    return out


def test_recall_on_the_given_vectors(spark):
    from pyspark.sql import functions as F

    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = exact(rows, lambda i: i % 50 == 0, 10)
    found = {}
    for r in forest.nearest(df, df.where(F.col("vec_id") % 50 == 0)).collect():
        found.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    hits = 0
    for q, near in want.items():
        got = sorted(found[q])
        assert [g[0] for g in got] == list(range(1, 11))
        assert [g[2] for g in got] == sorted(g[2] for g in got)
        hits += len({g[1] for g in got} & {n for n, _ in near})
    assert hits >= 0.9 * 10 * len(want)


def test_ties_copies_and_odd_vectors(vectors):
    rng = np.random.default_rng(3)
    same = rng.standard_normal(8).tolist()
    rows = [(i, same) for i in range(0, 300, 10)] + [(1000 + i, rng.standard_normal(8).tolist()) for i in range(30)]
    rows += [(5001 + i, v) for i, v in enumerate(ODD)] + [(6000, [1.0, 2.0])]
    df = vectors(*rows)
    got = {}
    for r in forest.nearest(df, df.where("vec_id % 100 = 0"), search=10.0).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = exact([r for r in rows if r[0] < 5000], lambda i: i % 100 == 0, 10)
    assert {q: [v for _, v, _ in sorted(g)] for q, g in got.items()} == {q: [i for i, _ in w] for q, w in want.items()}
    for q, near in want.items():
        assert [s for _, _, s in sorted(got[q])] == pytest.approx([d for _, d in near])


def test_fewer_candidates_than_asked_for(vectors):
    df = vectors((0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [0.0, 2.0]))
    assert [r.vec_id for r in forest.nearest(df, df.where("vec_id = 0")).orderBy("rank").collect()] == [1, 2]
    one = vectors((0, [1.0, 0.0]))
    assert forest.nearest(one, one).count() == 0
    assert forest.nearest(vectors(), vectors()).count() == 0


def test_large_leaves_are_split(vectors, monkeypatch):
    monkeypatch.setattr(forest, "LEAF_ROWS", 7)
    rng = np.random.default_rng(5)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(300)]
    df = vectors(*rows)
    got = {}
    for r in forest.nearest(df, df.where("vec_id % 50 = 0"), depth=3, search=10.0).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {q: [i for i, _ in w] for q, w in exact(rows, lambda i: i % 50 == 0, 10).items()}
