"""Trained operators: gradients, held-out accuracy, odd rows."""

from __future__ import annotations

import zlib

import numpy as np
import pytest

from flowgauge.llm import language, toxicity

TRAINED = "/root/testdata/sf0.01"


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    net = language.Network.new(["a", "b", "c"])
    for f in ("embedding", "inputs", "state", "bias", "out", "out_bias"):
        setattr(net, f, getattr(net, f).astype(float))
    codes, labels = rng.integers(0, 256, (5, 9)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = net.gradients(codes, labels)
    for w, g in zip(net.weights(), grads):
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in w.shape)
            if w is net.embedding:
                at = (int(codes[0, 0]), at[1])
            old, eps = w[at], 1e-3
            w[at] = old + eps
            up = net.gradients(codes, labels)[0]
            w[at] = old - eps
            down = net.gradients(codes, labels)[0]
            w[at] = old
            assert g[at] == pytest.approx((up - down) / (2 * eps), rel=0.02, abs=2e-4)


@pytest.fixture(scope="module")
def net(spark):
    return language.fit(spark.read.parquet(f"{TRAINED}/documents.parquet"))


def test_held_out_languages(spark, net):
    docs = spark.read.parquet(f"{TRAINED}/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = [r for r in language.predict(docs, net).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and truth[r.doc_id]]
    assert len(got) > 100
    assert sum(r.lang_pred == truth[r.doc_id] for r in got) >= 0.97 * len(got)
    assert all(0 <= r.score <= 1 for r in got)


def test_languages_of_odd_texts(docs, net):
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "a"), (5, "é"), (6, "the and that " * 40_000), (7, "\x00" * 70 + "x"), (6, "the and that " * 40_000)]
    got = sorted((r.doc_id, r.lang_pred, round(r.score, 6)) for r in language.predict(docs(*rows), net).collect())
    assert [g[:2] for g in got[:3]] == [(1, "und"), (2, "und"), (3, "und")]
    assert all(g[1] in net.languages and 0 < g[2] <= 1 for g in got[3:])
    assert [g[1] for g in got if g[0] == 6] == ["en", "en"]
    assert language.predict(docs(), net).count() == 0


def test_no_labelled_text(docs):
    df = docs((1, "abc", None, "s"), (2, None, "en", "s"))
    assert [r.lang_pred for r in language.predict(df, language.fit(df)).collect()] == ["und", "und"]


def test_predictions_do_not_depend_on_neighbours(docs, net):
    rows = [(i, "der die das und " * (1 + i % 5) + "x" * (i % 70)) for i in range(60)]
    one = {r.doc_id: r.score for r in language.predict(docs(*rows).coalesce(1), net).collect()}
    many = {r.doc_id: r.score for r in language.predict(docs(*rows).repartition(9), net).collect()}
    assert one.keys() == many.keys() and all(one[k] == pytest.approx(many[k], abs=1e-5) for k in one)


@pytest.fixture(scope="module")
def toxic_model(spark):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    return toxicity.fit(read("documents"), read("labels"))


def test_held_out_toxicity(spark, toxic_model):
    read = lambda t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet")
    truth = {r.doc_id: r.toxic for r in read("labels").collect()}
    held = read("documents").join(read("labels").select("doc_id"), "doc_id").where("crc32(cast(string(doc_id) as binary)) % 4 = 2")
    got = [(r.score, truth[r.doc_id], r.predicted) for r in toxicity.predict(held, toxic_model).collect()]
    y = np.array([g[1] for g in got])
    rank = np.argsort(np.argsort([g[0] for g in got]))
    area = (rank[y == 1].mean() - rank[y == 0].mean()) / len(y) + 0.5
    hits = sum(p and t for _, t, p in got)
    assert area >= 0.8
    assert hits / max(1, sum(p for *_, p in got)) >= 0.85 and hits >= 0.65 * y.sum()


def test_toxicity_of_odd_texts(docs, toxic_model):
    rows = [(1, None), (2, ""), (3, "x"), (4, "You idiot, worthless moron, pathetic scum. stupid trash"), (5, "the and " * 300_000), (4, "fine words here")]
    got = sorted((r.doc_id, r.score, r.predicted) for r in toxicity.predict(docs(*rows), toxic_model).collect())
    assert got[0][1:] == got[1][1:]
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, s, p in got)
    assert max(s for i, s, _ in got if i == 4) > 0.5 > max(s for i, s, _ in got if i < 3)
    assert toxicity.predict(docs(), toxic_model).count() == 0


def test_one_class_only(docs, spark):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs((1, "a"), (2, "b")), labels)
    assert [r.predicted for r in toxicity.predict(docs((9, "c")), model).collect()] == [0]


def test_features_in_slices_are_those_of_the_whole(monkeypatch):
    text = bytes(np.random.default_rng(0).integers(97, 110, 5000).astype(np.uint8))
    whole = sorted(toxicity.features(text).tolist())
    monkeypatch.setattr(toxicity, "SLICE", 333)
    assert sorted(toxicity.features(text).tolist()) == whole


def test_copies_do_not_empty_the_sample(spark):
    """20,000 copies of one text beside another language: both are learned."""
    copies = spark.range(20_000).selectExpr("1L as doc_id", "'the same english words again and again' as text", "'en' as lang")
    others = spark.range(300).selectExpr("id + 10 as doc_id", "concat('ein anderer satz auf deutsch ', id) as text", "'de' as lang")
    net = language.fit(copies.union(others))
    assert net.languages == ["de", "en"]


def test_one_bound_over_many_languages(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "concat('text number ', id) as text", "string(id % 300) as lang")
    seen = []

    def train(texts, labels, **_):
        seen.append((len(texts), len(set(labels))))
        return language.Network.new(sorted(set(labels)))

    original, language.train = language.train, train
    try:
        language.fit(docs, most_texts=500)
        language.fit(docs, most_texts=100)
        language.fit(docs, per_language=2)
    finally:
        language.train = original
    assert seen[0] == (300, 300) and seen[1] == (100, 100) and seen[2][1] == 300 and seen[2][0] <= 600


def test_samples_take_distinct_places(spark):
    from flowgauge.llm.common import spread_sample

    same = spark.range(100_001).selectExpr("7L as id", "1 as v")
    assert spread_sample(same, language.F.xxhash64("id"), 10).count() == 1
    mixed = same.union(spark.range(5000).selectExpr("id + 100", "2"))
    rows = spread_sample(mixed, language.F.xxhash64("id"), 50).collect()
    assert len(rows) == 50 == len({r.id for r in rows})
    assert rows == spread_sample(mixed.repartition(3), language.F.xxhash64("id"), 50).collect()


def test_repeated_labelled_rows_fit_one_model(spark):
    docs = spark.range(400).selectExpr("id % 40 as doc_id", "concat(if(id % 2 = 0, 'kind words ', 'vile slur '), id % 40) as text")
    labels = spark.range(40).selectExpr("id as doc_id", "int(id % 2) as toxic")
    a, b = (toxicity.fit(d, labels, sample=20) for d in (docs, docs.repartition(7)))
    assert np.array_equal(a.weights, b.weights) and a.intercept == b.intercept


def test_language_scores_against_a_plain_pass(net, spark):
    """Probabilities recomputed by a loop over the bytes of every piece, one at a time."""
    texts = [r.text.encode() for r in spark.read.parquet(f"{TRAINED}/documents.parquet").where("length(text) < 600").limit(6).collect()]
    for text, found in zip(texts, language._label(texts, net)):
        total, n = np.zeros(len(net.languages)), 0
        for piece in language._pieces(text):
            codes = piece[None]
            own = net.positions(codes)[:, 0]
            for at, code in enumerate(piece):
                if code != 0:
                    total, n = total + own[at], n + 1
        assert np.allclose(found, total / total.sum(), atol=1e-4)
