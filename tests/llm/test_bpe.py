from __future__ import annotations

import hashlib
import random

import pytest

from flowgauge.llm import bpe


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.default_tokenizer())


def want(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(back), ids, back


ODD = [
    None, "", " ", "\n\n\n x", "a  b\t\tc \n", "don't we'll I'D '' 'sx", "é à ﬁ 漢字 \U0001f600\U0001f468‍\U0001f469", " x　 y\x85z",
    "a<|endoftext|>b", "  <|endoftext|>  <|endoftext|>", "<|endoftext", "x\x1cy\x1d", "\x00\x01", "1234567 ½ Ⅷ ٣", "\U0001e900\U00031350\U00016ac0 new",
    "combining é à", "end   ", "\r\n\r\n", "ab" * 30_000, "w " * 30_000, "!!!???...---", "a​b  c",
]


def test_odd_texts(docs, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(0, None), (5, ODD[5])]
    found = bpe.round_trip(docs(*rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256, r.ids, r.decoded) == want(library, ODD[r.doc_id]), repr(ODD[r.doc_id])[:60]


def test_random_characters(docs, library):
    rng = random.Random(1)
    pools = [range(32, 127), range(0x20, 0x2FF), range(0x2000, 0x2100), range(0x3000, 0x3100), [*range(0x1F600, 0x1F640), 32, 10, 0x300]]
    rows = [(i, "".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randrange(80)))) for i in range(400)]
    texts = dict(rows)
    for r in bpe.round_trip(docs(*rows), lists=False, decoded=False).collect():
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])[:3], repr(texts[r.doc_id])


def test_given_documents_in_small_blocks(table, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_BYTES", 20_000)
    df = table("documents")
    texts = {r.doc_id: r.text for r in df.collect()}
    found = bpe.round_trip(df, lists=False, decoded=False).collect()
    assert len(found) == len(texts)
    for r in found:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == want(library, texts[r.doc_id])[:3]


def test_equal_blocks(docs, library):
    df = docs((1, "a bc"), (2, "de f"))
    found = bpe.round_trip(df.coalesce(1).union(df.coalesce(1))).collect()
    assert sorted((r.doc_id, r.decoded) for r in found) == [(1, "a bc"), (1, "a bc"), (2, "de f"), (2, "de f")]


def test_decode(spark, library):
    texts = ["héllo wörld", "", "x<|endoftext|>"]
    rows = [(i, library.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)] + [(9, None)]
    got = {r.doc_id: r.decoded for r in bpe.decode(spark.createDataFrame(rows, "doc_id int, ids array<int>")).collect()}
    assert got == {0: texts[0], 1: "", 2: texts[2], 9: ""}


def test_no_rows(docs):
    assert bpe.round_trip(docs()).count() == 0


def test_words_are_shuffled_once(docs):
    df = bpe.round_trip(docs((1, "a b")), lists=False, decoded=False)
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("ReusedExchange") >= 1
