from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

import corpus_pipeline

SMALL = "/root/testdata/sf0.001"


def test_stages_one_by_one(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    names = docs.columns
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {(r.doc_id, r.text) for r in docs.collect()}
        stage(spark, docs, SMALL).write.parquet(f"{tmp_path}/{i}")
        after = spark.read.parquet(f"{tmp_path}/{i}")
        rows = after.collect()
        if name != "bpe":
            assert after.columns == names
            assert {r.doc_id for r in rows} <= {d for d, _ in before}
        if name in ("language", "near_duplicates", "mix"):
            assert {(r.doc_id, r.text) for r in rows} <= before
        if name == "language":
            assert len(rows) >= 0.95 * len(before)
        if name == "line_dedup":
            assert len(rows) == len(before) and all(r.n_chars == len(r.text) for r in rows)
        if name == "near_duplicates":
            assert len({r.doc_id for r in rows}) == len(rows)
        docs = after
    texts = {hashlib.sha256(t.encode()).hexdigest() for _, t in before}
    assert {r.decoded_sha256 for r in docs.collect()} == texts


def test_near_duplicates_against_brute_force(spark):
    """The stage takes the shingle length and the bit distance of the operator's contract."""
    from tests.llm.test_simhash import kept_by_brute_force

    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = sorted(str(r.doc_id) for r in corpus_pipeline.without_near_duplicates(spark, df, "").collect())
    assert kept == sorted(map(str, kept_by_brute_force([(r.doc_id, r.text) for r in df.collect()])))


def test_odd_column_names(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").withColumn("a.b", F.lit(1)).withColumn("row", F.lit(2))
    for name, stage in corpus_pipeline.STAGES[:4]:
        assert stage(spark, docs, SMALL).columns == docs.columns, name


def test_run_and_empty_input(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
