"""From raw documents to tokens: each stage works on all that the one before it kept."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import bpe, language, line_dedup, mixing, simhash
from flowgauge.llm.common import col, remove, shared_dir

#: Mean probability of its language below which a document is rejected.
LEAST_SCORE = 0.5

#: No SQL can express a trained network, so the pipeline is tested against plain Python.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the network knows; those without a letter go."""
    rows = docs.select(F.struct(*[col(c) for c in docs.columns]).alias("row"), F.col("text").alias("text"))
    found = language.predict(rows, language.fit(docs), id="row", text="text")
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select("row.*")


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that an earlier document has."""
    return line_dedup.dedup_lines(docs).withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints over three words are two bits apart or less."""
    return simhash.drop_near_duplicates(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the proportions of their sources' weights; repeats are rows."""
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of what they decode to."""
    return bpe.round_trip(docs, decoded=False)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", known_language),
    ("line_dedup", without_repeated_passages),
    ("near_duplicates", without_near_duplicates),
    ("mix", mixed_sources),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read again.

    What a stage wrote goes when the next one has read it; the last result stays for the caller.
    """
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
        if i:
            remove(spark, f"{folder}/{i - 1}-{STAGES[i - 1][0]}")
    return docs
