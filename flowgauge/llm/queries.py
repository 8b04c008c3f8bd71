"""The operators as registered queries, each over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.llm import (
    bpe,
    forest,
    infill,
    itq,
    language,
    line_dedup,
    mixing,
    periodic,
    simhash,
    substrings,
    toxicity,
    url_filter,
    warc_zip,
)
from flowgauge.llm.common import id_bucket


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.mixing_plan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op2_itq_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of near-duplicate embeddings."""
    return itq.near_vectors(_table(spark, sf_dir, "embeddings"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = _table(spark, sf_dir, "documents")
    found = language.predict(docs, language.fit(docs))
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score")


def op4_warc_in_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records in ZIP archives, and read back."""
    pages = _table(spark, sf_dir, "pages")
    written = warc_zip.write_archives(pages)
    return warc_zip.read_archives(written, pages.schema["page_id"].dataType.simpleString()).drop("url")


def op5_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and group of every document."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the passages of 50 words or more that an earlier one has."""
    return line_dedup.dedup_lines(_table(spark, sf_dir, "documents"), removed="removed_lines").select(
        "doc_id", "text", "removed_lines"
    )


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    found = toxicity.predict(docs, model)
    return found.select("doc_id", (id_bucket(F.col("doc_id"), 4) == 2).alias("held_out"), "score", "predicted")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's token ids, and of what they decode to."""
    return bpe.round_trip(_table(spark, sf_dir, "documents"), lists=False, decoded=False)


def op9_forest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found of every hundredth vector."""
    vectors = _table(spark, sf_dir, "embeddings")
    return forest.nearest(vectors, vectors.where("vec_id % 100 = 0"))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's address."""
    return url_filter.url_verdicts(_table(spark, sf_dir, "pages"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of every document, one in ten of which is made periodic first."""
    docs = periodic.with_planted_runs(_table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs)
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.col2")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.col3")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.col3")).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document cut and rearranged for infilling, and put together again."""
    found = infill.fill_in_middle(_table(spark, sf_dir, "documents"))
    again = infill.restored(F.col("output"), F.col("form"))
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(again, 256).alias("restored_sha256"),
    )


def op13_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages of 35 words that come more than once."""
    return substrings.without_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_source_mixing,
        op2_itq_near_vectors,
        op3_language_id,
        op4_warc_in_zip,
        op5_simhash_groups,
        op6_line_dedup,
        op7_toxicity,
        op8_bpe,
        op9_forest_neighbours,
        op10_url_filter,
        op11_periodic_runs,
        op12_fill_in_middle,
        op13_substring_dedup,
    )
}
