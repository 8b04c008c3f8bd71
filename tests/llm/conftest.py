from __future__ import annotations

import duckdb
import pytest

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def table(spark):
    """One of the given tables, small."""
    return lambda name: spark.read.parquet(f"{SMALL}/{name}.parquet")


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text[, lang, source]), with extra columns whose names clash with inner ones."""

    def make(*rows):
        full = [(*r, *(None,) * (4 - len(r)), 1, "x", 2.0) for r in rows]
        schema = "doc_id long, text string, lang string, source string, size int, node string, mark double"
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def vectors(spark):
    """Vectors from (vec_id, list or None)."""

    def make(*rows):
        return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, node string")

    return make


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return connection
