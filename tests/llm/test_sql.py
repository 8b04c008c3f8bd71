"""Queries that SQL can express, against DuckDB on the given tables."""

from __future__ import annotations

import pytest

from contract.compare import differences
from flowgauge.llm import oracle, queries


@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_equals_sql(spark, duck, name, monkeypatch):
    import contract.compare as compare

    monkeypatch.setitem(compare.QUERIES, name, queries.QUERIES[name])
    monkeypatch.setitem(compare.ORACLE_SQL, name, oracle.ORACLE_SQL[name])
    assert differences(spark, duck, name, "/root/testdata/sf0.001") == []


def test_all_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names
