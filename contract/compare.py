"""Run every query in Spark and in DuckDB and compare all rows.

    python -m contract.compare [sf_dir] [query ...]
"""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from contract.oracle import ORACLE_SQL
from contract.queries import QUERIES


def _rows(frame: pd.DataFrame) -> list[tuple]:
    def plain(value):
        if value is None or value is pd.NaT or value is pd.NA or value != value:
            return None
        return value

    names = sorted(frame.columns)
    listed = [tuple(map(plain, row)) for row in frame[names].astype(object).itertuples(index=False)]
    return sorted(listed, key=repr)


def differences(spark: SparkSession, connection, name: str, sf_dir: str) -> list[str]:
    """What differs between the Spark and the SQL answer; empty when they are equal."""
    ours = QUERIES[name](spark, sf_dir)
    theirs = connection.execute(ORACLE_SQL[name]).df()
    if sorted(ours.columns) != sorted(theirs.columns):
        return [f"columns {sorted(ours.columns)} and {sorted(theirs.columns)}"]
    got, wanted = _rows(ours.toPandas()), _rows(theirs)
    if len(got) != len(wanted):
        return [f"{len(got)} rows and {len(wanted)} rows"]
    return [f"{a} and {b}" for a, b in zip(got, wanted) if a != b]


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def main() -> int:
    from flowgauge.session import build_session

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        "compare", "local[8]", spark__sql__shuffle__partitions="8", spark__ui__showConsoleProgress="false"
    )
    spark.sparkContext.setLogLevel("ERROR")
    connection = connect(sf_dir)
    bad = 0
    for name in names:
        began = time.time()
        found = differences(spark, connection, name, sf_dir)
        bad += bool(found)
        print(f"{name}: {'DIFFERS ' + str(len(found)) if found else 'equal'} ({time.time() - began:.1f}s)")
        for line in found[:3]:
            print("   ", line)
    print(f"{len(names) - bad} of {len(names)} equal")
    return bad


if __name__ == "__main__":
    sys.exit(main())
