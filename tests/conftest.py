from __future__ import annotations

import os
import sys
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from flowgauge.schemas import DAG_RUNS, TASK_INSTANCES  # noqa: E402
from flowgauge.session import build_session  # noqa: E402

LOADED = datetime(2024, 1, 5)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__sql__shuffle__partitions="8",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("checkpoints")),
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="2000",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def make_runs(spark):
    """Raw runs from short dicts; what is left out gets a plain value."""

    def make(*rows, **shared):
        plain = {
            "dag_id": "a",
            "execution_date": datetime(2024, 1, 1, 3),
            "state": "success",
            "start_date": None,
            "end_date": None,
            "duration": None,
            "extracted_at": LOADED,
        }
        data = [{**plain, **shared, **row} for row in rows]
        return spark.createDataFrame([[r[n] for n in DAG_RUNS.names] for r in data], DAG_RUNS)

    return make


@pytest.fixture(scope="session")
def make_tasks(spark):
    def make(*rows, **shared):
        plain = {
            "dag_id": "a",
            "task_id": "t",
            "execution_date": datetime(2024, 1, 1, 3),
            "state": "success",
            "start_date": None,
            "end_date": None,
            "duration": None,
            "try_number": 1,
            "extracted_at": LOADED,
        }
        data = [{**plain, **shared, **row} for row in rows]
        return spark.createDataFrame(
            [[r[n] for n in TASK_INSTANCES.names] for r in data], TASK_INSTANCES
        )

    return make


def final_plan(df) -> str:
    """The physical plan as run, initial alternatives left out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
