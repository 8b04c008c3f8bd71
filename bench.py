"""Headline queries, timed: prints one JSON line.

Each query is planned and run afresh every time, all its rows are produced, and
the median of the timed runs counts; the warm-up rounds go over all queries.  BENCH_SF_DIR and BENCH_CPUS set the input
and the cores, BENCH_WARMUPS and BENCH_RUNS the repetitions.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from contract.queries import QUERIES  # noqa: E402
from flowgauge.session import build_session  # noqa: E402

HEADLINE = (
    "stg_task_instances",
    "dag_runtime_metrics",
    "dag_failure_rates",
    "slowest_tasks",
    "sla_misses",
    "join_thresholds",
    "agg_percentile_cont",
    "win_rank_max",
    "dq_run_all",
    "exp_suite_task_instances",
    "test_unique",
)
#: These read workflow runs only; the others read task runs, three times as many.
ON_RUNS = ("dag_runtime_metrics", "dag_failure_rates", "dq_run_all", "exp_suite_task_instances", "test_unique")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    warmups = int(os.environ.get("BENCH_WARMUPS", "2"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        spark__sql__shuffle__partitions=cpus,
        # Megabytes of data: keep all cores busy instead of filling 1 MB partitions.
        spark__sql__adaptive__coalescePartitions__minPartitionSize="64KB",
        spark__driver__memory="8g",
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(warmups + runs):
        for name in HEADLINE:
            began = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name].append(time.perf_counter() - began)
    medians = {name: round(statistics.median(t[warmups:]), 4) for name, t in times.items()}
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    result = {
        "metric": "sum of median seconds per headline query",
        "value": round(sum(medians.values()), 4),
        "unit": "sec",
        "queries": medians,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
        "input_rows": {"dag_runs": rows, "task_instances": 3 * rows},
        "input_rows_per_sec": {
            name: round(rows * (1 if name in ON_RUNS else 3) / seconds)
            for name, seconds in medians.items()
        },
        "cpus": int(cpus),
        "runs": runs,
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
