"""Reading run history, and loading it into target tables."""

from flowgauge.sources.extract import extract_dag_runs, extract_task_instances, incremental_window
from flowgauge.sources.load import ensure_table, extract_and_load, load, load_window
from flowgauge.sources.merge import MergeResult, extract_and_merge, merge_load, open_since
from flowgauge.sources.partitions import replace_partitions, stored_partitions
from flowgauge.sources.readers import JdbcSource, scan, write_jdbc

__all__ = [
    "JdbcSource",
    "MergeResult",
    "ensure_table",
    "extract_and_load",
    "extract_and_merge",
    "extract_dag_runs",
    "extract_task_instances",
    "incremental_window",
    "load",
    "load_window",
    "merge_load",
    "open_since",
    "replace_partitions",
    "scan",
    "stored_partitions",
    "write_jdbc",
]
