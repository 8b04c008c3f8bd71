"""flowgauge: run-history analytics for scheduled workflows, written for Spark.

The library is a set of DataFrame transforms and thin jobs over two tables:
``dag_runs`` (one row per workflow run) and ``task_instances`` (one row per
task run).  Nothing here collects data to the driver; Catalyst and AQE choose
the physical plan.
"""

__version__ = "0.1.0"
