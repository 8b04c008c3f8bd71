"""Merging reloaded extracts into raw tables."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from flowgauge.sources import extract_and_load
from flowgauge.sources.load import load
from flowgauge.sources.merge import RUN_KEY, merge_load, open_since
from flowgauge.sources.partitions import is_one_of, replace_partitions, stored_partitions
from tests.conftest import final_plan
from tests.test_load import T0, at, database  # noqa: F401

D = date(2024, 1, 10)


def merged(df, table, day=D, name="w"):
    return merge_load(df, table, RUN_KEY, day, name)


def rows(spark, table):
    found = spark.table(table).select("dag_id", "execution_date", "state", "load_id").collect()
    return sorted((str(r[0]), *r[1:]) for r in found)


def test_late_ends_replace_open_runs(spark, make_runs, database):
    table = f"{database}.dag_runs"
    first = make_runs(at(0, state="running"), at(1), at(2, dag_id=None))
    assert merged(first, table, name="a").inserted == 3
    second = make_runs(at(0, duration=5.0), at(1), at(2, dag_id=None), at(3), extracted_at=T0 + timedelta(days=9))
    found = merged(second, table, name="b")
    assert (found.inserted, found.updated, found.unchanged) == (1, 1, 2)
    assert rows(spark, table) == [
        ("None", T0 + timedelta(hours=2), "success", "a"),
        ("a", T0, "success", "a"),
        ("a", T0 + timedelta(hours=1), "success", "a"),
        ("a", T0 + timedelta(hours=3), "success", "b"),
    ]
    signs = sorted((r.sign, r.execution_date, r.state) for r in found.changes.collect())
    assert signs == [(-1, T0, "running"), (1, T0, "success"), (1, T0 + timedelta(hours=3), "success")]


def test_repeated_merge_changes_nothing(spark, make_runs, database):
    table = f"{database}.dag_runs"
    df = make_runs(at(0), at(1, state=None), at(1, dag_id="b"))
    assert merged(df, table).partitions == ((str(D), "w"),)
    before = spark.table(table).inputFiles()
    again = merged(df.withColumn("extracted_at", F.lit(T0 + timedelta(days=3)).cast("timestamp_ntz")), table, name="z")
    assert (again.inserted, again.updated, again.unchanged, again.partitions) == (0, 0, 3, ())
    assert again.changes.count() == 0 and spark.table(table).inputFiles() == before


def test_older_rows_and_copies(spark, make_runs, database):
    table = f"{database}.dag_runs"
    early, late = T0, T0 + timedelta(days=5)
    load(make_runs(at(0, state="running", extracted_at=late)), table, "refresh", D, load_id="a")
    assert merged(make_runs(at(0, extracted_at=early)), table).unchanged == 1
    # Overlapping windows left a second copy; an update leaves one row, where the first was.
    load(make_runs(at(0, state="running", extracted_at=late)), table, "refresh", D, load_id="b")
    found = merged(make_runs(at(0, extracted_at=late + timedelta(days=1)), at(0, state="failed", extracted_at=early)), table)
    assert found.updated == 1 and found.partitions == ((str(D), "a"), (str(D), "b"))
    assert rows(spark, table) == [("a", T0, "success", "a")]
    assert stored_partitions(spark, table) == {(str(D), "a")}


def test_one_copy_out_of_date(spark, make_runs, database):
    table = f"{database}.dag_runs"
    load(make_runs(at(0, state="running")), table, "refresh", D, load_id="a")
    load(make_runs(at(0)), table, "refresh", D, load_id="b")
    found = merged(make_runs(at(0, extracted_at=T0 + timedelta(days=9))), table)
    assert found.updated == 1 and rows(spark, table) == [("a", T0, "success", "a")]
    assert sorted(r.sign for r in found.changes.collect()) == [-1, -1, 1]


def test_empty_extracts_and_null_times(spark, make_runs, database):
    table = f"{database}.dag_runs"
    nothing = merged(make_runs(at(0)).where("false"), table)
    assert (nothing.inserted, nothing.partitions) == (0, ())
    untimed = make_runs({"execution_date": None, "state": "running"}, at(0))
    assert merged(untimed, table).inserted == 2
    ended = make_runs({"execution_date": None, "extracted_at": T0 + timedelta(days=9)})
    assert merged(ended, table, name="x").updated == 1
    assert spark.table(table).where("state = 'success'").count() == 2


def test_only_touched_partitions_are_read_and_written(spark, make_runs, database):
    table = f"{database}.dag_runs"
    for k in range(4):
        merged(make_runs(at(24 * k, state="running"), at(24 * k + 1)), table, D + timedelta(days=k), f"w{k}")
    before = {f for f in spark.table(table).inputFiles()}
    found = merged(make_runs(at(24, extracted_at=T0 + timedelta(days=9))), table, D + timedelta(days=9), "late")
    assert found.partitions == ((str(D + timedelta(days=1)), "w1"),)
    after = set(spark.table(table).inputFiles())
    assert len(before & after) == 3 and spark.table(table).count() == 8
    plan = final_plan(spark.table(table).where(is_one_of(("load_date", "load_id"), found.partitions)))
    assert "PartitionFilters: [" in plan and spark.table(table).where(
        is_one_of(("load_date", "load_id"), found.partitions)
    ).select(F.input_file_name()).distinct().count() == len(after - before)


def test_replacing_keeps_other_partitions_whole(spark, database):
    table = f"{database}.t"
    spark.sql(f"CREATE TABLE {table} (v INT, `p` STRING, `q x` STRING) USING parquet PARTITIONED BY (`p`, `q x`)")
    odd = [(1, "a", "it's/so=1"), (2, "a", "b"), (3, "ü x", "b")]
    replace_partitions(spark.createDataFrame(odd, "v int, p string, `q x` string"), table, [r[1:] for r in odd])
    assert stored_partitions(spark, table) == {r[1:] for r in odd}
    # A partition without new rows goes; the new rows may come from the table itself.
    replace_partitions(spark.table(table).where("v = 1").withColumn("v", F.col("v") + 10), table, [odd[0][1:], odd[1][1:]])
    assert sorted(map(tuple, spark.table(table).collect())) == [(3, "ü x", "b"), (11, "a", "it's/so=1")]
    replace_partitions(spark.table(table).limit(0), table, [])
    assert spark.table(table).count() == 2


def test_a_write_that_fails_changes_nothing(spark, make_runs, database):
    table = f"{database}.dag_runs"
    merged(make_runs(at(0), at(1)), table)
    broken = spark.table(table).withColumn("state", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        replace_partitions(broken, table, [(str(D), "w")])
    assert spark.table(table).count() == 2


def test_daily_merges_close_what_was_open(spark, make_runs, make_tasks, database):
    """Each day sees its runs still open; the next day's load brings their ends, however long they took."""

    def source(now, make, **more):
        runs = []
        for k in range(5):
            ended = k + (3 if k == 0 else 1) <= now
            runs.append(at(24 * k + 5, dag_id=f"d{k}", state="success" if ended else "running", **more))
        return make(*runs, extracted_at=T0)

    for now in range(1, 5):
        end = T0 + timedelta(days=now)
        counts = extract_and_load(
            spark, source(now, make_runs), source(now, make_tasks, try_number=1), end - timedelta(days=1), end,
            as_of=end, database=database, if_exists="merge",
        )
        assert counts["dag_runs_count"] == counts["task_instances_count"]
    for name in ("dag_runs", "task_instances"):
        found = spark.table(f"{database}.{name}")
        assert {r.dag_id: r.state for r in found.collect()} == {"d0": "success", "d1": "success", "d2": "success", "d3": "success"}
    assert open_since(spark.table(f"{database}.dag_runs")) is None
    assert open_since(make_runs(at(3, state="queued"), at(1, state=None), at(0, state="failed"))) == T0 + timedelta(hours=1)
