"""Uniqueness kept up to date over loads, against the rule on the whole table."""

import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from flowgauge.quality import Unique, run_rules
from flowgauge.quality import loads as over_loads
from flowgauge.quality.loads import UniqueOverLoads
from flowgauge.sources import load
from tests.conftest import final_plan
from tests.test_load import database  # noqa: F401


@pytest.fixture
def put(spark, make_runs, database):
    """Writes a load of runs of the given names, and takes it in."""
    check = UniqueOverLoads(f"{database}.dag_runs", "dag_id", f"{database}.unique_dag_id")

    def write(name, *dag_ids):
        load(make_runs(*[{"dag_id": d} for d in dag_ids]), check.table, "refresh", load_date=date(2024, 1, 1), load_id=name)
        return check.update(spark, [name])

    write.check = check
    return write


def assert_equal_to_the_rule(spark, check):
    wanted = run_rules(spark.table(check.table), [Unique(column=check.column)], "s", check.table).collect()
    assert check.result(spark, "s").collect() == wanted
    return wanted[0].failed


def test_loads_one_after_the_other(spark, put):
    put("1", "a", "b", "c", None, None)
    assert assert_equal_to_the_rule(spark, put.check) == 0
    assert put("2", "d", "e") == set() and assert_equal_to_the_rule(spark, put.check) == 0
    assert put("3", "f", "f", "g") == set() and assert_equal_to_the_rule(spark, put.check) == 1
    assert put("4", "h", "a", "e") == {"1", "2"} and assert_equal_to_the_rule(spark, put.check) == 3
    # A value of three loads is one value.
    assert put("5", "a") == {"1", "4"} and assert_equal_to_the_rule(spark, put.check) == 3
    put("6")
    put("7", None)
    assert assert_equal_to_the_rule(spark, put.check) == 3


def test_loads_written_again(spark, put):
    put("1", "a", "b")
    put("2", "a", "b", "c")
    assert assert_equal_to_the_rule(spark, put.check) == 2
    put("1", "x")
    assert assert_equal_to_the_rule(spark, put.check) == 0
    put("2", "x", "x", "c")
    assert assert_equal_to_the_rule(spark, put.check) == 1
    put("2", "c")
    assert assert_equal_to_the_rule(spark, put.check) == 0
    put("1")
    assert assert_equal_to_the_rule(spark, put.check) == 0
    # Again without a change, and several at once.
    put.check.update(spark, ["1", "2"])
    put("3", "c")
    put.check.update(spark, ["3", "2"])
    assert assert_equal_to_the_rule(spark, put.check) == 1
    assert put.check.update(spark, []) == set()


def test_dropped_load(spark, put):
    put("1", "a")
    put("2", "a")
    spark.sql(f"ALTER TABLE {put.check.table} DROP PARTITION (load_date = DATE'2024-01-01', load_id = '1')")
    put.check.update(spark, ["1"])
    assert assert_equal_to_the_rule(spark, put.check) == 0


def test_random_loads(spark, put):
    rng = random.Random(8)
    for turn in range(4):
        put(str(rng.randrange(4)), *[rng.choice([None, *map(str, range(60))]) for _ in range(rng.randrange(12))])
        assert_equal_to_the_rule(spark, put.check)


def test_many_values_and_a_frequent_one(spark, database):
    """Sketches of several blocks; a third of a load is one value."""
    table = f"{database}.many"
    rows = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("key"), F.floor(F.col("id") / 20_000).cast("string").alias("load_id")
    )
    again = spark.range(7).select((F.col("id") * 300 + 20_000).alias("key"), F.lit("3").alias("load_id"))
    rows.unionByName(again).write.partitionBy("load_id").saveAsTable(table)
    check = UniqueOverLoads(table, "key", f"{database}.unique_key")
    check.update(spark, ["0"])
    assert check.update(spark, ["1", "2"]) == {"0"}
    sketches = spark.table(f"{database}.unique_key_sketch")
    assert sketches.where("load = '1'").count() == 8 and sketches.agg(F.max(F.length("bits"))).first()[0] == 4096
    assert "1" in check.update(spark, ["3"])
    assert assert_equal_to_the_rule(spark, check) == 8
    # Few values are named wrongly, none that is there is missed.
    strangers = spark.range(100_000, 120_000).select(F.lit("9").alias("load"), F.col("id").alias("value"), F.lit(1).alias("copies"))
    assert check._hits(spark, strangers.where("value < 0")).count() == 0
    assert check._hits(spark, strangers).where("load = '1'").count() < 400
    known = check.counts(spark, ["1"])
    assert check._hits(spark, known.withColumn("load", F.lit("9"))).where("load = '1'").count() == known.count()


def test_only_loads_that_hit_are_read(spark, put):
    for k in range(5):
        put(str(k), f"a{k}", f"b{k}")
    assert put("5", "z", "b3") == {"3"}
    plan = final_plan(put.check.counts(spark, ["3"]))
    assert "PartitionFilters" in plan and put.check.counts(spark, ["3"]).count() == 2
    files = put.check.counts(spark, ["3"]).inputFiles()
    read = spark.table(put.check.table).where("load_id = '3'").inputFiles()
    assert set(read) <= set(files)
    hits = final_plan(put.check._hits(spark, put.check.counts(spark, ["5"]).checkpoint()))
    assert "NestedLoop" not in hits and "Cartesian" not in hits and "Python" not in hits


def test_probes_are_what_the_sketch_sets(spark):
    """Every bit of a bitmap reads back as it was built."""
    bits = spark.range(0, over_loads.BLOCK_BITS, 5).agg(F.bitmap_construct_agg("id").alias("bits"))
    asked = spark.range(over_loads.BLOCK_BITS).crossJoin(F.broadcast(bits))
    wrong = asked.where(over_loads._is_set(F.col("bits"), F.col("id")) != (F.col("id") % 5 == 0))
    assert wrong.count() == 0
