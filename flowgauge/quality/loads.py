"""Uniqueness over loads: sketches of the loads before tell which values of a new one to look for, and where.

The state of a check is three tables, split by load:

- ``<state>_sketch``: a Bloom filter of the load's values in blocks of 32,768 bits, as many blocks (a power
  of two) as its values need, so that a value is looked up in one block of each load;
- ``<state>_loads``: how many rows with a value, how many different values, and the power;
- ``<state>_facts``: (value, copies) of all values that repeat in the load or occur in another one.

A new load is compared with the sketches alone.  Only loads that a sketch points to are read, and only the
values it points to are counted there, so the answer is exact: a sketch never misses a value, and a value that it
names wrongly is not found.  A fact speaks of one load and holds until that load is written again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.quality.rules import Unique, result_row
from flowgauge.schemas import LOAD_ID
from flowgauge.session import ensure_checkpoint_dir
from flowgauge.sources.partitions import is_one_of, replace_partitions

#: Bits of a block: what ``bitmap_construct_agg`` builds.
BLOCK_BITS = 32_768
#: Bits of a sketch for each value, and how many of them a value sets: about one value in 200 is named wrongly.
BITS_PER_VALUE, PROBES = 12, 6

_LOAD = "load"


def _level(values: Column) -> Column:
    """The power of two of a sketch's blocks."""
    return F.greatest(F.lit(0), F.ceil(F.log2(values * F.lit(BITS_PER_VALUE / BLOCK_BITS)))).cast("int")


def _block(value: Column, level: Column) -> Column:
    return F.xxhash64(value).bitwiseAND(F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1)


def _bits(value: Column) -> list[Column]:
    """The places of a value's bits in its block."""
    return [F.pmod(F.xxhash64(value, F.lit(k)), F.lit(BLOCK_BITS)) for k in range(PROBES)]


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(bit / 8) + 1).cast("int"), 1)), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (bit % 8).cast("int"))) != 0


@dataclass(frozen=True)
class UniqueOverLoads:
    """No value of ``column`` twice in ``table``, kept up to date load by load; NULLs are ignored.

    ``state`` is the name that the state's tables begin with, database included.  ``load`` is the partition
    column of ``table`` that names the load.
    """

    table: str
    column: str
    state: str
    load: str = LOAD_ID.name

    def counts(self, spark: SparkSession, loads: Iterable[str]) -> DataFrame:
        """(load, value, copies) of the given loads.  Equal values combine before the shuffle."""
        rows = spark.table(self.table).where(is_one_of([self.load], [(name,) for name in loads]))
        named = rows.select(F.col(f"`{self.load}`").alias(_LOAD), F.col(f"`{self.column}`").alias("value"))
        return named.where("value IS NOT NULL").groupBy(_LOAD, "value").agg(F.count(F.lit(1)).alias("copies"))

    def update(self, spark: SparkSession, loads: Iterable[str]) -> set[str]:
        """Take in loads that were written, written again or dropped; returns the other loads that were read.

        May be run again, as a whole, after it broke off.  The names of the loads read come to the driver.
        """
        loads = sorted(set(loads))
        if not loads:
            return set()
        ensure_checkpoint_dir(spark)
        fresh = self.counts(spark, loads).checkpoint()
        sizes = fresh.groupBy(_LOAD).agg(F.sum("copies").alias("rows"), F.count(F.lit(1)).alias("values"))
        sizes = sizes.withColumn("level", _level(F.col("values")))
        self._replace(sizes, "loads", loads)
        self._replace(self._sketch(fresh, sizes), "sketch", loads)

        hits = self._hits(spark, fresh).checkpoint()
        named = {row[0] for row in hits.select(_LOAD).distinct().collect()}
        others = named - set(loads)
        # One row per load and value on both sides, so no value is too frequent for a task.
        found = self.counts(spark, named).join(hits, [_LOAD, "value"], "left_semi").checkpoint()
        elsewhere = fresh.where("copies = 1").join(found.select("value").distinct(), "value", "left_semi")
        facts = fresh.where("copies > 1").unionByName(elsewhere)
        if others:
            theirs = is_one_of([_LOAD], [(name,) for name in others])
            stored = self._ensure(facts, "facts").where(theirs)
            facts = facts.unionByName(stored.unionByName(found.where(theirs)).distinct())
        self._replace(facts, "facts", [*loads, *others])
        return others

    def result(self, spark: SparkSession, suite: str, name: str | None = None) -> DataFrame:
        """The row that the rule ``Unique`` gives for the whole table (``name`` in its reports)."""
        rule, name = Unique(column=self.column), name or self.table
        rows = spark.table(f"{self.state}_loads").agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
        copies = spark.table(f"{self.state}_facts").groupBy("value").agg(F.sum("copies").alias("copies"))
        repeated = copies.agg(F.count_if(F.col("copies") > 1).alias("repeated"))
        # Both sides are one row.
        both = rows.withColumn("one", F.lit(1)).join(repeated.withColumn("one", F.lit(1)), "one")
        fields = rule.verdict(F.col("rows"), F.col("repeated"))
        return both.select(F.inline(F.array(result_row(rule, suite, name, fields))))

    def _sketch(self, fresh: DataFrame, sizes: DataFrame) -> DataFrame:
        # Sizes are one row per load.
        placed = fresh.join(F.broadcast(sizes.select(_LOAD, "level")), _LOAD)
        value = F.col("value")
        bits = placed.select(
            _LOAD, "level", _block(value, F.col("level")).alias("block"), F.explode(F.array(*_bits(value))).alias("bit")
        )
        return bits.groupBy(_LOAD, "level", "block").agg(F.bitmap_construct_agg("bit").alias("bits"))

    def _hits(self, spark: SparkSession, fresh: DataFrame) -> DataFrame:
        """(load, value): values that another load's sketch names.

        A value meets one block of each load.  The bits are tested while joining, so what does not
        hit is never a row.
        """
        levels = [row[0] for row in spark.table(f"{self.state}_loads").select("level").distinct().collect()]
        each = F.explode(F.array(*[F.lit(level) for level in levels]) if levels else F.array().cast("array<int>"))
        asked = fresh.select(F.col(_LOAD).alias("own"), "value", each.alias("level")).select(
            "*", _block(F.col("value"), F.col("level")).alias("block")
        )
        stored = spark.table(f"{self.state}_sketch").select(
            _LOAD, "bits", F.col("level").alias("of_level"), F.col("block").alias("of_block")
        )
        all_set = reduce(and_, [_is_set(F.col("bits"), bit) for bit in _bits(F.col("value"))])
        same = (F.col("level") == F.col("of_level")) & (F.col("block") == F.col("of_block"))
        return asked.join(stored, same & (F.col("own") != F.col(_LOAD)) & all_set).select(_LOAD, "value").distinct()

    def _ensure(self, df: DataFrame, part: str) -> DataFrame:
        """The state's table, split by load; made if it is absent."""
        spark, table = df.sparkSession, f"{self.state}_{part}"
        if not spark.catalog.tableExists(table):
            rest = [c for c in df.columns if c != _LOAD]
            df.where("false").select(*rest, _LOAD).write.partitionBy(_LOAD).saveAsTable(table)
        return spark.table(table).select(*df.columns)

    def _replace(self, df: DataFrame, part: str, loads: Iterable[str]) -> None:
        self._ensure(df, part)
        replace_partitions(df, f"{self.state}_{part}", [(name,) for name in loads], [_LOAD])
