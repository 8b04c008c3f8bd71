"""Helpers that several operators share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.session import ensure_checkpoint_dir

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def ship(name: str) -> None:
    """Send a module's functions to the executors by value; they need no copy of this library."""
    cloudpickle.register_pickle_by_value(sys.modules[name])


ship(__name__)


def give_back() -> None:
    """Return memory that a Python worker has freed to the system; idle workers live on beside the next stage."""
    import pyarrow

    pyarrow.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the GNU library has it
    if trim:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function over batches that gives memory back when a task is done."""

    def tidied(batches):
        yield from run(batches)
        give_back()

    return tidied


def shared_dir(spark: SparkSession) -> str:
    """Address of the folder that driver and executors share (``spark.checkpoint.dir``)."""
    folder = ensure_checkpoint_dir(spark)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.makeQualified(path).toString()


def cut(df: DataFrame) -> DataFrame:
    """The rows, computed once and kept in the shared folder; survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fresh(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for frame in frames for c in frame.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def col(name: str) -> Column:
    """A column by its whole name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def id_bucket(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``: which fold a document is in."""
    return F.crc32(key.cast("string").cast("binary")) % parts


def spread_sample(df: DataFrame, place: Column, size: int) -> DataFrame:
    """At most ``size`` rows, those of the smallest ``place`` (a 64-bit hash), the same in every run.

    Rows of one place are one here.  A bound on the hash, from the number of different places,
    leaves about twice as many as wanted, so that tasks do not each send ``size`` rows.
    """
    at = fresh("place", df)
    rows = df.withColumn(at, place)
    n = rows.agg(F.approx_count_distinct(at)).first()[0]
    if n > 4 * size + 200:
        rows = rows.where(F.col(at).cast("double") / 2.0**64 + 0.5 <= (2.0 * size + 50) / n)
    return rows.dropDuplicates([at]).orderBy(at).limit(size).drop(at)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that this library has written."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
