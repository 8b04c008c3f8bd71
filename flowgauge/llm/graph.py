"""Connected components by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.llm.common import cut


def _large_star(edges: DataFrame) -> DataFrame:
    """Join every larger neighbour of a node to the smallest node around it."""
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).unionByName(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("hi"), F.col("m").alias("lo"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Join a node and its smaller neighbours to the smallest of them."""
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    moved = edges.join(least, "hi").where("lo > m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    return moved.unionByName(least.select("hi", F.col("m").alias("lo"))).distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) of every node that has an edge to another one.

    ``component`` is the smallest node that can be reached.  Edges may repeat, run
    either way, or be loops; those with a null end are ignored.  A round costs a few
    shuffles of the edges, and the number of rounds grows with the logarithm of the
    longest path.  Groups combine before the shuffle, so the neighbours of one node
    are never gathered in one place; AQE splits the joins of a node with many edges.
    """
    now = cut(
        edges.select(F.least(a, b).alias("lo"), F.greatest(a, b).alias("hi"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & F.expr("lo < hi"))
        .distinct()
    )
    mark, before = _mark(now), None
    while mark[0] and mark != before:
        now, before = cut(_small_star(_large_star(now))), mark
        mark = _mark(now)
    return now.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(
        now.select(F.col("lo").alias("node"), F.col("lo").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and checksum; equal for equal sets of edges."""
    return tuple(
        edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()
    )
