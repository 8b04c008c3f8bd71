"""Service levels from a table of patterns: thousands of substrings, matched in one pass over distinct names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.operators.relational import BROADCAST_ROWS
from flowgauge.session import ensure_checkpoint_dir

#: First characters of a pattern that it is looked up by; shorter patterns are looked up whole.
KEY_CHARS = 4


def matched_levels(names: DataFrame, patterns: DataFrame, name: str = "dag_id") -> DataFrame:
    """(name, pattern, sla_threshold_seconds): per distinct name the first pattern that it holds, if any.

    ``patterns`` has ``priority``, ``pattern`` and ``sla_threshold_seconds``; the smallest
    priority counts, then the smallest threshold, then the pattern itself.  A pattern is
    a plain substring, case-sensitive; an empty one is in every name.  Null names match
    nothing, null patterns are in nothing, and a null priority comes last.

    A name is cut into the pieces that begin at each of its characters, as long as the keys are: the first
    ``KEY_CHARS`` characters of a pattern.  Pieces meet keys in one equality join, whatever the
    number of patterns, and what meets is compared in full.  So a name costs its length, not the
    number of patterns.  The lengths of keys are collected: at most ``KEY_CHARS`` and one numbers.
    """
    keyed = patterns.where("pattern is not null").select(
        F.coalesce(F.col("priority").cast("long"), F.lit((1 << 63) - 1)).alias("priority"),
        "pattern",
        "sla_threshold_seconds",
        F.substring("pattern", 1, KEY_CHARS).alias("key"),
    )
    lengths = sorted(row[0] for row in keyed.select(F.length("key")).distinct().collect())
    distinct = names.select(F.col(name).alias("name")).where("name is not null").distinct()
    every_place = F.sequence(F.lit(1), F.greatest(F.length("name"), F.lit(1)))
    places = distinct.select("name", F.explode(every_place).alias("at"))
    cuts = F.array(*[F.substring("name", F.col("at"), F.lit(n)) for n in lengths]).cast("array<string>")
    # A piece at the end of a name is shorter than it should be, and may be there twice.
    pieces = places.select("name", "at", F.explode(F.array_distinct(cuts)).alias("key"))
    met = pieces.join(keyed, "key").where(F.substr(F.col("name"), F.col("at"), F.length("pattern")) == F.col("pattern"))
    first = F.min(F.struct("priority", "sla_threshold_seconds", "pattern")).alias("first")
    return met.groupBy("name").agg(first).select(
        F.col("name").alias(name), F.col("first.pattern").alias("pattern"), F.col("first.sla_threshold_seconds").alias("sla_threshold_seconds")
    )


def sla_from_patterns(
    rows: DataFrame,
    patterns: DataFrame,
    default: int | None = None,
    name: str = "dag_id",
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``rows`` with ``sla_threshold_seconds`` of the first pattern in their name, or ``default``.

    Only distinct names are matched; the matched ones are counted and go to the rows by
    broadcast up to ``broadcast_rows`` names.  Beyond that, names are many and the rows of each
    few in comparison; the join shuffles, and adaptive execution splits what one name has too much of.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    levels = matched_levels(rows, patterns, name).drop("pattern").checkpoint()
    side = F.broadcast(levels) if levels.count() <= broadcast_rows else levels
    joined = rows.join(side, name, "left")
    if default is not None:
        joined = joined.withColumn("sla_threshold_seconds", F.coalesce("sla_threshold_seconds", F.lit(default)))
    return joined.select(*[F.col(f"`{c}`") for c in rows.columns], "sla_threshold_seconds")
