"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in a shuffled order, gone through as often
as its target needs.  A document's virtual finish time is the number of words of its
source up to its end, divided by the source's target.  Sorted by that time over all
sources, the queues advance in proportion to their targets; as the targets themselves
are the weights, all reach them at time 1.  A document that its source is serving then is
two entries of the stream, the words up to the target and those beyond.  The stream is
sorted by range, the words of the ranges before give each range its offset, and the stream
ends where its words reach the total budget: what a document has before that is taken.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import col, cut, word_count

#: Weights of the sources by code point, repeating; null is the last source.
WEIGHTS = (5, 2, 1)
#: Words of the mix as a share of all words.
SHARE = 1.5
#: A source gives at most so many times its words.
MOST = 2
#: Hex digits of a document's place in the shuffled order that a running sum starts anew at.
DIGITS = 3


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, source_size, target) from one row per source.

    ``sizes`` has (source, source_size).  Targets are proportional to the weights, but
    none is above ``most`` times its source; the excess goes to the others by weight
    until none is above.  With the sources in the order of what a unit of weight can
    give them, those up to some place are full and the rest share what is left, so
    running sums find the level without repeating.  One row per source goes through
    one task.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weighed = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), turn + 1).alias("weight"),
        (F.lit(float(most)) * F.col("source_size")).alias("full"),
    )
    order = Window.orderBy(F.col("full") / F.col("weight"), F.col("source").asc_nulls_last())
    before = F.coalesce(F.sum("full").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    everything = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    budget = F.lit(float(share)) * F.sum("source_size").over(everything)
    levelled = weighed.withColumn("level", (budget - before) / after)
    fits = F.when(F.col("full") >= F.col("level") * F.col("weight"), F.col("level"))
    level = F.first(fits, ignorenulls=True).over(everything)
    target = F.least("full", F.coalesce(level * F.col("weight"), F.col("full")))
    return levelled.select("source", "source_size", target.alias("target"))


def _queues(docs, carried, id, text, source, weights, share, most, seed) -> DataFrame:
    """Rows (row, source, size, source_size, target, before): the words before a document in its queue.

    ``row`` holds the columns to carry along.  The shuffled order is cut into stretches
    by the first digits of its hash.  Sums of whole stretches are few; they give each
    stretch its offset, and running sums within a stretch do the rest.  So no source,
    however large, goes through one task.
    """
    place = F.md5(F.concat(F.lit(f"{seed}-"), F.coalesce(col(id).cast("string"), F.lit(""))).cast("binary"))
    size, mark = word_count(col(text)), F.xxhash64(col(text))
    narrow = docs.select(col(source).alias("source"), size.alias("size"), F.substring(place, 1, DIGITS).alias("stretch"))
    sums = narrow.groupBy("source", "stretch").agg(F.sum("size").alias("size"))
    targets = source_targets(
        sums.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, most
    )
    queue = Window.partitionBy("source").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        "source", "stretch", F.coalesce(F.sum("size").over(queue), F.lit(0)).alias("offset")
    ).alias("o")
    of = offsets.join(targets.alias("t"), F.col("o.source").eqNullSafe(F.col("t.source"))).select(
        F.col("o.source").alias("of_source"), F.col("stretch").alias("of_stretch"), "offset", "source_size", "target"
    )
    rows = docs.select(
        F.struct(*carried).alias("row"),
        col(id).alias("id"),
        col(source).alias("source"),
        size.alias("size"),
        mark.alias("mark"),
        place.alias("place"),
        F.substring(place, 1, DIGITS).alias("stretch"),
    )
    ranked = rows.join(
        of, F.col("source").eqNullSafe(F.col("of_source")) & (F.col("stretch") == F.col("of_stretch"))
    )
    inside = Window.partitionBy("source", "stretch").orderBy("place", "id", "size", "mark")
    running = F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    before = F.col("offset") + running - F.col("size")
    return ranked.select("row", "source", "size", "source_size", "target", before.alias("before"))


def _taken(turn: int) -> Column:
    """Words up to its target of a document when its source is gone through for the ``turn``-th time."""
    left = F.floor("target") - F.col("before") - turn * F.col("source_size")
    return F.greatest(F.lit(0), F.least("size", left)).cast("long")


def _entries(turns: int) -> Column:
    """A document's entries in the stream: (at, words), ``at`` being the virtual finish time and whether it is beyond."""

    def entry(turn: int, words: Column, until: Column, beyond: bool) -> Column:
        finish = F.try_divide(F.col("before") + until + turn * F.col("source_size"), F.col("target"))
        # Beside time 1 doubles may not tell a word from the next; the second field does.
        return F.struct(F.struct(finish.alias("finish"), F.lit(beyond).alias("beyond")).alias("at"), words.alias("words"))

    parts = []
    for turn in range(turns):
        served = _taken(turn)
        parts += [entry(turn, served, served, False), entry(turn, F.col("size") - served, F.col("size"), True)]
    return F.filter(F.array(*parts), lambda e: (e["words"] > 0) & (F.col("target") > 0))


def _cut_at(stream: DataFrame, budget: DataFrame) -> DataFrame:
    """One row (at): the last entry of the sorted stream with which its words are within the budget.

    The stream is sorted by range over all tasks.  One row per range gives the words before it; only the
    range in which the budget is reached is summed entry by entry.  That range is known by its first and last entry, not
    by the number of its task, so it holds the same entries whenever it is computed.
    """
    ranges = (
        stream.repartitionByRange("at")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min("at").alias("first"), F.max("at").alias("last"), F.sum("words").alias("words"))
    )
    order = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = ranges.select("first", "last", "words", F.sum("words").over(order).alias("until"))
    over = F.max(F.when(F.col("until") - F.col("words") < budget.scalar(), F.struct("first", "last", "until", "words")))
    reached = cut(until.agg(over.alias("r")).select("r.*", (F.col("r.until") - F.col("r.words")).alias("offset")))
    inside = stream.where(
        (F.col("at") >= reached.select("first").scalar()) & (F.col("at") <= reached.select("last").scalar())
    )
    upto = F.sum("words").over(Window.orderBy("at").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    summed = inside.select("at", (upto + reached.select("offset").scalar()).alias("upto"))
    # Entries that end together are taken together; if none of this range fits, the ranges before it do.
    fits = F.max(F.when(F.col("upto") <= budget.scalar(), F.col("at")))
    before = stream.where(F.col("at") < reached.select("first").scalar()).agg(F.max("at").alias("at"))
    return summed.agg(fits.alias("at")).select(F.coalesce("at", before.scalar()).alias("at"))


def mixing_plan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """(id, size, source_size, target, taken, finish) of every row.

    ``size`` is the number of words, ``taken`` how many words the mix takes of it,
    repeats counted, ``finish`` the virtual time at which its first pass ends (null if
    its source has no words).  Texts that are null or empty have size 0 and give
    nothing.  A null source is a source of its own, the last.  Rows with one id and one
    text share a place in the order; which of them comes first makes no difference.
    """
    queues = cut(_queues(docs, [col(id).alias("id")], id, text, source, weights, share, most, seed))
    # Words are whole, so a source's part of the budget is, too.
    targets = queues.groupBy("source").agg(F.floor(F.max("target")).alias("words"))
    budget = targets.agg(F.coalesce(F.sum("words"), F.lit(0)).alias("budget"))
    entries = _entries(math.ceil(most))
    end = cut(_cut_at(queues.select(F.inline(entries)), budget))
    kept = F.filter("entries", lambda e: e["at"] <= F.col("end"))
    taken = F.coalesce(F.aggregate(kept, F.lit(0).cast("long"), lambda n, e: n + e["words"]), F.lit(0).cast("long"))
    return queues.select("*", entries.alias("entries"), end.scalar().alias("end")).select(
        F.col("row.id").alias(id),
        "size",
        "source_size",
        "target",
        taken.alias("taken"),
        F.when(F.col("target") > 0, (F.col("before") + F.col("size")) / F.col("target")).alias("finish"),
    )


def mixed(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    seed: str = "mix",
) -> DataFrame:
    """The mix itself: rows of ``docs`` by virtual finish time, repeats as rows of their own.

    Texts stay whole: of the document that is cut at the end of a source's share, the
    row is given if at least half of its words are taken.  Rows without a word are left
    out.
    """
    carried = [col(c).alias(f"c{i}") for i, c in enumerate(docs.columns)]
    queues = _queues(docs, carried, id, text, source, weights, share, most, seed)
    turns = F.array(
        *[
            F.struct(
                _taken(turn).alias("taken"),
                ((F.col("before") + F.col("size") + turn * F.col("source_size")) / F.col("target")).alias("finish"),
            )
            for turn in range(math.ceil(most))
        ]
    )
    return (
        queues.where("size > 0 and target > 0")
        .select("row", "size", F.explode(turns).alias("turn"))
        .where("turn.taken > 0 and 2 * turn.taken >= size")
        .select("row", F.col("turn.finish").alias("finish"))
        .repartitionByRange("finish")
        .sortWithinPartitions("finish")
        .select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])
    )
