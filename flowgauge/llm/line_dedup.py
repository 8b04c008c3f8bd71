"""Line deduplication: passages that an earlier text already has are deleted.

A window is the shortest sequence of lines that reaches ``min_words`` words, once from
each line on and once up to each line; every repeated passage of that length contains
the windows of all its lines.  Each window selects the least hash of its lines, the leftmost if
several are least, as its fingerprint: equal windows select the same line, so a repeated passage
has a fingerprint that lies at two places or more.  Only windows around such places go on.  From its
fingerprint a match reaches both ways to the ends of its window, compared by the hash of the
whole content, and on through the windows that overlap it; the first place of each in the
order of documents is its original.  Later windows join to runs, which are deleted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowgauge.llm.common import col, cut, fresh, word_count

#: Words that a run of lines has at least to be deleted.
MIN_WORDS = 50


def _windows(docs: DataFrame, id: str, text: str, min_words: int) -> DataFrame:
    """(id, mark, start, end, low, at, content, words): windows as spans of line numbers.

    ``low`` is the fingerprint, the least hash of the window's lines, and ``at`` its first line with it.

    ``mark`` is a hash of the text, so rows with one id and different texts stay apart.
    Rows that agree in both are one here.  Lines without a word are skipped.
    """
    lines = (
        # The whole text is hashed below the explode: beside it, it would be hashed once a line.
        docs.select(col(id).alias("id"), F.xxhash64(col(text)).alias("mark"), F.split(col(text), "\n").alias("lines"))
        .select("id", "mark", F.posexplode("lines").alias("line", "s"))
        .select("id", "mark", "line", F.xxhash64("s").alias("hash"), word_count(F.col("s")).alias("words"))
        .where("words > 0")
        .repartition("id", "mark")
        .groupBy("id", "mark", "line")
        .agg(F.min("hash").alias("hash"), F.min("words").alias("words"))
    )
    one = Window.partitionBy("id", "mark")
    placed = lines.withColumn("until", F.sum("words").over(one.orderBy("line").rowsBetween(Window.unboundedPreceding, 0)))
    placed = placed.withColumn("since", F.col("until") - F.col("words"))
    onward = one.orderBy("since").rangeBetween(0, min_words - 1)
    back = one.orderBy("until").rangeBetween(-(min_words - 1), 0)

    def spans(over) -> Column:
        return F.struct(
            F.min("line").over(over).alias("start"),
            F.max("line").over(over).alias("end"),
            F.min(F.struct(F.col("hash").alias("low"), F.col("line").alias("at"))).over(over).alias("least"),
            F.xxhash64(F.collect_list("hash").over(over)).alias("content"),
            F.sum("words").over(over).alias("words"),
        )

    both = placed.select("id", "mark", spans(onward).alias("onward"), spans(back).alias("back"))
    # A window of one line is the same both ways.
    twice = F.when(F.col("back.start") < F.col("back.end"), F.array("onward", "back")).otherwise(F.array("onward"))
    windows = both.select("id", "mark", F.explode(twice).alias("w")).where(f"w.words >= {min_words}")
    return windows.select("id", "mark", "w.start", "w.end", "w.least.low", "w.least.at", "w.content", "w.words")


def _around_shared(windows: DataFrame) -> DataFrame:
    """The windows whose fingerprint lies at more than one place.

    Places of one fingerprint combine to the least and the greatest of their hashes before the shuffle,
    so neither a frequent line nor the many windows around one place are gathered.
    """
    place = F.xxhash64("id", "mark", "at")
    places = windows.groupBy("low").agg(F.min(place).alias("one"), F.max(place).alias("other"))
    return windows.join(places.where("one <> other").select("low"), "low", "left_semi")


def repeated_runs(docs: DataFrame, id: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """(id, mark, runs): per text with repeated passages, its runs of lines (start, end) that came earlier.

    Texts are ordered by id, then by a hash of the text.  A passage that comes again in
    one text counts from the second time, if the two do not overlap.
    """
    windows = _around_shared(cut(_windows(docs, id, text, min_words)))
    key = ["low", "content", "words"]
    originals = (
        windows.groupBy(*key)
        .agg(F.min(F.struct("id", "mark", "start", "end")).alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1")
        .drop("n")
    )
    later = windows.join(originals, key).where(
        "not (id <=> first.id) or mark <> first.mark or start > first.end"
    )
    spans = later.select("id", "mark", "start", "end").distinct()
    order = Window.partitionBy("id", "mark").orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    islands = spans.withColumn("new", (F.col("start") > F.coalesce(reach, F.lit(-1))).cast("int")).withColumn(
        "island", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))
    )
    runs = islands.groupBy("id", "mark", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("id", "mark").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def dedup_lines(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    min_words: int = MIN_WORDS,
    removed: str | None = None,
) -> DataFrame:
    """The rows of ``docs``, their texts without the runs of lines that came earlier.

    A run is deleted if it has ``min_words`` words or more; whatever repeats in shorter
    stretches stays.  All rows stay, even those with nothing left, whose text is empty.
    A null text stays null.  Rows that agree in id and text get the same result.
    ``removed`` names a column for the number of deleted lines.
    """
    runs = repeated_runs(docs, id, text, min_words)
    own, mark, spans = fresh("own_id", docs), fresh("own_mark", docs), fresh("runs", docs)
    found = runs.select(F.col("id").alias(own), F.col("mark").alias(mark), F.col("runs").alias(spans))
    joined = docs.join(found, col(id).eqNullSafe(F.col(own)) & (F.xxhash64(col(text)) == F.col(mark)), "left")
    left = F.filter(
        F.split(col(text), "\n"),
        lambda line, i: ~F.exists(F.col(spans), lambda r: (i >= r["start"]) & (i <= r["end"])),
    )
    shortened = F.when(F.col(spans).isNull(), col(text)).otherwise(F.array_join(left, "\n"))
    counted = F.coalesce(
        F.aggregate(F.col(spans), F.lit(0).cast("long"), lambda n, r: n + r["end"] - r["start"] + 1), F.lit(0).cast("long")
    )
    columns = [shortened.alias(c) if c == text else col(c) for c in docs.columns]
    return joined.select(*columns, *([counted.alias(removed)] if removed else []))
