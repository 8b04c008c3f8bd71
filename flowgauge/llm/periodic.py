"""Periodic runs: stretches of words that repeat one after the other.

Words of a text are numbers, and its suffixes are sorted.  The LCP-interval tree over
the sorted suffixes is gone through from the bottom up; an interval of ``n`` words holds
the places of a passage of ``n`` words, in order, each with its class, which is the
word to its left.  Where two intervals meet in a larger one, places of different children
and different classes are maximal pairs: neither the word before nor the word after
the two is the same.  A maximal pair of ``n`` words at a distance ``d`` is a run of ``n + d``
words with period ``d``, so pairs whose distance is small enough are the runs, and
nothing has to be extended.

Only neighbours in the order of an interval's places are looked at.  Were there a place
between the two of a pair, the passage would have a smaller period, which is that of the run.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import WORD, col, ship

ship(__name__)

#: A run has so many words at least, and is so many times as long as its period.
MIN_LENGTH, MIN_EXPONENT = 6, 4
#: Words whose suffixes are sorted together; a longer text is sorted by itself.
BLOCK_WORDS = 1 << 17

RUNS = T.ArrayType(T.StructType().add("start", "long").add("length", "long").add("period", "long"))


def least_overlap(min_length: int, exponent: int) -> int:
    """The fewest words of a maximal pair that makes a run."""
    return min(max(min_length - d, (exponent - 1) * d) for d in range(1, min_length + 1))


def sorted_suffixes(keys: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of suffixes in sorted order, and how many keys each shares with the one before.

    Only suffixes that share ``least`` keys with another one are there; 0 keys stand where
    fewer than that are shared.  Sorted by doubling: ranks by 1, 2, 4, ... keys, where
    only ranks that several suffixes have are sorted further.  The last key has to be unique.
    """
    n = len(keys)
    _, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse].astype(np.int32)
    levels, width = [rank.copy()], 1
    tied = np.flatnonzero(counts[inverse] > 1)
    some = tied
    while len(tied):
        key = rank[tied].astype(np.int64) * n + rank[tied + width]
        order = np.argsort(key, kind="stable")
        tied, key = tied[order], key[order]
        old = rank[tied]
        places = np.arange(len(tied), dtype=np.int32)
        new = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.maximum.accumulate(np.where(np.concatenate([[True], old[1:] != old[:-1]]), places, 0))
        rank[tied] = old + np.maximum.accumulate(np.where(new, places, 0)) - group
        sizes = np.diff(np.concatenate([np.flatnonzero(new), [len(tied)]]))
        tied = tied[np.repeat(sizes > 1, sizes)]
        width *= 2
        levels.append(rank.copy())
        some = tied if width <= least else some
    order = some[np.argsort(rank[some])]
    shared = np.zeros(len(order), np.int64)
    if len(order) > 1:
        a, b, same = order[:-1], order[1:], shared[1:]
        for k in reversed(range(len(levels))):
            same += (levels[k][a + same] == levels[k][b + same]).astype(np.int64) << k
        shared[shared < least] = 0
    return order, shared


def _near(order: np.ndarray, shared: np.ndarray, times: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffixes with another one of their group so near that both may be a pair of a run."""
    n = len(order)
    if not n:
        return order, shared
    most = np.maximum(shared, np.append(shared[1:], 0))
    group = np.cumsum(shared == 0)
    by_place = np.lexsort([order, group])
    gap = np.diff(order[by_place]).astype(np.float64)
    gap[np.diff(group[by_place]) != 0] = np.inf
    nearest = np.empty(n)
    nearest[by_place] = np.minimum(np.append(np.inf, gap), np.append(gap, np.inf))
    kept = np.flatnonzero(nearest * times <= most)
    if not len(kept):
        return order[:0], shared[:0]
    between = np.minimum.reduceat(shared[: kept[-1] + 1], kept[:-1] + 1) if len(kept) > 1 else np.zeros(0, np.int64)
    return order[kept], np.append(0, between)


def maximal_pairs(places: list[int], shared: list[int], left: list[int], min_length: int, exponent: int) -> dict:
    """{(start, length): smallest period} of all runs, from the LCP-interval tree, bottom up.

    ``left`` is the class of every place of the text.  Of two intervals the smaller is put into the larger.
    """
    runs: dict[tuple[int, int], int] = {}

    def meet(one: list[int], two: list[int], words: int) -> list[int]:
        large, small = (one, two) if len(one) >= len(two) else (two, one)
        reach = words // (exponent - 1)
        for x in small:
            at = bisect_left(large, x)
            for y in large[max(at - 1, 0) : at + 1]:
                apart = abs(x - y)
                if apart <= reach and words + apart >= min_length and left[x] != left[y]:
                    key = (min(x, y), words + apart)
                    if apart < runs.get(key, apart + 1):
                        runs[key] = apart
        for x in small:
            if large[-1] < x:
                large.append(x)
            else:
                insort(large, x)
        return large

    path: list[list] = []  # open intervals from the root down: words, places of the children that are done
    for k in range(len(places)):
        done, words = [places[k]], shared[k + 1] if k + 1 < len(places) else 0
        while path and path[-1][0] > words:
            inner, before = path.pop()
            done = meet(before, done, inner)
        if path and path[-1][0] == words:
            path[-1][1] = meet(path[-1][1], done, words)
        elif words:
            path.append([words, done])
    return runs


def runs_of(texts: list[list[bytes]], min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT) -> list[np.ndarray]:
    """Per text its runs as rows (start, length, period), by start, then period."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    number: dict[bytes, int] = {}
    parts = [np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words)) for words in texts]
    # A word is another one in another text, and a key of its own ends every text.
    many = len(number) + 1
    keys = np.concatenate([np.append(part, many - 1) + i * many for i, part in enumerate(parts)] or [np.zeros(0, np.int64)])
    ends = np.cumsum(sizes + 1)
    order, shared = _near(*sorted_suffixes(keys, least_overlap(min_length, exponent)), exponent - 1) if len(keys) else ([], [])
    if not len(order):
        return [np.zeros((0, 3), np.int64) for _ in texts]
    left = np.append(-1, keys[:-1])
    found = maximal_pairs(order.tolist(), shared.tolist(), left.tolist(), min_length, exponent)
    rows = np.array([(a, n, d) for (a, n), d in found.items()], np.int64).reshape(-1, 3)
    rows = rows[np.lexsort([rows[:, 2], rows[:, 0]])]
    of = np.searchsorted(ends, rows[:, 0], side="right")
    rows[:, 0] -= (ends - sizes - 1)[of]
    cuts = np.searchsorted(of, np.arange(len(texts) + 1))
    return [rows[a:b] for a, b in zip(cuts, cuts[1:])]


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """The words but for those of a run after its first period."""
    if len(runs):
        change = np.zeros(len(words) + 1, np.int64)
        np.add.at(change, runs[:, 0] + runs[:, 2], 1)
        np.add.at(change, runs[:, 0] + runs[:, 1], -1)
        words = [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
    return b" ".join(words)


def periodic_runs(
    docs: DataFrame, id: str = "doc_id", text: str = "text", min_length: int = MIN_LENGTH, exponent: int = MIN_EXPONENT
) -> DataFrame:
    """(id, runs, collapsed) of every row's whole text.

    ``runs`` are (start, length, period) in words, by start, then period: stretches of
    ``min_length`` words and ``exponent`` times their smallest period, or more, that no word beside
    them extends.  ``collapsed`` is the text with only the first period of every run, its words
    joined by one space.  Empty and null texts, and those of white space, have no runs and
    collapse to an empty text.  Null ids and repeated rows come out as they came in.  Rows
    are worked on where they are; nothing is shuffled.
    """
    if exponent < 2 or min_length < 1:
        raise ValueError("a run has one word and twice its period at least")
    narrow = docs.select(col(id).alias("id"), F.coalesce(col(text), F.lit("")).cast("binary").alias("text"))
    schema = T.StructType([T.StructField(id, narrow.schema["id"].dataType)]).add("runs", RUNS).add("collapsed", "string")

    def block(ids, texts):
        runs = runs_of(texts, min_length, exponent)
        flat = np.concatenate(runs)
        offsets = np.append(0, np.cumsum([len(r) for r in runs])).astype(np.int32)
        parts = [pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)]
        listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, ["start", "length", "period"]))
        short = pa.array([collapsed(w, r) for w, r in zip(texts, runs)], pa.binary()).cast(pa.string())
        return pa.RecordBatch.from_arrays([ids, listed, short], schema.names)

    def run(batches):
        for batch in batches:
            since, size, texts = 0, 0, []
            for i, value in enumerate(batch.column(1)):
                words = value.as_py().split()
                if texts and size + len(words) > BLOCK_WORDS:
                    yield block(batch.column(0).slice(since, len(texts)), texts)
                    since, size, texts = i, 0, []
                size += len(words)
                texts.append(words)
            if texts:
                yield block(batch.column(0).slice(since, len(texts)), texts)

    return narrow.mapInArrow(run, schema)


def with_planted_runs(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, text): the texts of one id in ten turn periodic from some word on, all others are as they were.

    With h the crc32 of the id as text and g its tenth part, the words from the ``g % n``-th on
    repeat their first ``p`` ones, where ``p`` makes 3 to 10 periods and a bit of them.  A
    null id has no hash, and its text stays.
    """
    draw = F.crc32(col(id).cast("string").cast("binary"))
    rows = docs.select(col(id).alias(id), col(text).alias("text"), draw.alias("h"))
    words = F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    rows = rows.withColumn("words", words).withColumn("n", F.size("words")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    rows = rows.withColumn("p", F.floor((F.col("n") - F.col("a")) / (F.col("g") % 8 + 3)) + 1)

    def source(i: Column) -> Column:
        return F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p"))

    planted = F.transform("words", lambda _, i: F.get("words", source(i).cast("int")))
    return rows.select(id, F.when(F.col("a").isNotNull(), F.array_join(planted, " ")).otherwise(F.col("text")).alias(text))
