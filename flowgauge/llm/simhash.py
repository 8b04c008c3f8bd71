"""SimHash near-duplicates, found by pigeonring filtering.

A fingerprint of 64 bits is cut into a ring of segments.  If two fingerprints differ
in at most ``t`` bits, the ring has a start from which the differences of the first
1, 2, 3, ... segments add up to at most 1, 2, 3, ... times ``t / segments`` each.
Pairs meet on the first segments of such a chain and have to keep within every
further budget, the last of which is the full Hamming check.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, cut, fresh, ship, tidy
from flowgauge.llm.graph import components

ship(__name__)

SEGMENTS = 8
BITS = 64 // SEGMENTS
#: Fingerprints under one key beyond which they are linked through middle points.
HOT_KEY = 256
#: Shingles hashed at a time, which bounds the memory of very long texts.
SLICE = 1 << 16


def shingle_hashes(text: bytes | None, words: int, seed: int = 42) -> Iterator[np.ndarray]:
    """XXH64 of every shingle of a text, repeats included, some at a time."""
    import xxhash

    found = (text or b"").lower().split()
    if not found:
        return
    joined = b" ".join(found)
    ends = np.cumsum(np.fromiter(map(len, found), np.int64, len(found)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    span = min(words, len(found)) - 1
    last = len(found) - span
    hashed = xxhash.xxh64_intdigest
    for i in range(0, last, SLICE):
        j = min(last, i + SLICE)
        pairs = zip(starts[i:j].tolist(), ends[i + span : j + span].tolist())
        yield np.array([hashed(joined[x:y], seed) for x, y in pairs], "<u8")


def fingerprint(text: bytes | None, words: int) -> int:
    """A bit is 1 if it is 1 in over half of the hashes; 0 if there is no word."""
    ones, n = np.zeros(64, np.int64), 0
    for h in shingle_hashes(text, words):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
        n += len(h)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """(node, fingerprint) of every row; the fingerprint is a signed long.

    A null text counts as empty; texts without a word have fingerprint 0.
    """
    narrow = docs.select(col(id).alias("node"), col(text).cast("binary").alias("text"))

    def run(batches):
        for batch in batches:
            marks = pa.array([fingerprint(t.as_py(), words) for t in batch.column(1)], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), marks], ["node", "fingerprint"])

    schema = T.StructType([narrow.schema["node"], T.StructField("fingerprint", T.LongType())])
    return narrow.mapInArrow(tidy(run), schema)


def _budgets(bits: int) -> list[int]:
    return [n * bits // SEGMENTS for n in range(1, SEGMENTS + 1)]


def _masks(bits: int, length: int) -> list[int]:
    """Parts of a key of which the first ``length`` segments of a chain share one at least.

    A segment with no difference is shared whole, one with a single difference in one of its halves.
    """
    half, budgets, found = BITS // 2, _budgets(bits), set()
    for weights in product(range(budgets[length - 1] + 1), repeat=length):
        if all(sum(weights[: i + 1]) <= budgets[i] for i in range(length)):
            halves = [[3] if w == 0 else [1, 2] if w == 1 else [0] for w in weights]
            for parts in product(*halves):
                at = [BITS * i + half * h for i, p in enumerate(parts) for h in (0, 1) if p >> h & 1]
                found.add(sum(((1 << half) - 1) << x for x in at))
    return sorted(m for m in found if not any(x != m and x & m == x for x in found))


def _key_length(bits: int) -> int:
    """Segments a key takes: all that must agree, two at least."""
    return max(2, sum(b == 0 for b in _budgets(bits)))


def _turned(start: Column, mark: Column) -> Column:
    """The fingerprint turned so that segment ``start`` comes first."""
    shift = start * BITS
    right = F.call_function("shiftrightunsigned", mark, shift)
    left = F.call_function("shiftleft", mark, (64 - shift) % 64)
    return F.when(start == 0, mark).otherwise(right.bitwiseOR(left))


def _index(marks: DataFrame, length: int) -> DataFrame:
    """(fingerprint, start, turned, key): every fingerprint under the key of each start."""
    starts = F.explode(F.array(*map(F.lit, range(SEGMENTS)))).alias("start")
    turned = marks.select("*", starts).withColumn("turned", _turned(F.col("start"), F.col("fingerprint")))
    return turned.withColumn("key", F.col("turned").bitwiseAND(F.lit((1 << (BITS * length)) - 1)))


def _crowded(index: DataFrame, above: float) -> DataFrame:
    """(start, key): keys that more than ``above`` rows of an index share."""
    return index.groupBy("start", "key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > above).select("start", "key")


def _chain(apart: Column, bits: int) -> Column:
    """Whether the differences of a turned pair keep within every budget."""
    within = F.lit(True)
    for n, budget in enumerate(_budgets(bits), 1):
        part = apart.bitwiseAND(F.lit((1 << (BITS * n)) - 1)) if n < SEGMENTS else apart
        within &= F.bit_count(part) <= budget
    return within


def _cells(index: DataFrame, bits: int, length: int) -> DataFrame:
    """Every row of an index under each shared part of its key, as ``cell``."""
    shift = F.call_function("shiftleft", F.col("start").cast("long"), F.lit(40))
    cells = [
        F.col("key").bitwiseAND(F.lit(m)).bitwiseOR(F.lit(i << 32)).bitwiseOR(shift)
        for i, m in enumerate(_masks(bits, length))
    ]
    return index.withColumn("cell", F.explode(F.array(*cells)))


def close_pairs(marks: DataFrame, bits: int, length: int | None = None) -> DataFrame:
    """(a, b) with a < b: different fingerprints of ``marks`` that differ in at most ``bits`` bits.

    ``marks`` has one column, ``fingerprint``, of distinct longs.  A pair may come more
    than once.  Where more than ``HOT_KEY`` fingerprints share a key and ``bits`` is at
    most 2, these come as stars instead of pairs: two fingerprints at most 2 apart have
    a neighbour at distance 1 or less in common, so linking all that share such a
    neighbour to the smallest of them links the same groups, with 65 rows for each.
    ``length`` is the number of segments that a key takes.
    """
    if not 0 < bits < SEGMENTS:
        raise ValueError(f"bits must be between 1 and {SEGMENTS - 1}")
    length, stars = length or _key_length(bits), None
    index = _index(marks.select("fingerprint"), length)
    if bits <= 2:
        crowded = cut(_crowded(index, HOT_KEY))
        if not crowded.isEmpty():
            stars = _stars(index.join(crowded, ["start", "key"]).select("fingerprint").distinct())
            index = index.join(crowded, ["start", "key"], "left_anti")
    index = _cells(index, bits, length).select("fingerprint", "turned", "cell")
    a, b = index.alias("a"), index.alias("b")
    within = (F.col("a.cell") == F.col("b.cell")) & (F.col("a.fingerprint") < F.col("b.fingerprint"))
    within &= _chain(F.col("a.turned").bitwiseXOR(F.col("b.turned")), bits)
    pairs = a.join(b, within).select(F.col("a.fingerprint").alias("a"), F.col("b.fingerprint").alias("b"))
    return pairs.unionByName(stars) if stars is not None else pairs


def _stars(marks: DataFrame) -> DataFrame:
    flips = [0] + [(1 << i) - (1 << 64 if i == 63 else 0) for i in range(64)]
    around = marks.withColumn("near", F.explode(F.array(*[F.col("fingerprint").bitwiseXOR(F.lit(x)) for x in flips])))
    centre = around.groupBy("near").agg(F.min("fingerprint").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return (
        around.join(centre, "near").where("a <> fingerprint").select("a", F.col("fingerprint").alias("b")).distinct()
    )


def simhash_groups(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """(id, fingerprint as 16 hex digits, component_id) of every row.

    ``component_id`` is the smallest id that can be reached over fingerprints that
    differ in at most ``bits`` bits, the row's own id included.  Rows with equal
    fingerprints link; so all texts without a word form one group.  Rows with a
    null id keep their fingerprint's group but never name it, unless it has no
    other id.  Repeated rows come out as often as they came in.
    """
    rows = cut(fingerprints(docs, id, text, words))
    marks = cut(rows.groupBy("fingerprint").agg(F.min("node").alias("node")))
    linked = components(close_pairs(marks.select("fingerprint"), bits))
    named = marks.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", F.coalesce("component", "fingerprint").alias("group"), F.col("node").alias("least")
    )
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    of_mark = named.join(least, "group").select("fingerprint", "component_id")
    return rows.join(of_mark, "fingerprint").select(
        F.col("node").alias(id),
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def drop_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2
) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group of ``simhash_groups`` one row stays.

    It is the one with the smallest id, null ids last, and of equal ids the one whose text has the
    smallest hash.  Of rows that agree in id and text one stays, whatever their other
    columns.  Texts without a word, null ones too, are one group.
    """
    node = F.struct(col(id).isNull().alias("unnamed"), col(id).alias("id"), F.xxhash64(col(text)).alias("mark"))
    rows = cut(fingerprints(docs.select(node.alias("n"), col(text).alias("t")), "n", "t", words))
    marks = cut(rows.groupBy("fingerprint").agg(F.min("node").alias("node")))
    linked = components(close_pairs(marks.select("fingerprint"), bits)).withColumnRenamed("node", "fingerprint")
    named = marks.join(linked, "fingerprint", "left")
    kept = named.groupBy(F.coalesce("component", "fingerprint")).agg(F.min("node").alias("node"))
    # Plain keys without nulls: the join and the last step then share one shuffle of the texts.
    keys = [fresh(f"own_{k}", docs) for k in ("unnamed", "id", "mark")]
    values = (col(id).isNull(), F.coalesce(col(id).cast("string"), F.lit("")), F.coalesce(F.xxhash64(col(text)), F.lit(0)))
    marked = docs.withColumns(dict(zip(keys, values)))
    found = kept.select(
        F.col("node.unnamed").alias(keys[0]),
        F.coalesce(F.col("node.id").cast("string"), F.lit("")).alias(keys[1]),
        F.col("node.mark").alias(keys[2]),
    )
    return marked.join(found, keys, "left_semi").dropDuplicates(keys).select(*[col(c) for c in docs.columns])
