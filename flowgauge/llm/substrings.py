"""Repeated passages of words, found through anchors at the places of a difference cover.

A cover of a period is a set of places in it whose differences give every number modulo the
period.  So for any two places of two texts there is a step below the period that
takes both to places of the cover.  Only passages that begin at such places are hashed (the
anchors, short enough for every window of the wanted length to hold the one at that
step); two equal windows always share an anchor that stands at the same step in both.
Shared anchors are then extended to windows: every window around one is hashed
whole, and those that come more than once are repeats.

Texts travel in blocks.  Hashes of a block go out in packs, one per part of the hash
space, each hash once a block; so neither a frequent passage nor a group of copies
meets anywhere in more rows than there are blocks, and no pairs are made.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, cut, ship

ship(__name__)

#: Words of a passage.
MIN_WORDS = 35
#: Periods and the smallest difference covers of them (perfect difference sets).
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 57: (0, 1, 3, 13, 32, 36, 43, 52)}
#: Bytes of text in a block; a longer text is a block by itself.
BLOCK_BYTES = 8 << 20
#: Bytes of text that are hashed together.
SLICE_BYTES = 1 << 18
#: Bytes of text whose hashes one part of the hash space takes, which bounds the memory of a task.
PART_BYTES = 16 << 20

#: An odd number whose powers tell the places of a passage apart, and its inverse modulo 2**64.
FACTOR = 0x9E3779B97F4A7C15
INVERSE = pow(FACTOR, -1, 1 << 64)

BLOCK = "id {}, sizes binary, texts binary, bytes long"
PACK = "part int, block long, once binary, twice binary"
FOUND = "block long, found binary"


def cover_for(words: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors at least a third of the words, and its cover."""
    period = max(p for p in COVERS if p == 1 or 3 * (words - p + 1) >= words)
    return period, COVERS[period]


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    """Neighbouring rows as blocks: their ids, the sizes of their texts, all texts compressed.

    From here on a text is its words with one space between them.
    """
    ids, texts, size = [], [], 0

    def block():
        joined = b"".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        listed = pa.concat_arrays(ids)
        return pa.RecordBatch.from_arrays(
            [
                pa.ListArray.from_arrays(pa.array([0, len(listed)], pa.int32()), listed),
                pa.array([sizes.tobytes()], pa.binary()),
                pa.array([pa.Codec("zstd", compression_level=1).compress(joined, asbytes=True)], pa.binary()),
                pa.array([len(joined)], pa.int64()),
            ],
            ["id", "sizes", "texts", "bytes"],
        )

    for batch in batches:
        since = 0
        for i, value in enumerate(batch.column(1)):
            text = b" ".join(value.as_py().split())
            if texts and size + len(text) > BLOCK_BYTES:
                ids.append(batch.column(0).slice(since, i - since))
                yield block()
                ids, texts, size, since = [], [], 0, i
            texts.append(text)
            size += len(text)
        ids.append(batch.column(0).slice(since))
    if texts:
        yield block()


def _texts(sizes: bytes, packed: bytes, length: int) -> list[bytes]:
    joined = pa.decompress(packed, decompressed_size=length, codec="zstd", asbytes=True)
    ends = np.cumsum(np.frombuffer(sizes, np.int64)).tolist()
    return [joined[a:b] for a, b in zip([0, *ends], ends)]


def _sizes(texts: list[bytes]) -> np.ndarray:
    """Words of every text."""
    return np.fromiter((t.count(b" ") + 1 if t else 0 for t in texts), np.int64, len(texts))


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    found = np.array([[FACTOR], [INVERSE]], np.uint64).repeat(n, axis=1)
    found[:, 0] = 1
    return tuple(np.multiply.accumulate(found, axis=1))


def _passages(texts: list[bytes], sizes: np.ndarray, starts: np.ndarray, words: int) -> np.ndarray:
    """A hash of the ``words`` words from each start on, mixed; starts count the words of all texts, in order.

    It is the sum of a fixed random number for each byte times a power for its place, modulo 2**64:
    the difference of two running sums, times the inverse power that the start asks for.
    Some texts at a time, for the sake of caches.
    """
    of_byte = np.random.default_rng(42).integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
    lengths, ends, out = np.fromiter(map(len, texts), np.int64, len(texts)), np.cumsum(sizes), []
    group = (np.cumsum(lengths) - lengths) // SLICE_BYTES
    cuts = np.append(np.flatnonzero(np.diff(group, prepend=-1)), len(texts)).tolist()
    for a, b in zip(cuts, cuts[1:]):
        before = int(ends[a] - sizes[a])
        own = starts[np.searchsorted(starts, before) : np.searchsorted(starts, int(ends[b - 1]))] - before
        if not len(own):
            continue
        joined = np.frombuffer(b" ".join(filter(None, texts[a:b])), np.uint8)
        power, back = _powers(max(1 << (len(joined) - 1).bit_length(), 2 * SLICE_BYTES))
        running = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(of_byte[joined] * power[: len(joined)], out=running[1:])
        spaces = np.flatnonzero(joined == 32)
        first, last = np.append(0, spaces + 1)[own], np.append(spaces, len(joined))[own + (words - 1)]
        out.append((running[last] - running[first]) * back[first])
    total = np.concatenate(out or [np.zeros(0, np.uint64)])
    total ^= total >> np.uint64(32)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ (total >> np.uint64(32))


def _starts(sizes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """All places where ``words`` words of one text begin, in the block and in their text."""
    n = np.maximum(sizes - words + 1, 0)
    own = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    return own + np.repeat(np.cumsum(sizes) - sizes, n), own


def _anchors(texts: list[bytes], sizes: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the anchors and their hashes."""
    period, cover = cover_for(words)
    length = words - period + 1
    starts, own = _starts(sizes, length)
    at_cover = np.zeros(period, bool)
    at_cover[list(cover)] = True
    # A text too short for a window has no window to repeat.
    whole = np.repeat(sizes >= words, np.maximum(sizes - length + 1, 0))
    starts = starts[at_cover[own % period] & whole]
    return starts, _passages(texts, sizes, starts, length)


def _packs(block: int, hashes: np.ndarray, parts: int, kind: str) -> pa.RecordBatch:
    """The distinct hashes of a block, cut by the part that they belong to; ``twice`` are those that it has more than once.

    ``kind`` is the number type that is kept of a hash.  The part comes from its upper half.
    """
    values, counts = np.unique(hashes, return_counts=True)
    part = (((values >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)).astype(np.int64)
    kept = values.astype(kind)
    cuts = np.append(np.flatnonzero(np.diff(part, prepend=-1)), len(part)) if len(part) else np.zeros(1, np.int64)
    rows = list(zip(cuts.tolist(), cuts[1:].tolist()))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([int(part[a]) for a, _ in rows], pa.int32()),
            pa.array([block] * len(rows), pa.int64()),
            pa.array([kept[a:b].tobytes() for a, b in rows], pa.binary()),
            pa.array([kept[a:b][counts[a:b] > 1].tobytes() for a, b in rows], pa.binary()),
        ],
        ["part", "block", "once", "twice"],
    )


def _repeated(packs: DataFrame, kind: str) -> DataFrame:
    """(block, found): per block the hashes that come again, there or in another block, as ``part`` and hash."""

    def run(key, table):
        once = [np.frombuffer(x, kind) for x in table["once"].to_pylist()]
        twice = [np.frombuffer(x, kind) for x in table["twice"].to_pylist()]
        values, counts = np.unique(np.concatenate(once), return_counts=True)
        again = np.union1d(values[counts > 1], np.concatenate(twice)).astype("<u8")
        out = {"block": [], "found": []}
        for block, own in zip(table["block"].to_pylist(), once):
            found = own[_among(own.astype("<u8"), again)]
            if len(found):
                out["block"].append(block)
                out["found"].append(_with_part(found, key[0].as_py(), kind).tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int64()), "found": pa.array(out["found"], pa.binary())})

    return packs.groupBy("part").applyInArrow(run, FOUND)


def _with_part(values: np.ndarray, part: int, kind: str) -> np.ndarray:
    """Whole hashes as they are; of shortened ones, the part above them."""
    return values if kind == "<u8" else values.astype("<u8") | np.uint64(part << 32)


def _found(table: pa.Table) -> np.ndarray:
    """All hashes found for a block, in order."""
    return np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in table["found"].to_pylist()] or [np.zeros(0, "<u8")]))


def _among(hashes: np.ndarray, found: np.ndarray) -> np.ndarray:
    """Which hashes are among those found, which are in order."""
    if not len(found):
        return np.zeros(len(hashes), bool)
    # Most are not, and a table of their last bits tells so at once.
    seen = np.zeros(1 << 22, bool)
    seen[found & np.uint64(len(seen) - 1)] = True
    maybe = np.flatnonzero(seen[hashes & np.uint64(len(seen) - 1)])
    some = hashes[maybe]
    out = np.zeros(len(hashes), bool)
    out[maybe[found[np.minimum(np.searchsorted(found, some), len(found) - 1)] == some]] = True
    return out


def _covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of ``n`` words lie within ``length`` words from one of the starts on."""
    change = np.zeros(n + length + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + length, -1)
    return np.cumsum(change)[:n] > 0


def _candidates(texts: list[bytes], found: np.ndarray, parts: int, words: int) -> np.ndarray:
    """Hashes of the windows of ``words`` words around shared anchors."""
    sizes = _sizes(texts)
    anchors, marks = _anchors(texts, sizes, words)
    part = ((marks >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
    shared = anchors[_among((part << np.uint64(32)) | (marks & np.uint64(0xFFFFFFFF)), found)]
    starts, _ = _starts(sizes, words)
    # A window holds an anchor at the places from its own start on, to its last word less an anchor's.
    reach = cover_for(words)[0] - 1
    near = _covered(np.maximum(shared - reach, 0), reach + 1, int(sizes.sum()))
    return _passages(texts, sizes, starts[near[starts]], words)


def _results(ids: pa.Array, texts: list[bytes], found: np.ndarray, words: int, names: list[str]) -> pa.Table:
    """Per text its words, how many of them lie in repeats, and the others."""
    sizes, kept = _sizes(texts), texts
    removed = np.zeros(len(texts), np.int64)
    if len(found):
        starts, _ = _starts(sizes, words)
        gone = _covered(starts[_among(_passages(texts, sizes, starts, words), found)], words, int(sizes.sum()))
        ends = np.cumsum(sizes)
        removed = np.add.reduceat(np.append(gone, False), ends - sizes, dtype=np.int64) * (sizes > 0)
        kept = [
            b" ".join(compress(text.split(b" "), (~gone[end - size : end]).tolist())) if n else text
            for text, size, end, n in zip(texts, sizes.tolist(), ends.tolist(), removed.tolist())
        ]
    left = pa.array(kept, pa.binary()).cast(pa.string())
    return pa.table([ids, pa.array(sizes), pa.array(removed), left], names)


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = MIN_WORDS) -> DataFrame:
    """(id, n_words, n_removed, kept) of every row: its text without repeated passages.

    A word goes if it lies in a window of ``words`` words that begins anywhere else, too: in
    another row, which may be a copy of this one, or in this one, overlapping or not.  Every
    copy goes, the first as well; windows are judged on the texts as they came.  ``kept``
    has the other words, joined by one space.  Null texts count as empty; texts of fewer
    words than a window keep all.  Null ids and repeated rows come out as they came in.
    """
    narrow = docs.select(col(id).alias("id"), F.coalesce(col(text), F.lit("")).cast("binary").alias("text"))
    kind = narrow.schema["id"].dataType
    # A settled order, so that a task that runs again makes the same blocks.
    packed = (
        narrow.sortWithinPartitions("id", F.xxhash64("text"))
        .mapInArrow(_blocks, BLOCK.format(T.ArrayType(kind).simpleString()))
        .withColumn("block", F.monotonically_increasing_id())
    )
    blocks = cut(packed)
    size = blocks.agg(F.sum("bytes")).first()[0] or 0
    parts = max(1, math.ceil(size / PART_BYTES))

    def rows(table) -> Iterator[tuple[int, list[bytes], pa.Array]]:
        columns = (table[c].to_pylist() for c in ("block", "sizes", "texts", "bytes"))
        for number, sizes, texts, length, ids in zip(*columns, (x.values for x in table["id"])):
            yield number, _texts(sizes, texts, length), ids

    def anchors(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                for number, texts, _ in rows(batch.slice(i, 1)):
                    yield _packs(number, _anchors(texts, _sizes(texts), words)[1], parts, "<u4")

    def windows(left, right):
        found = _found(right)
        out = [_packs(n, _candidates(t, found, parts, words), 4 * parts, "<u8") for n, t, _ in rows(left)] if len(found) else []
        kinds = pa.schema([("part", pa.int32()), ("block", pa.int64()), ("once", pa.binary()), ("twice", pa.binary())])
        return pa.Table.from_batches(out, kinds)

    schema = T.StructType([T.StructField(id, kind)]).add("n_words", "long").add("n_removed", "long").add("kept", "string")

    def results(left, right):
        found = _found(right)
        return pa.concat_tables([_results(ids, texts, found, words, schema.names) for _, texts, ids in rows(left)])

    shared = _repeated(blocks.mapInArrow(anchors, PACK), "<u4")
    around = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(windows, PACK)
    repeats = _repeated(around, "<u8")
    return blocks.groupBy("block").cogroup(repeats.groupBy("block")).applyInArrow(results, schema)
