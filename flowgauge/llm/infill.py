"""Fill-in-the-middle: texts cut at two ranks and put together in another order.

A text is a row of units (words with the white space before them).  An indexable skip
list over the units has express lanes whose links carry two widths, the units and the
code points that they span.  A search for a rank goes down from the widest lane, adds
up both widths on its way, and so ends at the exact place of the cut.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.llm.common import col, ship

ship(__name__)

#: What stands before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Links of a lane that one link of the next lane spans.
FAN = 8
#: Code points looked at together, which bounds the memory of very long texts.
SLICE = 1 << 20


def unit_ends(text: str) -> np.ndarray:
    """Where each unit ends, in code points: after every word, and after white space at the end of the text."""
    ends = []
    for i in range(0, len(text), SLICE):
        codes = np.frombuffer(text[i : i + SLICE + 1].encode("utf-32-le", "surrogatepass"), "<u4")
        space = (codes == 32) | ((codes >= 9) & (codes <= 13))
        ends.append(np.flatnonzero(~space[:-1] & space[1:]) + (i + 1))
    return np.concatenate([*ends, [len(text)]]) if text else np.zeros(0, np.int64)


class SkipList:
    """Units in order, under lanes of links; a link is (units, code points) that it spans."""

    def __init__(self, points: np.ndarray):
        self.lanes = [(np.ones(len(points), np.int64), points)]
        while len(self.lanes[-1][0]) > FAN:
            starts = np.arange(0, len(self.lanes[-1][0]), FAN)
            self.lanes.append(tuple(np.add.reduceat(width, starts) for width in self.lanes[-1]))

    def place(self, rank: int) -> int:
        """Code points before the unit with this rank (from 0); all of them for the number of units."""
        passed, points, link = 0, 0, 0
        for units, widths in reversed(self.lanes):
            while link < len(units) and passed + units[link] <= rank:
                passed += int(units[link])
                points += int(widths[link])
                link += 1
            link *= FAN
        return points


def rearranged(text: str, one: int, two: int, infill: bool, suffix_first: bool) -> tuple:
    """(units, form, code points of prefix and of middle, output) of one text."""
    ends = unit_ends(text)
    n = len(ends)
    if not infill or not text or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    units = SkipList(np.diff(ends, prepend=0))
    first, second = sorted((units.place(one % (n + 1)), units.place(two % (n + 1))))
    prefix, middle, suffix = text[:first], text[first:second], text[second:]
    if suffix_first:
        return n, "spm", first, second - first, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", first, second - first, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    docs: DataFrame, id: str = "doc_id", text: str = "text", seed: int = 42, percent: int = 50, suffix_first: int = 80
) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output) of every row's whole text.

    Both cuts, whether a text is changed at all (``percent`` of 100 are) and whether its
    suffix comes first (``suffix_first`` of 100 do) follow from a hash of ``seed`` and
    id, so reruns agree, and repeated rows come out alike.  A null id counts as an empty one.
    Empty and null texts, and those that hold a marker, stay as they are: ``plain``,
    without prefix and middle.  A cut may leave a part empty.  Rows are worked on
    where they are; nothing is shuffled.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(col(id).cast("string"), F.lit(""))), 256)
    draws = [F.conv(F.substring("digest", 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]
    narrow = docs.select(col(id).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"), digest.alias("digest")).select(
        "id",
        "text",
        draws[0].alias("one"),
        draws[1].alias("two"),
        (draws[2] % 100 < percent).alias("infill"),
        (draws[3] % 100 < suffix_first).alias("suffix_first"),
    )
    schema = (
        T.StructType([T.StructField(id, narrow.schema["id"].dataType)])
        .add("n", "long")
        .add("form", "string")
        .add("prefix_chars", "long")
        .add("middle_chars", "long")
        .add("output", "string")
    )
    kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())

    def run(batches):
        for batch in batches:
            rows = [rearranged(*(v.as_py() for v in row)) for row in zip(*batch.columns[1:])]
            columns = [pa.array(values, kind) for values, kind in zip(zip(*rows) if rows else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], schema.names)

    return narrow.mapInArrow(run, schema)


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from.

    An output that is not plain holds each marker once: no text with a marker is
    changed, and none can arise across a cut, as ``<`` comes first in a marker only.
    """
    parts = F.split(output, "|".join((PREFIX, SUFFIX, MIDDLE)), -1)
    psm = F.concat(parts[1], parts[3], parts[2])
    spm = F.concat(parts[2], parts[3], parts[1])
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
