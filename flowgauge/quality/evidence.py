"""Evidence of failed rules: which values broke them, and some of the rows, from the scan that judges them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowgauge.quality.rules import ValueRule

#: Unexpected values reported of a rule, and rows shown of it.
TOP_VALUES, EXAMPLES = 5, 5
#: Different values that the sketch of a rule keeps track of; a power of two that is three quarters full.
TRACKED = 768
_MAP = 1024

EVIDENCE = T.StructType(
    [
        T.StructField("suite", T.StringType()),
        T.StructField("check_name", T.StringType()),
        T.StructField("check_type", T.StringType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("column_name", T.StringType()),
        T.StructField("failed", T.LongType()),
        T.StructField("count_error", T.LongType()),
        T.StructField(
            "top_values", T.ArrayType(T.StructType().add("value", T.StringType()).add("rows", T.LongType()))
        ),
        T.StructField("examples", T.ArrayType(T.StringType())),
    ]
)


def count_error(failed: Column) -> Column:
    """By how many rows a reported count may be off: 3.5 of the rows per place of the sketch.

    Nothing is off while all different values fit, which the sketch does not tell; this bound holds always.
    Fixed value: the published error of frequent-items sketches, 3.5 / places.
    """
    return F.floor(failed * (3.5 / _MAP)).cast("long")


def _as_text(rule: ValueRule) -> Column:
    """What a rule judged, as text: the value, or the values of a pair with a bar between them."""
    parts = [F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("null")) for name in rule.reads]
    return parts[0] if len(parts) == 1 else F.concat_ws(" | ", *parts)


def evidence(
    df: DataFrame,
    rules: Sequence[ValueRule],
    suite: str,
    table: str,
    key: Sequence[str],
    top: int = TOP_VALUES,
    examples: int = EXAMPLES,
    seed: int = 42,
) -> DataFrame:
    """One row per rule: how many rows broke it, their most frequent values, and some of their keys.

    All rules are answered by aggregates of one scan, which hold a bounded state each:

    - ``top_values`` come from a sketch of frequent items over the broken values as text.  A count may be off by
      ``count_error`` rows; a value with more rows than that is in the sketch.  By rows, then value.
    - ``examples`` are ``key`` columns as JSON: the failing rows are dealt by a seeded hash of their key into
      as many slots as examples are wanted, and each slot keeps the row with its smallest
      hash.  So reruns agree whatever the partitions, and there are at most ``examples`` of them.

    A rule that nothing breaks has empty lists.  Rows that a rule does not judge break nothing.
    """
    place = F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in key])
    shown = F.to_json(F.struct(*[F.col(f"`{c}`") for c in key]), {"ignoreNullFields": "false"})
    rows = df.withColumns({"_place": place, "_shown": shown})
    figures, results = [], []
    for number, rule in enumerate(rules):
        broken = rule.judged(df) & F.coalesce(rule.broken(df), F.lit(False))
        value = F.when(broken, _as_text(rule))
        slots = []
        for slot in range(examples):
            own = broken & (F.pmod(F.col("_place"), F.lit(examples)) == slot)
            figures.append(F.min(F.when(own, F.struct("_place", "_shown"))).alias(f"r{number}_{slot}"))
            slots.append(F.col(f"r{number}_{slot}._shown"))
        failed, frequent = f"r{number}_failed", f"r{number}_top"
        # Rows that are in order count as null in the sketch; they take one place and are left out below.
        sketch = F.call_function("approx_top_k", value, F.lit(top + 1), F.lit(TRACKED))
        figures += [F.count_if(broken).alias(failed), sketch.alias(frequent)]
        listed = F.filter(F.col(frequent), lambda x: x["item"].isNotNull())
        ordered = F.sort_array(F.transform(listed, lambda x: F.struct((-x["count"]).alias("n"), x["item"].alias("item"))))
        fields = {
            "suite": F.lit(suite),
            "check_name": F.lit(rule.check_name(table)),
            "check_type": F.lit(rule.kind),
            "table_name": F.lit(table),
            "column_name": F.lit(rule.column_label),
            "failed": F.col(failed),
            "count_error": count_error(F.col(failed)),
            "top_values": F.slice(F.transform(ordered, lambda x: F.struct(x["item"], -x["n"])), 1, top),
            "examples": F.sort_array(F.filter(F.array(*slots), lambda x: x.isNotNull())),
        }
        results.append(F.struct(*[fields[f.name].cast(f.dataType).alias(f.name) for f in EVIDENCE]))
    return rows.agg(*figures).select(F.inline(F.array(*results)))
