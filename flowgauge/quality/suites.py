"""Rule suites for the two raw tables; running, storing and summing them up."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowgauge.quality.rules import Between, InSet, NotNull, PairOrder, Rule, run_rules
from flowgauge.schemas import RUN_STATES, TASK_STATES


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    rules: tuple[Rule, ...]


def _required(*columns: str) -> list[Rule]:
    return [NotNull(column=name, note=f"every row needs a value in {name}") for name in columns]


def _timing() -> list[Rule]:
    return [
        Between(column="duration", min_value=0, note="a known duration is never negative"),
        PairOrder(column="end_date", other="start_date", note="work cannot stop before it starts"),
    ]


def dag_runs_suite() -> Suite:
    state = InSet(column="state", values=RUN_STATES, note="only states the scheduler knows for runs")
    return Suite(
        "dag_runs_suite", "dag_runs", (*_required("dag_id", "execution_date"), state, *_timing())
    )


def task_instances_suite() -> Suite:
    state = InSet(column="state", values=TASK_STATES, note="only states the scheduler knows for tasks")
    tries = Between(column="try_number", min_value=1, note="the first attempt is number 1")
    return Suite(
        "task_instances_suite",
        "task_instances",
        (*_required("dag_id", "task_id", "execution_date"), state, tries, *_timing()),
    )


def run_suite(df: DataFrame, suite: Suite) -> DataFrame:
    """Result rows of a suite: one scan of ``df``, whatever the number of rules."""
    return run_rules(df, suite.rules, suite.name, suite.table)


def statistics(results: DataFrame) -> DataFrame:
    """Per suite: success, number of rules by outcome, and percent of rules met."""
    met, total = F.count_if("passed"), F.count(F.lit(1))
    return results.groupBy("suite").agg(
        F.bool_and("passed").alias("success"),
        total.alias("evaluated_rules"),
        met.alias("successful_rules"),
        (total - met).alias("unsuccessful_rules"),
        (met * 100.0 / total).alias("success_percent"),
    )


_KINDS = {rule.kind: rule for rule in (NotNull, InSet, Between, PairOrder)}


def rule_dict(rule: Rule) -> dict:
    """The rule as plain data, settings left at None omitted."""
    return {"kind": rule.kind, **{k: v for k, v in asdict(rule).items() if v is not None}}


def suite_dict(suite: Suite) -> dict:
    """The suite as plain data, ready for JSON."""
    return {"suite": suite.name, "table_name": suite.table, "rules": [*map(rule_dict, suite.rules)]}


def suite_rows(suite: Suite) -> list[dict]:
    """The suite as table rows (suite, table_name, position, check_name, rule)."""
    return [
        {
            "suite": suite.name,
            "table_name": suite.table,
            "position": position,
            "check_name": rule.check_name(suite.table),
            "rule": json.dumps(rule_dict(rule), sort_keys=True),
        }
        for position, rule in enumerate(suite.rules)
    ]


RULES_TABLE = "suite string, table_name string, position int, check_name string, rule string"


def suite_from_rows(rows: Iterable[Mapping]) -> Suite:
    """The suite stored by ``suite_rows``; accepts dicts or the rows of a rules table."""
    plain = [row if isinstance(row, dict) else row.asDict() for row in rows]
    ordered = sorted(plain, key=lambda row: row["position"])
    rules = []
    for row in ordered:
        settings = json.loads(row["rule"])
        rule = _KINDS[settings.pop("kind")]
        if "values" in settings:
            settings["values"] = tuple(settings["values"])
        rules.append(rule(**settings))
    return Suite(ordered[0]["suite"], ordered[0]["table_name"], tuple(rules))
