"""The same answers as plain SQL for DuckDB, over the driver's tables.

Rates are rounded half up in whole hundredths with integers, because DuckDB
divides numerics as doubles.
"""

from __future__ import annotations

import json

# Written out here, so that a wrong state set or rule text on the other side shows.
RUN_STATES = (
    "success", "failed", "running", "queued", "scheduled", "skipped", "up_for_retry", "up_for_reschedule",
    "upstream_failed", "none",
)
TASK_STATES = (
    "success", "failed", "running", "queued", "scheduled", "skipped", "up_for_retry", "up_for_reschedule",
    "upstream_failed", "removed", "restarting", "none",
)
RESULT_COLUMNS = {
    "suite": "VARCHAR",
    "check_name": "VARCHAR",
    "check_type": "VARCHAR",
    "table_name": "VARCHAR",
    "column_name": "VARCHAR",
    "passed": "BOOLEAN",
    "evaluated": "BIGINT",
    "failed": "BIGINT",
    "observed": "DOUBLE",
    "threshold": "DOUBLE",
    "error": "VARCHAR",
    "message": "VARCHAR",
}


def _percentile(q: float) -> str:
    """Interpolated percentile of the durations of a group, from the sorted values themselves.

    ``quantile_cont`` means the same, but interpolates in another order of
    operations and so may differ in the last bit.
    """
    values = "list(calculated_duration ORDER BY calculated_duration) FILTER (calculated_duration IS NOT NULL)"
    place = f"({q}::DOUBLE * (count(calculated_duration) - 1))"
    low = f"({values})[CAST(floor({place}) AS BIGINT) + 1]"
    high = f"({values})[CAST(ceil({place}) AS BIGINT) + 1]"
    return f"{low} + ({high} - {low}) * ({place} - floor({place}))"


_BASE = f"""
base AS (
  SELECT event_id, event_type AS kind,
         CASE user_id % 10 WHEN 0 THEN 'critical_' WHEN 1 THEN 'daily_' WHEN 2 THEN 'daily_'
              ELSE 'adhoc_' END || CAST(user_id % 10 AS VARCHAR) AS dag_id,
         ts AS execution_date,
         CAST(round(value * 100) AS BIGINT) AS secs,
         ts + to_seconds(event_id % 60) AS start_date,
         ts + to_days(1) AS extracted_at
  FROM events),
run_states AS (
  SELECT *, CASE kind WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'running'
                      WHEN 'signup' THEN 'queued' ELSE 'success' END AS state
  FROM base),
dag_runs AS (
  SELECT dag_id, execution_date, state, start_date,
         CASE WHEN state NOT IN ('running', 'queued') THEN start_date + to_seconds(secs) END AS end_date,
         CASE WHEN state NOT IN ('running', 'queued') AND event_id % 5 <> 0
              THEN CAST(secs AS DOUBLE) END AS duration,
         extracted_at
  FROM run_states),
task_states AS (
  SELECT base.*, task_id, k, secs * k AS task_secs,
         CASE WHEN kind = 'error' AND k = 3 THEN 'failed'
              WHEN kind = 'error' AND k = 2 THEN 'up_for_retry'
              WHEN kind = 'purchase' AND k = 3 THEN 'running' ELSE 'success' END AS state
  FROM base, (VALUES ('extract', 1), ('transform', 2), ('load', 3)) AS names(task_id, k)),
task_instances AS (
  SELECT dag_id, task_id, execution_date, state, start_date,
         CASE WHEN state <> 'running' THEN start_date + to_seconds(task_secs) END AS end_date,
         CASE WHEN state <> 'running' AND event_id % 5 <> 0
              THEN CAST(task_secs AS DOUBLE) END AS duration,
         CAST(1 + (event_id + k) % 3 AS INTEGER) AS try_number,
         extracted_at
  FROM task_states),
stg_dag_runs AS (
  SELECT *, coalesce(duration, date_diff('microsecond', start_date, end_date) / 1e6)
            AS calculated_duration
  FROM dag_runs),
stg_task_instances AS (
  SELECT *, coalesce(duration, date_diff('microsecond', start_date, end_date) / 1e6)
            AS calculated_duration
  FROM task_instances),
timed_runs AS (
  SELECT *, date_trunc('day', execution_date) AS execution_day
  FROM stg_dag_runs WHERE calculated_duration IS NOT NULL),
timed_tasks AS (
  SELECT *, date_trunc('day', execution_date) AS execution_day,
         CASE WHEN contains(dag_id, 'critical') THEN 3600
              WHEN contains(dag_id, 'daily') THEN 7200 ELSE 10800 END AS sla_threshold_seconds
  FROM stg_task_instances WHERE calculated_duration IS NOT NULL),
daily_outcomes AS (
  SELECT dag_id, date_trunc('day', execution_date) AS execution_day, count(*) AS total_runs,
         count(*) FILTER (state = 'failed') AS failed_runs,
         count(*) FILTER (state = 'success') AS successful_runs,
         (failed_runs * 20000 + total_runs) // (2 * total_runs) AS failed_hundredths,
         (successful_runs * 20000 + total_runs) // (2 * total_runs) AS success_hundredths
  FROM stg_dag_runs GROUP BY ALL),
task_totals AS (
  SELECT dag_id, task_id, count(*) AS total_executions,
         avg(calculated_duration) AS avg_duration_seconds,
         max(calculated_duration) AS max_duration_seconds,
         {_percentile(0.95)} AS p95_duration_seconds,
         sum(calculated_duration) AS total_duration_seconds,
         count(*) FILTER (state = 'failed') AS failed_executions,
         count(*) FILTER (state = 'success') AS successful_executions,
         max(extracted_at) AS last_updated
  FROM timed_tasks GROUP BY dag_id, task_id),
ranked_tasks AS (
  SELECT *,
         row_number() OVER (ORDER BY avg_duration_seconds DESC NULLS LAST, dag_id NULLS FIRST, task_id NULLS FIRST)
           AS rank_by_avg_duration,
         row_number() OVER (ORDER BY max_duration_seconds DESC NULLS LAST, dag_id NULLS FIRST, task_id NULLS FIRST)
           AS rank_by_max_duration
  FROM task_totals),
sla_task_daily AS (
  SELECT dag_id, task_id, execution_day, sla_threshold_seconds, count(*) AS total_count,
         count(*) FILTER (calculated_duration > sla_threshold_seconds) AS sla_misses,
         count(*) FILTER (calculated_duration <= sla_threshold_seconds) AS sla_meets,
         ((sla_misses * 20000 + total_count) // (2 * total_count)) / 100::DOUBLE
           AS sla_miss_rate_percent,
         avg(calculated_duration) AS avg_duration_seconds,
         max(calculated_duration) AS max_duration_seconds
  -- Thresholds are per named task; a run without a name has none.
  FROM timed_tasks WHERE dag_id IS NOT NULL AND task_id IS NOT NULL GROUP BY ALL),
sla_dag_daily AS (
  SELECT dag_id, execution_day, 7200 AS sla_threshold_seconds, count(*) AS total_count,
         count(*) FILTER (calculated_duration > 7200) AS sla_misses,
         count(*) FILTER (calculated_duration <= 7200) AS sla_meets,
         ((sla_misses * 20000 + total_count) // (2 * total_count)) / 100::DOUBLE
           AS sla_miss_rate_percent,
         avg(calculated_duration) AS avg_duration_seconds,
         max(calculated_duration) AS max_duration_seconds
  FROM timed_runs GROUP BY dag_id, execution_day),
sla_misses AS (
  SELECT 'task' AS entity_type, task_id AS identifier, * EXCLUDE (task_id) FROM sla_task_daily
  UNION ALL BY NAME
  SELECT 'dag' AS entity_type, CAST(NULL AS VARCHAR) AS identifier, * FROM sla_dag_daily),
dag_runtime_metrics AS (
  SELECT dag_id, execution_day, count(*) AS total_runs,
         count(*) FILTER (state = 'success') AS successful_runs,
         count(*) FILTER (state = 'failed') AS failed_runs,
         avg(calculated_duration) AS avg_duration_seconds,
         min(calculated_duration) AS min_duration_seconds,
         max(calculated_duration) AS max_duration_seconds,
         {_percentile(0.5)} AS median_duration_seconds,
         {_percentile(0.95)} AS p95_duration_seconds,
         sum(calculated_duration) AS total_duration_seconds
  FROM timed_runs GROUP BY dag_id, execution_day),
dag_failure_rates AS (
  SELECT dag_id, execution_day, total_runs, failed_runs, successful_runs,
         failed_hundredths / 100::DOUBLE AS failure_rate_percent,
         success_hundredths / 100::DOUBLE AS success_rate_percent,
         CAST(sum(failed_hundredths) OVER (PARTITION BY dag_id ORDER BY execution_day
           ROWS 6 PRECEDING) AS BIGINT) / 100::DOUBLE / count(*) OVER (PARTITION BY dag_id
           ORDER BY execution_day ROWS 6 PRECEDING) AS rolling_7d_failure_rate,
         CAST(sum(failed_hundredths) OVER (PARTITION BY dag_id ORDER BY execution_day
           ROWS 29 PRECEDING) AS BIGINT) / 100::DOUBLE / count(*) OVER (PARTITION BY dag_id
           ORDER BY execution_day ROWS 29 PRECEDING) AS rolling_30d_failure_rate
  FROM daily_outcomes),
slowest_tasks AS (
  SELECT *, ((failed_executions * 20000 + total_executions) // (2 * total_executions))
            / 100::DOUBLE AS failure_rate_percent
  FROM ranked_tasks WHERE rank_by_avg_duration <= 10),
dirty AS (
  SELECT CASE WHEN event_id % 97 <> 0 THEN 'd' || CAST(user_id % 10 AS VARCHAR) END AS dag_id,
         'load' AS task_id,
         ts AS execution_date,
         CASE WHEN event_id % 89 = 0 THEN 'bogus' WHEN event_id % 83 = 0 THEN NULL
              WHEN event_type = 'error' THEN 'failed'
              WHEN event_type = 'purchase' THEN 'running' ELSE 'success' END AS state,
         ts AS start_date,
         CASE WHEN event_type <> 'purchase' THEN ts + to_seconds(
              CASE WHEN event_id % 79 = 0 THEN -60
                   ELSE CAST(round(value * 100) AS BIGINT) END) END AS end_date,
         CASE WHEN event_type <> 'purchase' THEN CAST(
              CASE WHEN event_id % 79 = 0 THEN -60
                   ELSE CAST(round(value * 100) AS BIGINT) END AS DOUBLE) END AS duration,
         CAST(CASE WHEN event_id % 71 = 0 THEN 0 ELSE 1 + event_id % 3 END AS INTEGER) AS try_number,
         ts + to_days(1) AS extracted_at
  FROM events),
stg_dirty AS (
  SELECT *, coalesce(duration, date_diff('microsecond', start_date, end_date) / 1e6)
            AS calculated_duration
  FROM dirty)
"""


def _sql(body: str) -> str:
    return f"WITH {_BASE.strip()}\n{body.strip()}"


#: The last moment of a number of daily loads from 2024-01-10 02:00 on, each of the day before it.
def _last_load(loads: int) -> str:
    return f"(TIMESTAMP '2024-01-10 02:00:00' + to_days({loads - 1}))"


def _late(relation: str, loads: int) -> str:
    """What is known of a relation after the loads: a run's end shows a day after it was scheduled."""
    ended = f"execution_date + to_days(1) <= {_last_load(loads)}"
    return f"""late_{relation} AS (
  SELECT * REPLACE (
    CASE WHEN {ended} OR state IN ('running', 'queued') THEN state ELSE 'running' END AS state,
    CASE WHEN {ended} THEN end_date END AS end_date,
    CASE WHEN {ended} THEN duration END AS duration)
  FROM {relation}
  WHERE execution_date BETWEEN TIMESTAMP '2024-01-09 02:00:00' AND {_last_load(loads)})"""


def _late_sql(body: str, loads: int) -> str:
    """A query over the same models, built on the history that is known after the loads."""
    base = _BASE.replace("FROM dag_runs),", "FROM late_dag_runs),").replace("FROM task_instances),", "FROM late_task_instances),")
    late = ",\n".join(_late(name, loads) for name in ("dag_runs", "task_instances"))
    return f"WITH {base.replace('stg_dag_runs AS (', late + ',\n' + 'stg_dag_runs AS (', 1).strip()}\n{body.strip()}"


_LOAD_MERGE = f"""
, placed AS (
  SELECT *, greatest(TIMESTAMP '2024-01-10 02:00:00',
                     CAST(ceil(date_diff('microsecond', TIMESTAMP '2024-01-10 02:00:00', execution_date) / 86400e6) AS INTEGER)
                     * INTERVAL 1 DAY + TIMESTAMP '2024-01-10 02:00:00') AS first_load,
         greatest(TIMESTAMP '2024-01-10 02:00:00',
                  CAST(ceil(date_diff('microsecond', TIMESTAMP '2024-01-09 02:00:00', execution_date) / 86400e6) AS INTEGER)
                  * INTERVAL 1 DAY + TIMESTAMP '2024-01-10 02:00:00') AS end_known
  FROM late_dag_runs)
SELECT dag_id, execution_date, state, start_date, end_date,
       CASE WHEN end_date IS NOT NULL THEN date_diff('microsecond', start_date, end_date) / 1e6 END AS duration,
       CASE WHEN end_date IS NOT NULL THEN end_known ELSE first_load END AS extracted_at,
       strftime(first_load, '%Y-%m-%d') AS load_date,
       strftime(first_load - to_days(1), '%Y%m%dT%H%M%S.000000_') || strftime(first_load, '%Y%m%dT%H%M%S.000000') AS load_id
FROM placed"""


def _tall(mart: str, entity: str, identifier: str, measures: tuple[str, ...]) -> str:
    """A mart with one row per measure."""
    return "\nUNION ALL ".join(
        f"SELECT '{mart}' AS mart, {entity} AS entity_type, dag_id, {identifier} AS identifier, execution_day, "
        f"'{m}' AS measure, CAST({m} AS DOUBLE) AS value FROM {mart}"
        for m in measures
    )


_MART_INCREMENTAL = "\nUNION ALL ".join(
    (
        _tall("dag_runtime_metrics", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", (
            "total_runs", "successful_runs", "failed_runs", "avg_duration_seconds", "min_duration_seconds",
            "max_duration_seconds", "median_duration_seconds", "p95_duration_seconds", "total_duration_seconds",
        )),
        _tall("dag_failure_rates", "CAST(NULL AS VARCHAR)", "CAST(NULL AS VARCHAR)", (
            "total_runs", "failed_runs", "successful_runs", "failure_rate_percent", "success_rate_percent",
            "rolling_7d_failure_rate", "rolling_30d_failure_rate",
        )),
        _tall("sla_misses", "entity_type", "identifier", (
            "total_count", "sla_misses", "sla_meets", "sla_miss_rate_percent", "avg_duration_seconds",
            "max_duration_seconds", "sla_threshold_seconds",
        )),
    )
)


# --- result rows of checks ---------------------------------------------------

def _row(source: str, suite: str, name: str, kind: str, table: str, column: str | None, **fields: str) -> str:
    """One check-result row from ``source``; fields are SQL, names are texts."""

    def text(value: str | None) -> str:
        return "NULL" if value is None else f"'{value}'"

    sql = {
        "suite": text(suite),
        "check_name": text(name),
        "check_type": text(kind),
        "table_name": text(table),
        "column_name": text(column),
        "evaluated": "0",
        "failed": "0",
        **fields,
    }
    columns = ", ".join(
        f"CAST({sql.get(name, 'NULL')} AS {kind}) AS {name}" for name, kind in RESULT_COLUMNS.items()
    )
    return f"SELECT {columns} FROM ({source})"


def _value_rule(
    relation: str,
    table: str,
    kind: str,
    columns: tuple[str, ...],
    judged: str,
    broken: str,
    suite: str = "adhoc",
    name: str | None = None,
    mostly: float = 1.0,
) -> str:
    source = (
        f"SELECT count(*) FILTER ({judged}) AS n, count(*) FILTER (({judged}) AND ({broken})) AS b"
        f" FROM {relation}"
    )
    share = "coalesce((n - b)::DOUBLE / nullif(n, 0), 1)"
    return _row(
        source,
        suite,
        name or "_".join([kind, table, *columns]),
        kind,
        table,
        ", ".join(columns),
        passed=f"{share} >= {mostly}",
        evaluated="n",
        failed="b",
        observed=share,
        threshold=str(mostly),
        message="format('{} of {} values break the rule', b, n)",
    )


def _not_null(relation: str, table: str, column: str, **more) -> str:
    return _value_rule(relation, table, "not_null", (column,), "true", f"{column} IS NULL", **more)


def _in_set(relation: str, table: str, column: str, values: tuple[str, ...], **more) -> str:
    listed = ", ".join(f"'{value}'" for value in values)
    return _value_rule(
        relation, table, "in_set", (column,), f"{column} IS NOT NULL", f"{column} NOT IN ({listed})", **more
    )


def _between(relation: str, table: str, column: str, low, high=None, **more) -> str:
    broken = f"{column} < {low}" + (f" OR {column} > {high}" if high is not None else "")
    return _value_rule(relation, table, "between", (column,), f"{column} IS NOT NULL", broken, **more)


def _pair(relation: str, table: str, a: str, b: str, **more) -> str:
    judged = f"{a} IS NOT NULL AND {b} IS NOT NULL"
    return _value_rule(relation, table, "pair_order", (a, b), judged, f"{a} < {b}", **more)


def _row_count(relation: str, table: str, low: int, suite: str = "adhoc", name: str | None = None) -> str:
    return _row(
        f"SELECT count(*) AS n FROM {relation}",
        suite,
        name or f"row_count_{table}",
        "row_count",
        table,
        None,
        passed=f"n >= {low}",
        evaluated="n",
        observed="n",
        threshold=str(low),
        message=f"format('{{}} rows, at least {low} expected', n)",
    )


def _null_share(
    relation: str, table: str, column: str, limit: float = 0.0, suite: str = "adhoc", name: str | None = None
) -> str:
    share = "coalesce(b::DOUBLE / nullif(n, 0), 0)"
    return _row(
        f"SELECT count(*) AS n, count(*) FILTER ({column} IS NULL) AS b FROM {relation}",
        suite,
        name or f"null_check_{table}_{column}",
        "null_check",
        table,
        column,
        passed=f"n > 0 AND {share} <= {limit}",
        evaluated="n",
        failed="b",
        observed=share,
        threshold=str(limit),
        message="CASE WHEN n = 0 THEN 'table is empty' ELSE "
        f"printf('%.2f%% of rows are null, at most %.2f%% allowed', {share} * 100, {limit * 100}::DOUBLE) END",
    )


def _fresh(
    relation: str,
    table: str,
    as_of: str = "2024-02-01",
    column: str = "extracted_at",
    suite: str = "adhoc",
    name: str | None = None,
) -> str:
    age = f"(date_diff('microsecond', newest, TIMESTAMP '{as_of}') / 3.6e9)"
    return _row(
        f"SELECT max(extracted_at) AS newest, count(extracted_at) AS n FROM {relation}",
        suite,
        name or f"freshness_check_{table}_{column}",
        "freshness_check",
        table,
        column,
        passed=f"{age} <= 25",
        evaluated="n",
        observed=age,
        threshold="25",
        message=f"printf('newest row is %.2f hours old, at most 25 allowed', {age})",
    )


def _unique(relation: str, table: str, column: str, suite: str = "adhoc") -> str:
    copies = f"SELECT count(*) AS c FROM {relation} WHERE {column} IS NOT NULL GROUP BY {column}"
    return _row(
        f"SELECT coalesce(sum(c), 0) AS n, count(*) FILTER (c > 1) AS b FROM ({copies})",
        suite,
        f"unique_{table}_{column}",
        "unique",
        table,
        column,
        passed="b = 0",
        evaluated="n",
        failed="b",
        observed="b",
        threshold="0",
        message="format('{} values occur more than once', b)",
    )


def _all(*rows: str) -> str:
    return "\nUNION ALL\n".join(rows)


def _standard() -> str:
    parts = []
    for relation, table, columns in (
        ("dag_runs", "dag_runs", ("dag_id", "execution_date")),
        ("dirty", "task_instances", ("task_id", "dag_id")),
    ):
        parts.append(_row_count(relation, table, 0, suite="standard"))
        parts += [_null_share(relation, table, column, suite="standard") for column in columns]
        parts.append(_fresh(relation, table, suite="standard", name=f"freshness_check_{table}"))
    return _all(*parts)


def _suite(relation: str, table: str, required: tuple[str, ...], states: tuple[str, ...], tries: bool) -> str:
    suite = f"{table}_suite"
    parts = [_not_null(relation, table, column, suite=suite) for column in required]
    parts.append(_in_set(relation, table, "state", states, suite=suite))
    if tries:
        parts.append(_between(relation, table, "try_number", 1, suite=suite))
    parts.append(_between(relation, table, "duration", 0, suite=suite))
    parts.append(_pair(relation, table, "end_date", "start_date", suite=suite))
    return _all(*parts)


_RUN_SUITE = _suite("dirty", "dag_runs", ("dag_id", "execution_date"), RUN_STATES, False)
_TASK_SUITE = _suite(
    "dirty", "task_instances", ("dag_id", "task_id", "execution_date"), TASK_STATES, True
)


_STORED_RULES = (
    ("not_null_dag_runs_dag_id", {"column": "dag_id", "kind": "not_null", "mostly": 1.0, "note": "every row needs a value in dag_id"}),
    (
        "not_null_dag_runs_execution_date",
        {"column": "execution_date", "kind": "not_null", "mostly": 1.0, "note": "every row needs a value in execution_date"},
    ),
    (
        "in_set_dag_runs_state",
        {
            "column": "state", "kind": "in_set", "mostly": 1.0, "note": "only states the scheduler knows for runs",
            "values": RUN_STATES,
        },
    ),
    (
        "between_dag_runs_duration",
        {"column": "duration", "kind": "between", "min_value": 0, "mostly": 1.0, "note": "a known duration is never negative"},
    ),
    (
        "pair_order_dag_runs_end_date_start_date",
        {
            "column": "end_date", "kind": "pair_order", "mostly": 1.0, "note": "work cannot stop before it starts",
            "or_equal": True, "other": "start_date",
        },
    ),
)


def _rules_table() -> str:
    rows = ", ".join(
        f"('dag_runs_suite', '{name}', {position}, '{json.dumps(rule)}')"
        for position, (name, rule) in enumerate(_STORED_RULES)
    )
    return f"""
SELECT rules.suite, rules.check_name, CAST(position AS INTEGER) AS position, rule, passed, evaluated, failed
FROM (VALUES {rows}) AS rules(suite, check_name, position, rule)
JOIN ({_RUN_SUITE}) AS outcome USING (check_name)"""


def _matrix() -> str:
    tests = {
        "dag_runs": (["dag_id", "execution_date"], []),
        "task_instances": (["dag_id", "task_id", "execution_date"], []),
        "stg_dag_runs": (["dag_id", "execution_date"], [("calculated_duration", 0, None)]),
        "stg_task_instances": (
            ["dag_id", "task_id", "execution_date"],
            [("calculated_duration", 0, None), ("try_number", 1, None)],
        ),
        "dag_runtime_metrics": (["dag_id", "execution_day"], []),
        "dag_failure_rates": (
            ["dag_id", "execution_day"],
            [("failure_rate_percent", 0, 100), ("success_rate_percent", 0, 100)],
        ),
        "slowest_tasks": (["dag_id", "task_id"], [("failure_rate_percent", 0, 100)]),
        "sla_misses": (["dag_id", "execution_day"], [("sla_miss_rate_percent", 0, 100)]),
    }
    suite = "model_tests"
    parts = [_unique("stg_dag_runs", "stg_dag_runs", "dag_id", suite=suite)]
    parts.append(_in_set("sla_misses", "sla_misses", "entity_type", ("dag", "task"), suite=suite))
    for table, (required, ranges) in tests.items():
        parts += [_not_null(table, table, column, suite=suite) for column in required]
        parts += [_between(table, table, c, low, high, suite=suite) for c, low, high in ranges]
    return _all(*parts)


_DIRTY_STATES = ("success", "failed", "running")

_BODIES: dict[str, str] = {
    # sources
    "src_dag_runs": """
SELECT dag_id, execution_date, state, start_date, end_date,
       date_diff('microsecond', start_date, end_date) / 1e6 AS duration,
       TIMESTAMP '2024-02-01' AS extracted_at
FROM dag_runs""",
    "src_task_instances": """
SELECT * REPLACE (TIMESTAMP '2024-02-01' AS extracted_at) FROM task_instances""",
    "incremental_window": """
SELECT dag_id, execution_date, state, start_date, end_date,
       date_diff('microsecond', start_date, end_date) / 1e6 AS duration,
       TIMESTAMP '2024-02-01' AS extracted_at
FROM dag_runs
WHERE execution_date BETWEEN TIMESTAMP '2024-01-10 02:00:00' AND TIMESTAMP '2024-01-11 02:00:00'""",
    "derive_duration": """
SELECT dag_id, start_date, end_date,
       date_diff('microsecond', start_date, end_date) / 1e6 AS duration
FROM dag_runs""",
    # expressions and filters
    "expr_calculated_duration": """
SELECT dag_id, task_id, execution_date, calculated_duration FROM stg_task_instances""",
    "expr_epoch_diff": """
SELECT dag_id, execution_date, end_date,
       date_diff('microsecond', execution_date, end_date) / 1e6 AS elapsed_seconds
FROM dag_runs""",
    "expr_date_trunc": """
SELECT dag_id, execution_date, date_trunc('day', execution_date) AS execution_day FROM dag_runs""",
    "expr_sla_threshold": """
SELECT dag_id, execution_date,
       CASE WHEN contains(dag_id, 'critical') THEN 3600
            WHEN contains(dag_id, 'daily') THEN 7200 ELSE 10800 END AS sla_threshold_seconds
FROM dag_runs""",
    "expr_state_bucket": """
SELECT dag_id, execution_date, state,
       CASE WHEN state IN ('success', 'failed') THEN state
            WHEN state IN ('running', 'queued', 'scheduled') THEN 'in_progress'
            ELSE 'other' END AS state_bucket,
       state IN ('running', 'queued', 'scheduled') AS in_progress
FROM dag_runs""",
    "expr_rate_percent": """
SELECT dag_id, state, count(duration) AS stored_durations, count(end_date) AS ended,
       CASE WHEN count(end_date) > 0 THEN
         ((count(duration) * 20000 + count(end_date)) // (2 * count(end_date))) / 100::DOUBLE
       END AS stored_percent
FROM dag_runs GROUP BY dag_id, state""",
    "filter_has_duration": """
SELECT * FROM stg_task_instances WHERE calculated_duration IS NOT NULL""",
    "expr_parse_timestamp": """
SELECT dag_id, state, CASE WHEN state <> 'failed' THEN execution_date END AS parsed
FROM dag_runs""",
    # joins, aggregates, windows, order
    "join_thresholds": """
SELECT t.dag_id, t.task_id, t.execution_date, t.calculated_duration, th.sla_threshold_seconds
FROM stg_task_instances t
JOIN (SELECT DISTINCT dag_id, task_id,
             CASE WHEN contains(dag_id, 'critical') THEN 3600
                  WHEN contains(dag_id, 'daily') THEN 7200 ELSE 10800 END AS sla_threshold_seconds
      FROM stg_task_instances) th USING (dag_id, task_id)""",
    "agg_count": """
SELECT dag_id, execution_day, count(*) AS total_runs FROM timed_runs GROUP BY ALL""",
    "agg_conditional_count": """
SELECT dag_id, task_id,
       count(*) FILTER (state = 'failed') AS failed_executions,
       count(*) FILTER (state IN ('running', 'queued', 'scheduled')) AS in_progress,
       count(*) FILTER (calculated_duration > 7200) AS over_two_hours,
       count(*) FILTER (calculated_duration <= 7200) AS within_two_hours
FROM stg_task_instances GROUP BY ALL""",
    "agg_avg": """
SELECT dag_id, execution_day, avg(calculated_duration) AS avg_duration_seconds
FROM timed_runs GROUP BY ALL""",
    "agg_min_max": """
SELECT dag_id, execution_day, min(calculated_duration) AS min_duration_seconds,
       max(calculated_duration) AS max_duration_seconds
FROM timed_runs GROUP BY ALL""",
    "agg_sum": """
SELECT dag_id, task_id, sum(calculated_duration) AS total_duration_seconds
FROM timed_tasks GROUP BY ALL""",
    "agg_percentile_cont": f"""
SELECT dag_id, task_id, {_percentile(0.5)} AS median_duration_seconds,
       {_percentile(0.95)} AS p95_duration_seconds
FROM stg_task_instances GROUP BY ALL""",
    "agg_max_timestamp": """
SELECT dag_id, task_id, max(extracted_at) AS last_updated FROM stg_task_instances GROUP BY ALL""",
    "distinct_tasks": "SELECT DISTINCT dag_id, task_id FROM stg_task_instances",
    "win_rolling_7": """
SELECT dag_id, execution_day, failure_rate_percent, rolling_7d_failure_rate FROM dag_failure_rates""",
    "win_rolling_30": """
SELECT dag_id, execution_day, failure_rate_percent, rolling_30d_failure_rate FROM dag_failure_rates""",
    "win_rank_avg": """
SELECT dag_id, task_id, avg_duration_seconds, rank_by_avg_duration FROM ranked_tasks""",
    "win_rank_max": """
SELECT dag_id, task_id, max_duration_seconds, rank_by_max_duration FROM ranked_tasks""",
    "sort_multi_key": """
SELECT execution_day, sla_miss_rate_percent, entity_type, dag_id, identifier FROM sla_misses
ORDER BY execution_day DESC, sla_miss_rate_percent DESC""",
    "top_k_slowest": """
SELECT dag_id, task_id, avg_duration_seconds FROM task_totals
ORDER BY avg_duration_seconds DESC NULLS LAST, dag_id NULLS FIRST, task_id NULLS FIRST LIMIT 10""",
    "union_all_sla": """
SELECT entity_type, dag_id, identifier, execution_day, total_count, sla_misses FROM sla_misses""",
    # models
    "stg_dag_runs": "SELECT * FROM stg_dag_runs",
    "stg_task_instances": "SELECT * FROM stg_task_instances",
    "dag_runtime_metrics": "SELECT * FROM dag_runtime_metrics",
    "dag_failure_rates": "SELECT * FROM dag_failure_rates",
    "slowest_tasks": "SELECT * FROM slowest_tasks",
    "sla_misses": "SELECT * FROM sla_misses",
    "sla_misses_custom_thresholds": """
, custom AS (
  SELECT * REPLACE (CASE WHEN task_id = 'load' AND dag_id = 'adhoc_5' THEN 50
                         WHEN task_id = 'load' AND dag_id LIKE 'adhoc%' THEN 100
                         ELSE sla_threshold_seconds END AS sla_threshold_seconds) FROM timed_tasks)
SELECT 'task' AS entity_type, dag_id, task_id AS identifier, execution_day, count(*) AS total_count,
       count(*) FILTER (calculated_duration > sla_threshold_seconds) AS sla_misses,
       count(*) FILTER (calculated_duration <= sla_threshold_seconds) AS sla_meets,
       ((sla_misses * 20000 + total_count) // (2 * total_count)) / 100::DOUBLE AS sla_miss_rate_percent,
       avg(calculated_duration) AS avg_duration_seconds, max(calculated_duration) AS max_duration_seconds,
       sla_threshold_seconds
FROM custom GROUP BY dag_id, task_id, execution_day, sla_threshold_seconds
UNION ALL BY NAME
SELECT 'dag' AS entity_type, CAST(NULL AS VARCHAR) AS identifier, * FROM sla_dag_daily""",
    "sla_thresholds": """
SELECT DISTINCT dag_id, task_id,
       CASE WHEN contains(dag_id, 'critical') THEN 3600
            WHEN contains(dag_id, 'daily') THEN 7200 ELSE 10800 END AS sla_threshold_seconds
FROM stg_task_instances""",
    "sla_task_daily": "SELECT * FROM sla_task_daily",
    "sla_dag_daily": "SELECT * FROM sla_dag_daily",
    # quality
    "dq_row_count": _all(
        _row_count("dirty", "dirty", 0), _row_count("dirty", "dirty", 10**12, name="too_few")
    ),
    "dq_null_check": _all(
        _null_share("dirty", "dirty", "dag_id"),
        _null_share("dirty", "dirty", "dag_id", 0.05, name="dag_id_mostly_set"),
        _null_share("dirty", "dirty", "execution_date"),
    ),
    "dq_freshness": _all(
        _fresh("dirty", "dirty"),
        _fresh("dirty", "dirty", "2024-03-01", name="stale"),
        _fresh("dirty", "dirty", column="loaded_text"),
    ),
    "dq_footer": _all(
        _row_count("dirty", "dirty", 0),
        _row_count("dirty", "dirty", 10**12, name="too_few"),
        _null_share("dirty", "dirty", "dag_id"),
        _null_share("dirty", "dirty", "dag_id", 0.05, name="dag_id_mostly_set"),
        _fresh("dirty", "dirty"),
        _fresh("dirty", "dirty", "2024-03-01", name="stale"),
        _fresh("dirty", "dirty", column="loaded_text"),
    ),
    "dq_messages": f"SELECT table_name, check_name, message FROM ({_standard()})",
    "dq_run_all": _standard(),
    "dq_summary": f"""
SELECT bool_and(passed) AS all_passed, count(*) FILTER (passed) AS passed_count,
       count(*) AS total_count
FROM ({_standard()})""",
    "dq_missing_column": _all(
        _row_count("dirty", "dirty", 0),
        _null_share("dirty", "dirty", "task_id"),
        _row(
            "SELECT 1",
            "adhoc",
            "null_check_dirty_run_id",
            "null_check",
            "dirty",
            "run_id",
            passed="false",
            error="'column not found: run_id'",
            message="'column not found: run_id'",
        ),
    ),
    "dq_failing_column": _all(
        _row_count("dirty", "dirty", 0),
        _row(
            "SELECT 1",
            "adhoc",
            "not_null_dirty_code",
            "not_null",
            "dirty",
            "code",
            passed="false",
            error="'CAST_INVALID_INPUT'",
            message="'CAST_INVALID_INPUT'",
        ),
        _not_null("dirty", "dirty", "dag_id"),
    ),
    "exp_not_null": _all(_not_null("dirty", "dirty", "dag_id"), _not_null("dirty", "dirty", "task_id")),
    "exp_in_set": _in_set("dirty", "dirty", "state", _DIRTY_STATES),
    "exp_between": _all(
        _between("dirty", "dirty", "duration", 0), _between("dirty", "dirty", "try_number", 1)
    ),
    "exp_pair_order": _pair("dirty", "dirty", "end_date", "start_date"),
    "exp_mostly": _all(
        _not_null("dirty", "dirty", "dag_id", mostly=0.98, name="loose"),
        _not_null("dirty", "dirty", "dag_id", mostly=0.999, name="strict"),
        _in_set("dirty", "dirty", "state", _DIRTY_STATES, mostly=0.98, name="loose_states"),
        _between("dirty", "dirty", "try_number", 1, mostly=0.999, name="strict_tries"),
    ),
    "sla_pattern_table": """
, names AS (
  SELECT 'flow_' || md5(CAST(user_id AS VARCHAR)) AS dag_id, count(*) AS total_runs FROM events GROUP BY ALL),
patterns AS (
  SELECT k AS priority, substr(md5(CAST(k AS VARCHAR)), 1, 3 + k % 4) AS pattern,
         CAST(600 + 60 * (k % 100) AS INTEGER) AS sla_threshold_seconds
  FROM (SELECT unnest(range(5000)) AS k)),
matched AS (
  SELECT dag_id, arg_min(sla_threshold_seconds, priority) AS sla_threshold_seconds
  FROM names JOIN patterns ON contains(dag_id, pattern) GROUP BY dag_id)
SELECT dag_id, coalesce(sla_threshold_seconds, 10800) AS sla_threshold_seconds, total_runs
FROM names LEFT JOIN matched USING (dag_id)""",
    "win_calendar_7_30": """
, kept AS (
  SELECT * FROM daily_outcomes WHERE (day(execution_day) + CAST(right(dag_id, 1) AS INTEGER)) % 3 <> 0),
by_rows AS (
  SELECT *, CAST(sum(failed_hundredths) OVER w AS BIGINT) / 100::DOUBLE / count(*) OVER w AS rolling_7_rows
  FROM kept WINDOW w AS (PARTITION BY dag_id ORDER BY execution_day ROWS 6 PRECEDING)),
spine AS (
  SELECT dag_id, unnest(generate_series(min(execution_day), max(execution_day), INTERVAL 1 DAY)) AS execution_day
  FROM kept GROUP BY dag_id)
SELECT dag_id, execution_day, total_runs, failed_hundredths / 100::DOUBLE AS failure_rate_percent, rolling_7_rows,
       CAST(sum(failed_hundredths) OVER week AS BIGINT) / 100::DOUBLE / nullif(count(failed_hundredths) OVER week, 0)
         AS rolling_7_days,
       CAST(sum(failed_hundredths) OVER month AS BIGINT) / 100::DOUBLE / nullif(count(failed_hundredths) OVER month, 0)
         AS rolling_30_days
FROM spine LEFT JOIN by_rows USING (dag_id, execution_day)
WINDOW week AS (PARTITION BY dag_id ORDER BY execution_day RANGE BETWEEN INTERVAL 6 DAY PRECEDING AND CURRENT ROW),
       month AS (PARTITION BY dag_id ORDER BY execution_day RANGE BETWEEN INTERVAL 29 DAY PRECEDING AND CURRENT ROW)""",
    "exp_evidence": """
, broken AS (
  SELECT 'not_null_dirty_dag_id' AS check_name, 'null' AS value FROM dirty WHERE dag_id IS NULL
  UNION ALL SELECT 'in_set_dirty_state', state FROM dirty WHERE state <> 'success'
  UNION ALL SELECT 'between_dirty_try_number', CAST(try_number AS VARCHAR) FROM dirty WHERE try_number < 1
  UNION ALL SELECT 'between_dirty_duration', CAST(duration AS VARCHAR) FROM dirty WHERE duration < 0)
SELECT check_name, CAST(sum(count(*)) OVER (PARTITION BY check_name) AS BIGINT) AS failed, true AS some_examples,
       true AS examples_broke_it, value, count(*) AS rows
FROM broken GROUP BY check_name, value""",
    "agg_percentile_sketch": """
SELECT dag_id, task_id, count(*) AS total_executions, true AS median_near, true AS p95_near
FROM timed_tasks GROUP BY dag_id, task_id""",
    "join_thresholds_asof": """
, levels AS (
  SELECT dag_id, task_id, execution_date AS valid_from,
         CASE WHEN state = 'failed' THEN execution_date + INTERVAL 6 HOUR END AS valid_to,
         CAST(1800 + 600 * try_number AS INTEGER) AS sla_threshold_seconds
  FROM stg_task_instances WHERE state IN ('failed', 'up_for_retry'))
SELECT t.dag_id, t.task_id, t.execution_date, t.calculated_duration, l.sla_threshold_seconds
FROM stg_task_instances t ASOF JOIN levels l
  ON t.dag_id = l.dag_id AND t.task_id = l.task_id AND t.execution_date >= l.valid_from
WHERE l.valid_to IS NULL OR t.execution_date < l.valid_to""",
    "exp_suite_dag_runs": _RUN_SUITE,
    "exp_suite_task_instances": _TASK_SUITE,
    "exp_rules_table": _rules_table(),
    "exp_statistics": f"""
SELECT suite, bool_and(passed) AS success, count(*) AS evaluated_rules,
       count(*) FILTER (passed) AS successful_rules,
       count(*) FILTER (NOT passed) AS unsuccessful_rules,
       count(*) FILTER (passed) * 100::DOUBLE / count(*) AS success_percent
FROM ({_RUN_SUITE} UNION ALL {_TASK_SUITE}) GROUP BY suite""",
    "test_not_null": _all(
        *[_not_null("dirty", "dirty", c) for c in ("dag_id", "task_id", "execution_date")]
    ),
    "test_unique": _all(
        _unique("stg_dag_runs", "stg_dag_runs", "dag_id"),
        _unique("stg_dag_runs", "stg_dag_runs", "execution_date"),
    ),
    "test_unique_incremental": _all(
        _unique("stg_dag_runs", "stg_dag_runs", "dag_id"),
        _unique("stg_dag_runs", "stg_dag_runs", "execution_date"),
    ),
    "test_accepted_values": _all(
        _in_set("sla_misses", "sla_misses", "entity_type", ("dag", "task")),
        _in_set("sla_misses", "sla_misses", "entity_type", ("task",), name="tasks_only"),
    ),
    "test_accepted_range": _all(
        _between("stg_dirty", "stg_task_instances", "calculated_duration", 0),
        _between("stg_dirty", "stg_task_instances", "calculated_duration", 0, 3600, name="one_hour"),
        _between("stg_dirty", "stg_task_instances", "try_number", 1),
    ),
    "test_matrix": _matrix(),
}

ORACLE_SQL: dict[str, str] = {name: _sql(body) for name, body in _BODIES.items()}
ORACLE_SQL["load_merge"] = _late_sql(_LOAD_MERGE, 3)
ORACLE_SQL["mart_incremental"] = _late_sql(_MART_INCREMENTAL, 5)
