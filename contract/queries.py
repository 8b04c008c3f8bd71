"""Every operator as a query over the given tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from contract import fixtures
from flowgauge import functions as fx
from flowgauge import operators as ops
from flowgauge.plans import incremental, marts, staging
from flowgauge.plans.models import model_frames
from flowgauge.plans.staging import timed
from flowgauge.quality import (
    Between,
    FreshWithin,
    InSet,
    NotNull,
    NullShare,
    PairOrder,
    RowCount,
    Unique,
    dag_runs_suite,
    run_footer_rules,
    run_model_tests,
    run_rules,
    run_standard_checks,
    run_suite,
    statistics,
    suite_from_rows,
    suite_rows,
    summarize,
    task_instances_suite,
)
from flowgauge.quality.evidence import evidence
from flowgauge.quality.loads import UniqueOverLoads
from flowgauge.quality.model_tests import accepted_range, accepted_values, not_null
from flowgauge.quality.rules import settled
from flowgauge.quality.suites import RULES_TABLE
from flowgauge.session import ensure_checkpoint_dir
from flowgauge.sources import extract_and_merge, extract_dag_runs, extract_task_instances, load, load_window

#: The moment the checks look from, and the load window of the incremental query.
AS_OF = datetime(2024, 2, 1)
WINDOW_START, WINDOW_END = datetime(2024, 1, 10, 2), datetime(2024, 1, 11, 2)
#: States the planted faults are measured against.
DIRTY_STATES = ("success", "failed", "running")

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_dag_runs(fixtures.dag_runs(spark, sf_dir))


def _tasks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging.stg_task_instances(fixtures.task_instances(spark, sf_dir))


def _daily(df: DataFrame) -> DataFrame:
    return timed(df).withColumn("execution_day", fx.day_of(F.col("execution_date")))


# --- sources -----------------------------------------------------------------


@query
def src_dag_runs(spark, sf_dir):
    return extract_dag_runs(spark, fixtures.dag_runs(spark, sf_dir), as_of=AS_OF)


@query
def src_task_instances(spark, sf_dir):
    return extract_task_instances(spark, fixtures.task_instances(spark, sf_dir), as_of=AS_OF)


@query
def incremental_window(spark, sf_dir):
    runs = fixtures.dag_runs(spark, sf_dir)
    return extract_dag_runs(spark, runs, WINDOW_START, WINDOW_END, AS_OF)


@query
def derive_duration(spark, sf_dir):
    return fixtures.dag_runs(spark, sf_dir).select(
        "dag_id",
        "start_date",
        "end_date",
        fx.run_duration(F.col("start_date"), F.col("end_date")).alias("duration"),
    )


@contextmanager
def _database(spark: SparkSession) -> Iterator[str]:
    """A database of its own, for queries that load tables; it goes when they are done."""
    name = f"loads_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name}")
    try:
        yield name
    finally:
        spark.sql(f"DROP DATABASE {name} CASCADE")


def _as_known(history: DataFrame, moment: datetime) -> DataFrame:
    """History as the source shows it at a moment: a run's end is known a day after it was scheduled."""
    ended = F.col("execution_date") + F.expr("INTERVAL '1' DAY") <= F.lit(moment).cast("timestamp_ntz")
    still = F.when(F.col("state").isin("running", "queued"), F.col("state")).otherwise("running")
    return history.withColumns(
        {
            "state": F.when(ended, F.col("state")).otherwise(still),
            **{c: F.when(ended, F.col(c)) for c in ("end_date", "duration")},
        }
    )


def _daily_loads(spark: SparkSession, sf_dir: str, days: int, database: str):
    """Merge one day after the other, each as the source shows it then; yields what each merge did."""
    runs, tasks = fixtures.dag_runs(spark, sf_dir), fixtures.task_instances(spark, sf_dir)
    for k in range(days):
        end = WINDOW_START + timedelta(days=k)
        yield extract_and_merge(
            spark, _as_known(runs, end), _as_known(tasks, end), *load_window(end), as_of=end, database=database
        )


@query
def load_merge(spark, sf_dir):
    """The raw table of runs after three daily loads, in which runs end after their window was loaded."""
    ensure_checkpoint_dir(spark)
    with _database(spark) as database:
        for _ in _daily_loads(spark, sf_dir, 3, database):
            pass
        loaded = spark.table(f"{database}.dag_runs")
        return loaded.withColumn("load_date", F.col("load_date").cast("string")).checkpoint()


@query
def mart_incremental(spark, sf_dir):
    """Three marts kept up to date over five daily loads, one row per measure."""
    ensure_checkpoint_dir(spark)
    names = {
        name: [c for c, kind in marts_frame.dtypes if kind in ("bigint", "double", "int")]
        for name, marts_frame in _empty_marts(spark, sf_dir).items()
    }
    with _database(spark) as database:
        for merged in _daily_loads(spark, sf_dir, 5, database):
            incremental.apply_merges(spark, database, merged)
        parts = [_tall(spark.table(f"{database}.{name}"), name, measures) for name, measures in names.items()]
        return reduce(DataFrame.unionByName, parts).checkpoint()


def _empty_marts(spark, sf_dir) -> dict[str, DataFrame]:
    frame = model_frames({"dag_runs": fixtures.dag_runs(spark, sf_dir), "task_instances": fixtures.task_instances(spark, sf_dir)})
    return {name: frame(name) for name in incremental.MARTS}


def _tall(mart: DataFrame, name: str, measures: list[str]) -> DataFrame:
    each = F.explode(
        F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("double").alias("value")) for m in measures])
    ).alias("each")

    def own(column: str):
        return (F.col(column) if column in mart.columns else F.lit(None).cast("string")).alias(column)

    keys = (F.lit(name).alias("mart"), own("entity_type"), "dag_id", own("identifier"), "execution_day")
    return mart.select(*keys, each).select("*", "each.*").drop("each")


# --- expressions and filters -------------------------------------------------


@query
def expr_calculated_duration(spark, sf_dir):
    return fixtures.task_instances(spark, sf_dir).select(
        "dag_id", "task_id", "execution_date", fx.calculated_duration().alias("calculated_duration")
    )


@query
def expr_epoch_diff(spark, sf_dir):
    seconds = fx.seconds_between(F.col("execution_date"), F.col("end_date"))
    return fixtures.dag_runs(spark, sf_dir).select(
        "dag_id", "execution_date", "end_date", seconds.alias("elapsed_seconds")
    )


@query
def expr_date_trunc(spark, sf_dir):
    return fixtures.dag_runs(spark, sf_dir).select(
        "dag_id", "execution_date", fx.day_of(F.col("execution_date")).alias("execution_day")
    )


@query
def expr_sla_threshold(spark, sf_dir):
    limit = fx.sla_threshold(F.col("dag_id")).alias("sla_threshold_seconds")
    return fixtures.dag_runs(spark, sf_dir).select("dag_id", "execution_date", limit)


@query
def expr_state_bucket(spark, sf_dir):
    return fixtures.dag_runs(spark, sf_dir).select(
        "dag_id",
        "execution_date",
        "state",
        fx.state_bucket(F.col("state")).alias("state_bucket"),
        fx.is_in_progress(F.col("state")).alias("in_progress"),
    )


@query
def expr_rate_percent(spark, sf_dir):
    """Ended runs with a stored duration; states in progress have none that ended, hence NULL."""
    counted = (
        fixtures.dag_runs(spark, sf_dir)
        .groupBy("dag_id", "state")
        .agg(F.count("duration").alias("stored_durations"), F.count("end_date").alias("ended"))
    )
    rate = fx.rate_percent(F.col("stored_durations"), F.col("ended"))
    return counted.withColumn("stored_percent", rate.cast("double"))


@query
def filter_has_duration(spark, sf_dir):
    return timed(_tasks(spark, sf_dir))


@query
def expr_parse_timestamp(spark, sf_dir):
    text = F.when(F.col("state") == "failed", F.lit("not a time")).otherwise(
        F.col("execution_date").cast("string")
    )
    return fixtures.dag_runs(spark, sf_dir).select(
        "dag_id", "state", fx.parse_timestamp(text).alias("parsed")
    )


# --- joins, aggregates, windows, order ---------------------------------------


@query
def join_thresholds(spark, sf_dir):
    tasks = _tasks(spark, sf_dir)
    return ops.join_thresholds(tasks, ops.sla_thresholds(tasks)).select(
        "dag_id", "task_id", "execution_date", "calculated_duration", "sla_threshold_seconds"
    )


@query
def sla_pattern_table(spark, sf_dir):
    """The level of every workflow by the first of 5,000 patterns in its name, one workflow per user."""
    names = fixtures.events(spark, sf_dir).select(
        F.concat(F.lit("flow_"), F.md5(F.col("user_id").cast("string").cast("binary"))).alias("dag_id")
    )
    k = F.col("id")
    patterns = spark.range(5000).select(
        k.alias("priority"),
        F.substring(F.md5(k.cast("string").cast("binary")), F.lit(1), (3 + k % 4).cast("int")).alias("pattern"),
        (600 + 60 * (k % 100)).cast("int").alias("sla_threshold_seconds"),
    )
    levels = ops.sla_from_patterns(names, patterns, default=10800)
    return levels.groupBy("dag_id", "sla_threshold_seconds").agg(F.count(F.lit(1)).alias("total_runs"))


@query
def join_thresholds_asof(spark, sf_dir):
    """A retry sets a level for its task from then on, a failure one for six hours."""
    tasks = _tasks(spark, sf_dir)
    until = F.when(F.col("state") == "failed", F.col("execution_date") + F.expr("INTERVAL '6' HOUR"))
    levels = tasks.where("state in ('failed', 'up_for_retry')").select(
        "dag_id",
        "task_id",
        F.col("execution_date").alias("valid_from"),
        until.alias("valid_to"),
        (1800 + 600 * F.col("try_number")).alias("sla_threshold_seconds"),
    )
    return ops.join_thresholds_asof(tasks, levels).select(
        "dag_id", "task_id", "execution_date", "calculated_duration", "sla_threshold_seconds"
    )


@query
def agg_count(spark, sf_dir):
    return _daily(_runs(spark, sf_dir)).groupBy("dag_id", "execution_day").agg(
        F.count(F.lit(1)).alias("total_runs")
    )


@query
def agg_conditional_count(spark, sf_dir):
    return _tasks(spark, sf_dir).groupBy("dag_id", "task_id").agg(
        F.count_if(F.col("state") == "failed").alias("failed_executions"),
        F.count_if(fx.is_in_progress(F.col("state"))).alias("in_progress"),
        F.count_if(F.col("calculated_duration") > 7200).alias("over_two_hours"),
        F.count_if(F.col("calculated_duration") <= 7200).alias("within_two_hours"),
    )


@query
def agg_avg(spark, sf_dir):
    return _daily(_runs(spark, sf_dir)).groupBy("dag_id", "execution_day").agg(
        F.avg("calculated_duration").alias("avg_duration_seconds")
    )


@query
def agg_min_max(spark, sf_dir):
    return _daily(_runs(spark, sf_dir)).groupBy("dag_id", "execution_day").agg(
        F.min("calculated_duration").alias("min_duration_seconds"),
        F.max("calculated_duration").alias("max_duration_seconds"),
    )


@query
def agg_sum(spark, sf_dir):
    return _daily(_tasks(spark, sf_dir)).groupBy("dag_id", "task_id").agg(
        F.sum("calculated_duration").alias("total_duration_seconds")
    )


@query
def agg_percentile_cont(spark, sf_dir):
    return ops.grouped_percentiles(
        _tasks(spark, sf_dir),
        keys=["dag_id", "task_id"],
        value="calculated_duration",
        quantiles={"median_duration_seconds": 0.5, "p95_duration_seconds": 0.95},
    )


@query
def agg_percentile_sketch(spark, sf_dir):
    """Median and 95th percentile of 30 days from daily sketches, each held against the exact ranks.

    What a sketch answers may differ from run to run, so what is returned is whether its rank
    lies within the error that is stated for it (three times the one of 99 in 100 answers).
    """
    tasks, keys = _daily(_tasks(spark, sf_dir)), ["dag_id", "task_id"]
    stored = ops.sketches(tasks, [*keys, "execution_day"], "calculated_duration")
    quantiles = {"median": 0.5, "p95": 0.95}
    found = ops.quantiles_of(ops.merge_sketches(stored, keys), quantiles)
    value, n, off = F.col("calculated_duration"), F.col("sketched_rows"), 3 * ops.rank_error()
    ranks = tasks.join(found, keys).groupBy(*keys, "sketched_rows")
    below = [F.count_if(value < F.col(name)).alias(f"{name}_below") for name in quantiles]
    up_to = [F.count_if(value <= F.col(name)).alias(f"{name}_up_to") for name in quantiles]

    def near(name: str, q: float):
        return (F.col(f"{name}_below") / n - off <= q) & (F.col(f"{name}_up_to") / n + off >= q)

    return ranks.agg(*below, *up_to).select(
        *keys, n.alias("total_executions"), *[near(name, q).alias(f"{name}_near") for name, q in quantiles.items()]
    )


@query
def agg_max_timestamp(spark, sf_dir):
    return _tasks(spark, sf_dir).groupBy("dag_id", "task_id").agg(
        F.max("extracted_at").alias("last_updated")
    )


@query
def distinct_tasks(spark, sf_dir):
    return ops.distinct_tasks(_tasks(spark, sf_dir))


def _rolling(spark, sf_dir, rows: int, name: str) -> DataFrame:
    return marts.daily_outcomes(_runs(spark, sf_dir)).select(
        "dag_id",
        "execution_day",
        F.col("failure_rate_percent").cast("double").alias("failure_rate_percent"),
        ops.rolling_mean("failure_rate_percent", rows).alias(name),
    )


@query
def win_rolling_7(spark, sf_dir):
    return _rolling(spark, sf_dir, 7, "rolling_7d_failure_rate")


@query
def win_rolling_30(spark, sf_dir):
    return _rolling(spark, sf_dir, 30, "rolling_30d_failure_rate")


def _ranked(spark, sf_dir, column: str, name: str) -> DataFrame:
    totals = marts.task_totals(_tasks(spark, sf_dir)).select("dag_id", "task_id", column)
    return ops.global_row_number(totals, marts.slowest_first(column), name)


@query
def win_calendar_7_30(spark, sf_dir):
    """Means over calendar days, on history in which a third of the days have no runs."""
    kept = (F.dayofmonth("execution_date") + F.substring("dag_id", -1, 1).cast("int")) % 3 != 0
    outcomes = marts.daily_outcomes(_runs(spark, sf_dir).where(kept))
    by_rows = outcomes.withColumn("rolling_7_rows", ops.rolling_mean("failure_rate_percent", 7))
    frames = {"rolling_7_days": 7, "rolling_30_days": 30}
    return ops.calendar_means(by_rows, "failure_rate_percent", frames).select(
        "dag_id",
        "execution_day",
        "total_runs",
        F.col("failure_rate_percent").cast("double").alias("failure_rate_percent"),
        "rolling_7_rows",
        *frames,
    )


@query
def win_rank_avg(spark, sf_dir):
    return _ranked(spark, sf_dir, "avg_duration_seconds", "rank_by_avg_duration")


@query
def win_rank_max(spark, sf_dir):
    return _ranked(spark, sf_dir, "max_duration_seconds", "rank_by_max_duration")


@query
def sort_multi_key(spark, sf_dir):
    return marts.in_report_order("sla_misses", QUERIES["sla_misses"](spark, sf_dir)).select(
        "execution_day", "sla_miss_rate_percent", "entity_type", "dag_id", "identifier"
    )


@query
def top_k_slowest(spark, sf_dir):
    totals = marts.task_totals(_tasks(spark, sf_dir))
    slowest = ops.top_k(totals, marts.slowest_first("avg_duration_seconds"), 10)
    return slowest.select("dag_id", "task_id", "avg_duration_seconds")


@query
def union_all_sla(spark, sf_dir):
    def half(df: DataFrame, entity: str, identifier) -> DataFrame:
        return df.select(
            F.lit(entity).alias("entity_type"),
            "dag_id",
            identifier.alias("identifier"),
            "execution_day",
            "total_count",
            "sla_misses",
        )

    tasks = half(marts.sla_task_daily(_tasks(spark, sf_dir)), "task", F.col("task_id"))
    runs = half(marts.sla_dag_daily(_runs(spark, sf_dir)), "dag", F.lit(None).cast("string"))
    return tasks.unionByName(runs)


# --- models ------------------------------------------------------------------


@query
def stg_dag_runs(spark, sf_dir):
    return _runs(spark, sf_dir)


@query
def stg_task_instances(spark, sf_dir):
    return _tasks(spark, sf_dir)


@query
def dag_runtime_metrics(spark, sf_dir):
    return marts.dag_runtime_metrics(_runs(spark, sf_dir))


@query
def dag_failure_rates(spark, sf_dir):
    return marts.dag_failure_rates(_runs(spark, sf_dir))


@query
def slowest_tasks(spark, sf_dir):
    return marts.slowest_tasks(_tasks(spark, sf_dir))


@query
def sla_misses(spark, sf_dir):
    return marts.sla_misses(_runs(spark, sf_dir), _tasks(spark, sf_dir))


@query
def sla_thresholds(spark, sf_dir):
    return ops.sla_thresholds(_tasks(spark, sf_dir))


@query
def sla_misses_custom_thresholds(spark, sf_dir):
    """Limits of their own for some tasks, one of them given twice; the others keep their tier's."""
    tasks = _tasks(spark, sf_dir)
    own = ops.distinct_tasks(tasks).where("task_id = 'load' AND dag_id LIKE 'adhoc%'")
    given = own.withColumn("sla_threshold_seconds", F.lit(100)).unionByName(
        own.where("dag_id = 'adhoc_5'").withColumn("sla_threshold_seconds", F.lit(50))
    )
    return marts.sla_misses(_runs(spark, sf_dir), tasks, task_thresholds=given)


@query
def sla_task_daily(spark, sf_dir):
    return marts.sla_task_daily(_tasks(spark, sf_dir))


@query
def sla_dag_daily(spark, sf_dir):
    return marts.sla_dag_daily(_runs(spark, sf_dir))


# --- quality -----------------------------------------------------------------


def _on_dirty(spark, sf_dir, *rules, suite: str = "adhoc") -> DataFrame:
    return run_rules(fixtures.dirty_rows(spark, sf_dir), rules, suite, "dirty")


@query
def dq_row_count(spark, sf_dir):
    return _on_dirty(spark, sf_dir, RowCount(min_rows=0), RowCount(min_rows=10**12, name="too_few"))


@query
def dq_null_check(spark, sf_dir):
    return _on_dirty(
        spark,
        sf_dir,
        NullShare(column="dag_id"),
        NullShare(column="dag_id", max_share=0.05, name="dag_id_mostly_set"),
        NullShare(column="execution_date"),
    )


@query
def dq_freshness(spark, sf_dir):
    text = fixtures.dirty_rows(spark, sf_dir).withColumn(
        "loaded_text", F.col("extracted_at").cast("string")
    )
    return run_rules(
        text,
        [
            FreshWithin(as_of=AS_OF),
            FreshWithin(as_of=datetime(2024, 3, 1), name="stale"),
            FreshWithin(as_of=AS_OF, column="loaded_text"),
        ],
        "adhoc",
        "dirty",
    )


@query
def dq_footer(spark, sf_dir):
    """The rules of ``dq_row_count``, ``dq_freshness`` and NULL shares, on a stored table and from its footers."""
    ensure_checkpoint_dir(spark)
    text = F.col("extracted_at").cast("string")
    rules = [
        RowCount(min_rows=0),
        RowCount(min_rows=10**12, name="too_few"),
        NullShare(column="dag_id"),
        NullShare(column="dag_id", max_share=0.05, name="dag_id_mostly_set"),
        FreshWithin(as_of=AS_OF),
        FreshWithin(as_of=datetime(2024, 3, 1), name="stale"),
        FreshWithin(as_of=AS_OF, column="loaded_text"),
    ]
    with _database(spark) as database:
        fixtures.dirty_rows(spark, sf_dir).withColumn("loaded_text", text).write.saveAsTable(f"{database}.dirty")
        path = f"{spark.catalog.getDatabase(database).locationUri}/dirty"
        return run_footer_rules(spark, path, rules, "adhoc", "dirty").checkpoint()


@query
def dq_messages(spark, sf_dir):
    """The words of the standard battery."""
    return QUERIES["dq_run_all"](spark, sf_dir).select("table_name", "check_name", "message")


@query
def dq_run_all(spark, sf_dir):
    tables = {
        "dag_runs": fixtures.dag_runs(spark, sf_dir),
        "task_instances": fixtures.dirty_rows(spark, sf_dir),
    }
    return run_standard_checks(spark, tables, AS_OF)


@query
def dq_summary(spark, sf_dir):
    return summarize(QUERIES["dq_run_all"](spark, sf_dir))


@query
def dq_missing_column(spark, sf_dir):
    return _on_dirty(
        spark, sf_dir, RowCount(), NullShare(column="run_id"), NullShare(column="task_id")
    )


@query
def dq_failing_column(spark, sf_dir):
    """One column cannot be computed at run time; the other rules report."""
    dirty = fixtures.dirty_rows(spark, sf_dir).withColumn("code", F.col("state").cast("int"))
    rules = [RowCount(), NotNull(column="code"), NotNull(column="dag_id")]
    return settled(dirty, {"adhoc": rules}, "dirty")


@query
def exp_not_null(spark, sf_dir):
    return _on_dirty(spark, sf_dir, NotNull(column="dag_id"), NotNull(column="task_id"))


@query
def exp_in_set(spark, sf_dir):
    return _on_dirty(spark, sf_dir, InSet(column="state", values=DIRTY_STATES))


@query
def exp_between(spark, sf_dir):
    return _on_dirty(
        spark,
        sf_dir,
        Between(column="duration", min_value=0),
        Between(column="try_number", min_value=1),
    )


@query
def exp_pair_order(spark, sf_dir):
    return _on_dirty(spark, sf_dir, PairOrder(column="end_date", other="start_date"))


@query
def exp_mostly(spark, sf_dir):
    return _on_dirty(
        spark,
        sf_dir,
        NotNull(column="dag_id", mostly=0.98, name="loose"),
        NotNull(column="dag_id", mostly=0.999, name="strict"),
        InSet(column="state", values=DIRTY_STATES, mostly=0.98, name="loose_states"),
        Between(column="try_number", min_value=1, mostly=0.999, name="strict_tries"),
    )


@query
def exp_suite_dag_runs(spark, sf_dir):
    return run_suite(fixtures.dirty_rows(spark, sf_dir), dag_runs_suite())


@query
def exp_suite_task_instances(spark, sf_dir):
    return run_suite(fixtures.dirty_rows(spark, sf_dir), task_instances_suite())


@query
def exp_rules_table(spark, sf_dir):
    """A suite that was stored as a table, read back and run; each rule beside its outcome."""
    rules = spark.createDataFrame(suite_rows(dag_runs_suite()), RULES_TABLE)
    suite = suite_from_rows(rules.orderBy("position").collect())
    outcome = run_suite(fixtures.dirty_rows(spark, sf_dir), suite)
    return rules.join(outcome.drop("table_name"), ["suite", "check_name"]).select(
        "suite", "check_name", "position", "rule", "passed", "evaluated", "failed"
    )


@query
def exp_statistics(spark, sf_dir):
    dirty = fixtures.dirty_rows(spark, sf_dir)
    results = [run_suite(dirty, suite) for suite in (dag_runs_suite(), task_instances_suite())]
    return statistics(reduce(DataFrame.unionByName, results))


@query
def exp_evidence(spark, sf_dir):
    """What broke the rules: their most frequent values, and whether the rows shown as examples did break them."""
    dirty = staging.stg_task_instances(fixtures.dirty_rows(spark, sf_dir))
    rules = [
        NotNull(column="dag_id"),
        InSet(column="state", values=("success",)),
        Between(column="try_number", min_value=1),
        Between(column="duration", min_value=0),
    ]
    found = evidence(dirty, rules, "adhoc", "dirty", ["dag_id", "execution_date", "state", "try_number", "duration"])
    shown = F.transform("examples", lambda x: F.from_json(x, "dag_id string, state string, try_number int, duration double"))
    wrong = {
        "not_null": lambda x: x["dag_id"].isNull(),
        "in_set": lambda x: x["state"] != "success",
        "between": lambda x: (x["try_number"] < 1) | (x["duration"] < 0),
    }
    right = F.lit(False)
    for kind, broke in wrong.items():
        right |= (F.col("check_type") == kind) & F.forall(shown, broke)
    listed = F.explode(F.arrays_zip(F.sequence(F.lit(1), F.size("top_values")), "top_values")).alias("top")
    return found.select(
        "check_name",
        "failed",
        F.size("examples").between(1, 5).alias("some_examples"),
        right.alias("examples_broke_it"),
        listed,
    ).select(
        "check_name", "failed", "some_examples", "examples_broke_it", "top.top_values.value", "top.top_values.rows"
    )


@query
def test_not_null(spark, sf_dir):
    return _on_dirty(spark, sf_dir, *not_null("dag_id", "task_id", "execution_date"))


@query
def test_unique(spark, sf_dir):
    runs = _runs(spark, sf_dir)
    return run_rules(
        runs, [Unique(column="dag_id"), Unique(column="execution_date")], "adhoc", "stg_dag_runs"
    )


@query
def test_unique_incremental(spark, sf_dir):
    """``test_unique`` kept up to date over four loads, the first of which is corrected later."""
    ensure_checkpoint_dir(spark)
    runs = fixtures.dag_runs(spark, sf_dir)
    part = F.coalesce(F.dayofyear("execution_date"), F.lit(0)) % 4
    steps = [{"0": part < 2, "1": part == 1}, {"0": part == 0}, {"2": part == 2, "3": part == 3}]
    with _database(spark) as database:
        table = f"{database}.dag_runs"
        checks = [UniqueOverLoads(table, c, f"{database}.unique_{c}") for c in ("dag_id", "execution_date")]
        for step in steps:
            for name, rows in step.items():
                load(runs.where(rows), table, "refresh", load_date=WINDOW_END.date(), load_id=name)
            for check in checks:
                check.update(spark, step)
        found = [check.result(spark, "adhoc", "stg_dag_runs") for check in checks]
        return reduce(DataFrame.unionByName, found).checkpoint()


@query
def test_accepted_values(spark, sf_dir):
    mart = QUERIES["sla_misses"](spark, sf_dir)
    rules = [
        accepted_values("entity_type", "dag", "task"),
        InSet(column="entity_type", values=("task",), name="tasks_only"),
    ]
    return run_rules(mart, rules, "adhoc", "sla_misses")


@query
def test_accepted_range(spark, sf_dir):
    staged = staging.stg_task_instances(fixtures.dirty_rows(spark, sf_dir))
    rules = [
        accepted_range("calculated_duration", 0),
        Between(column="calculated_duration", min_value=0, max_value=3600, name="one_hour"),
        accepted_range("try_number", 1),
    ]
    return run_rules(staged, rules, "adhoc", "stg_task_instances")


@query
def test_matrix(spark, sf_dir):
    sources = {
        "dag_runs": fixtures.dag_runs(spark, sf_dir),
        "task_instances": fixtures.task_instances(spark, sf_dir),
    }
    frame = model_frames(sources)
    models = (
        "stg_dag_runs",
        "stg_task_instances",
        "dag_runtime_metrics",
        "dag_failure_rates",
        "slowest_tasks",
        "sla_misses",
    )
    return run_model_tests({**sources, **{name: frame(name) for name in models}})
