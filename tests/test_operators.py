from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from flowgauge.operators import (
    global_row_number,
    grouped_percentiles,
    join_thresholds,
    latest_per_key,
    rolling_mean,
    sla_thresholds,
    top_k,
)
from flowgauge.operators.percentile import magnitude_bucket


def interpolated(values, q):
    values = sorted(v for v in values if v is not None)
    if not values:
        return None
    place = q * (len(values) - 1)
    low, high = values[int(place)], values[min(int(place) + 1, len(values) - 1)]
    return low + (high - low) * (place - int(place))


def percentiles(spark, groups):
    rows = [(key, value) for key, values in groups.items() for value in values]
    df = spark.createDataFrame(rows, "g string, v double")
    result = grouped_percentiles(
        df,
        ["g"],
        "v",
        {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p100": 1.0},
        totals={"n": ("sum", "weight"), "low": ("min", "value")},
    )
    return {r.g: r for r in result.collect()}


def test_percentiles_of_edge_groups(spark):
    groups = {
        "single": [7.5],
        "pair": [1.0, 2.0],
        "ties": [3.0] * 10,
        "mixed_sign": [-5.0, -0.25, 0.0, -0.0, 0.25, 5.0, 1e300, -1e300],
        "with_nulls": [None, 4.0, None, 8.0],
        "tiny": [5e-324, 1e-300, 2.0],
        None: [1.0, 10.0, 100.0],
    }
    groups["only_nulls"] = [None, None]
    found = percentiles(spark, groups)
    assert set(found) == set(groups)
    for key, values in groups.items():
        row = found[key]
        assert row.n == len(values)
        for name, q in (("p0", 0.0), ("p50", 0.5), ("p95", 0.95), ("p100", 1.0)):
            wanted = interpolated(values, q)
            if wanted is None:
                assert row[name] is None, (key, name)
            else:
                assert row[name] == pytest.approx(wanted, rel=1e-15), (key, name)


def test_percentiles_count_infinity_and_nan_last(spark):
    row = percentiles(spark, {"g": [1.0, 2.0, float("inf"), float("nan")]})["g"]
    assert row.p0 == 1.0 and row.p100 != row.p100


def test_percentiles_match_the_builtin_with_one_hot_group(spark):
    """A third of the rows in one group, many repeated values, any partitioning."""
    noise = F.abs(F.xxhash64("id"))
    df = spark.range(60_000).select(
        F.when(noise % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("g"), noise % 97)).alias("g"),
        (F.exp((noise % 1009) / 100.0) - 20 + F.when(noise % 5 == 0, noise % 7).otherwise(0)).alias("v"),
    )
    wanted = df.groupBy("g").agg(
        F.percentile("v", F.lit(0.5)).alias("p50"), F.percentile("v", F.lit(0.95)).alias("p95")
    )
    for parts in (1, 7):
        found = grouped_percentiles(df.repartition(parts), ["g"], "v", {"a": 0.5, "b": 0.95})
        both = found.join(wanted, "g")
        assert both.count() == wanted.count()
        assert both.where("abs(a - p50) > 1e-9 or abs(b - p95) > 1e-9").count() == 0


def test_percentiles_with_a_third_of_all_values_in_one_bucket(spark):
    """Time-outs: many runs end a few microseconds after the same hour."""
    df = spark.range(30_000).select(
        F.lit("g").alias("g"),
        F.when(F.col("id") % 3 == 0, 3600 + F.col("id") * 1e-6).otherwise(F.col("id") % 7001).alias("v"),
    )
    assert df.where("v >= 3600 AND v < 3600.1").select(magnitude_bucket("v")).distinct().count() == 1
    quantiles = {"p1": 0.01, "p40": 0.4, "p50": 0.5, "p70": 0.7, "p95": 0.95}
    found = grouped_percentiles(df, ["g"], "v", quantiles).first()
    wanted = df.agg(*[F.percentile("v", F.lit(q)).alias(name) for name, q in quantiles.items()]).first()
    for name in quantiles:
        assert found[name] == pytest.approx(wanted[name], abs=1e-9)


def test_buckets_follow_the_order_of_values(spark):
    noise = F.xxhash64("id")
    df = spark.range(20_000).select(
        (F.exp((noise % 70_000) / 100.0) * F.when(noise % 2 == 0, 1).otherwise(-1)).alias("v")
    )
    listed = [r.b for r in df.select("v", magnitude_bucket("v").alias("b")).orderBy("v").collect()]
    assert listed == sorted(listed)


@pytest.fixture(scope="module")
def scores(spark):
    score = F.when(F.col("id") % 3 == 0, F.lit(5.0)).when(F.col("id") % 50 != 1, F.col("id") % 101)
    return spark.range(5000).select("id", score.alias("score"))


def test_global_row_number_equals_the_plain_window(spark, scores):
    order = [F.desc_nulls_last("score"), F.asc("id")]
    plain = scores.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    for parts in (1, 13):
        found = global_row_number(scores.repartition(parts), order, "rank")
        assert found.schema["rank"].dataType.simpleString() == "bigint"
        assert found.exceptAll(plain).count() == 0 and found.count() == 5000


def test_global_row_number_of_nothing(scores):
    assert global_row_number(scores.where("id < 0"), [F.asc("id")], "rank").count() == 0


def test_top_k_keeps_nulls_last_and_ranks(scores):
    best = top_k(scores, [F.desc_nulls_last("score"), F.asc("id")], 3, "place").collect()
    assert [r.place for r in best] == [1, 2, 3]
    assert [r.score for r in best] == [100.0] * 3
    assert top_k(scores.where("score is null"), [F.desc_nulls_last("score")], 3).count() == 3


def test_rolling_frame_counts_rows_not_days(spark):
    days = [datetime(2024, 1, d) for d in (1, 2, 9, 20)]
    df = spark.createDataFrame(
        [("a", day, float(n)) for n, day in enumerate(days)], "dag_id string, execution_day timestamp_ntz, r double"
    ).withColumn("r", F.col("r").cast("decimal(7,2)"))
    rows = df.select("execution_day", rolling_mean("r", 3).alias("m")).orderBy("execution_day").collect()
    assert [r.m for r in rows] == [0.0, 0.5, 1.0, 2.0]


def test_rolling_beyond_the_frame(spark):
    rows = [("a", datetime(2024, 1, 1) + timedelta(days=n), n) for n in range(40)]
    df = spark.createDataFrame(rows, "dag_id string, execution_day timestamp_ntz, r int")
    df = df.withColumn("r", F.col("r").cast("decimal(7,2)"))
    last = df.select("execution_day", rolling_mean("r", 30).alias("m")).orderBy(F.desc("execution_day")).first()
    assert last.m == sum(range(10, 40)) / 30


def test_thresholds_join_drops_unnamed_tasks_and_repeats_nothing(make_tasks):
    tasks = make_tasks(
        {"dag_id": "daily_1", "duration": 1.0},
        {"dag_id": "daily_1", "duration": 1.0},
        {"dag_id": None, "duration": 1.0},
        {"dag_id": "critical", "task_id": None, "duration": 1.0},
        {"dag_id": "x", "task_id": "unknown", "duration": 1.0},
    )
    limits = sla_thresholds(tasks).where("coalesce(task_id, '') <> 'unknown'")
    for broadcast_rows in (0, 100):
        joined = join_thresholds(tasks, limits, broadcast_rows).collect()
        assert [(r.dag_id, r.sla_threshold_seconds) for r in joined] == [("daily_1", 7200)] * 2


@pytest.mark.parametrize("salts", [1, 2, 64])
def test_thresholds_join_is_the_same_for_any_salt(spark, sf_dir, salts):
    from contract import fixtures

    tasks = fixtures.task_instances(spark, sf_dir)
    limits = sla_thresholds(tasks)
    plain = tasks.join(limits, ["dag_id", "task_id"])
    salted = join_thresholds(tasks, limits, broadcast_rows=0, salts=salts).select(*plain.columns)
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_latest_per_key(make_runs):
    early, late = datetime(2024, 1, 2), datetime(2024, 1, 3)
    rows = make_runs(
        {"state": "running", "extracted_at": early},
        {"state": "success", "extracted_at": late},
        {"dag_id": "b", "extracted_at": early},
        {"dag_id": None, "extracted_at": early},
    )
    kept = latest_per_key(rows, ["dag_id", "execution_date"])
    assert kept.columns == rows.columns
    assert {(r.dag_id, r.state) for r in kept.collect()} == {
        ("a", "success"),
        ("b", "success"),
        (None, "success"),
    }


def test_approximate_percentiles_keep_exact_totals(spark):
    from flowgauge.operators import grouped_percentiles

    df = spark.range(500).selectExpr("id % 2 as k", "double(id) as v", "if(id % 3 = 0, 's', 'f') as state")
    wanted = {
        "totals": {"n": ("sum", "weight"), "s": ("sum", "if(state = 's', weight, 0)"), "top": ("max", "value")},
        "facets": ["state"],
    }
    exact = grouped_percentiles(df, ["k"], "v", {"m": 0.5}, **wanted).orderBy("k").collect()
    rough = grouped_percentiles(df, ["k"], "v", {"m": 0.5}, **wanted, exact=False).orderBy("k").collect()
    assert [(r.k, r.n, r.s, r.top) for r in exact] == [(r.k, r.n, r.s, r.top) for r in rough]
    assert all(abs(a.m - b.m) <= 2 for a, b in zip(exact, rough))
