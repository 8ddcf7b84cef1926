"""Long series are cut into blocks without changing any result."""

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadstream.operators import classify, features, forecast, scenario, series, splits
from roadstream.operators.series import plan_series
from roadstream.plans.features import processed_table
from roadstream.plans.queries import optimized

ROAD_LIMITS = "segment_id string, speed_limit double, road_type string"


@pytest.fixture(scope="module")
def hot(spark):
    """Half of the rows on one segment, most of those within a minute, some nulls."""
    n = F.col("id")
    moment = (
        F.when(n < 40, n * 3600)
        .when(n < 360, F.lit(40 * 3600) + n / 8)
        .otherwise(F.lit(50 * 3600) + n * 900)
    )
    hot = spark.range(400).select(
        F.lit("SEG_HOT").alias("segment_id"), moment.alias("s"), n.alias("k")
    )
    cold = spark.range(400).select(
        F.format_string("SEG_%02d", n % 20).alias("segment_id"),
        (n * 911.5).alias("s"),
        n.alias("k"),
    )
    k = F.col("k")
    both = hot.unionByName(cold).select(
        "segment_id",
        (F.lit(1704067200) + F.col("s")).cast("timestamp").cast("timestamp_ntz").alias("timestamp"),
        F.when(k % 7 != 3, (k * 37 % 61) + 5.25).alias("speed_kmh"),
        (k * 113 % 1900).cast("int").alias("volume_vehicles"),
        ((k * 53 % 97) / 8).alias("density_vehicles_per_km"),
    )
    return both.persist()


@pytest.fixture(scope="module")
def plans(hot):
    whole, cut = plan_series(hot), plan_series(hot, block_rows=50)
    assert not whole.split
    assert cut.split
    return whole, cut


def test_only_long_series_are_cut(plans, hot):
    _, cut = plans
    assert set(cut.cells["segment_id"]) == {"SEG_HOT"}
    assert cut.cells["n"].sum() == 400
    assert cut.cells["n"].max() <= 50
    assert len(cut.steps) > 1  # the busy minute needs a finer step


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, p: features.add_lags(d, plan=p),
        lambda d, p: features.add_rolling(d, plan=p),
        lambda d, p: features.add_rolling(d, shift=1, plan=p),
        lambda d, p: features.add_series_features(d, plan=p),
        lambda d, p: features.supervised_windows(d, plan=p),
        lambda d, p: splits.positional_split(d, plan=p),
        lambda d, p: splits.temporal_split(d, plan=p),
        lambda d, p: splits.series_split(d, plan=p),
        lambda d, p: forecast.split_history(d, 6, plan=p),
        lambda d, p: features.forward_fill(d, ["speed_kmh"], plan=p),
        lambda d, p: features.forward_fill(
            d.withColumn("speed_kmh", F.when(F.col("volume_vehicles") > 1800, 1.0)),
            ["speed_kmh"],
            plan=p,
        ),
        lambda d, p: features.forward_fill(features.add_series_features(d, plan=p), plan=p),
    ],
)
def test_cut_equals_whole(hot, plans, operator):
    whole, cut = plans
    expected = rows(operator(hot, whole))
    assert rows(operator(hot, cut)) == expected
    assert rows(operator(hot.repartition(17), cut)) == expected


def test_cut_of_every_series_equals_whole(traffic):
    cut = plan_series(traffic.readings, block_rows=9)
    assert cut.cells["segment_id"].nunique() == 15
    expected = rows(features.add_series_features(traffic.readings, plan=traffic.plan))
    assert rows(features.add_series_features(traffic.readings, plan=cut)) == expected


def test_cut_processed_table_equals_whole_and_shuffles_once(traffic):
    cut = plan_series(traffic.readings, block_rows=9)
    expected = rows(processed_table(traffic.readings, traffic.roads, traffic.plan, 1000))
    made = processed_table(traffic.readings, traffic.roads, cut, 1000)
    assert rows(made) == expected
    # The windows are in the written table; before it, the rows are shuffled once.
    assert "Window" not in made._jdf.queryExecution().executedPlan().toString()
    labelled = features.add_congestion_labels(traffic.readings, traffic.roads, 1000)
    series = features.add_series_features(labelled, plan=cut, keep_blocks=True)
    filled = features.forward_fill(series, features.series_feature_names(series), cut)
    plan = filled._jdf.queryExecution().executedPlan().toString()
    wide = plan.split("BroadcastExchange")[0]
    assert wide.count("Exchange hashpartitioning(segment_id") == 1


def test_cut_queue_equals_whole(traffic):
    plans = scenario.scenario_union(optimized(traffic))
    cut = plan_series(traffic.readings, block_rows=9)

    def queues(plan):
        return rows(scenario.queue_balance(traffic.readings, plans, 60, plan))

    assert queues(cut) == queues(traffic.plan)


def test_cut_training_table_equals_whole(traffic):
    cut = plan_series(traffic.readings, block_rows=9)
    expected = rows(classify.training_table(traffic.labelled, plan=traffic.plan))
    assert rows(classify.training_table(traffic.labelled, plan=cut)) == expected


def test_zone_with_summer_time_keeps_order(spark):
    """Clock times around a change to summer time stay in the order they read."""
    readings = spark.sql(
        """SELECT 'A' AS segment_id, timestamp_ntz'2024-03-10 01:00:00' + make_dt_interval(0,0,id*5) AS timestamp,
        cast(id AS double) AS speed_kmh, 1 AS volume_vehicles, 1.0D AS density_vehicles_per_km
        FROM range(40)"""
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        cut = plan_series(readings, block_rows=5)
        lagged = features.add_lags(readings, lags=(1,), plan=cut).orderBy("timestamp").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert [r.speed_lag_1 for r in lagged] == [None, *map(float, range(39))]


@pytest.mark.parametrize(
    "operator",
    [
        lambda d, p: features.add_lags(d, lags=(1, 2), plan=p),
        lambda d, p: features.supervised_windows(d, 3, 2, plan=p),
        lambda d, p: splits.temporal_split(d, plan=p),
        lambda d, p: forecast.split_history(d, 3, plan=p),
        lambda d, p: features.forward_fill(d, ["speed_kmh"], plan=p),
    ],
)
def test_readings_of_equal_time_are_ordered_by_the_ties(spark, operator):
    """As if each reading were a microsecond after the one before it."""
    made = spark.range(240).select(
        F.lit("A").alias("segment_id"),
        (F.lit(1704067200) + 60 * F.floor(F.col("id") / 6)).cast("timestamp").cast("timestamp_ntz").alias("timestamp"),
        (F.col("id") % 6).alias("sensor"),
        F.when(F.col("id") % 5 != 2, F.col("id") + 0.5).alias("speed_kmh"),
        F.col("id").cast("int").alias("volume_vehicles"),
        F.lit(1.0).alias("density_vehicles_per_km"),
    ).persist()
    later = F.col("timestamp") + F.make_dt_interval(secs=F.col("sensor") / 1e6)
    apart = made.withColumn("timestamp", later)

    def found(df, plan):
        minute = F.date_trunc("minute", "timestamp").cast("string")
        return rows(operator(df, plan).withColumn("timestamp", minute))

    expected = found(apart, plan_series(apart))
    for block in (None, 20):
        plan = plan_series(made, block, ties=("sensor",))
        assert plan.split == (block is not None)
        assert found(made.repartition(7, F.rand(3)), plan) == expected


def test_queues_with_ties(traffic):
    plans = scenario.scenario_union(optimized(traffic))
    tied = traffic.readings.withColumn("k", F.lit(1))
    cut = plan_series(tied, block_rows=9, ties=("k",))
    found = scenario.queue_balance(tied, plans, 60, cut)
    assert rows(found) == rows(scenario.queue_balance(traffic.readings, plans, 60, traffic.plan))


REACHES = [
    lambda d, p: features.add_lags(d, plan=p),
    lambda d, p: features.add_rolling(d, plan=p),
    lambda d, p: features.supervised_windows(d, 30, 25, plan=p),
    lambda d, p: splits.temporal_split(d, plan=p),
    lambda d, p: features.forward_fill(d, ["speed_kmh"], plan=p),
]


@pytest.mark.parametrize("operator", REACHES)
def test_a_plan_too_large_to_broadcast_stays_in_tables(hot, plans, monkeypatch, operator):
    """With blocks of a few rows, none of the plan comes to the driver."""
    expected = rows(operator(hot, plans[0]))

    def refused(*_):
        raise AssertionError("the plan came to the driver")

    monkeypatch.setattr(type(hot), "toPandas", refused)
    monkeypatch.setattr(type(hot.sparkSession), "createDataFrame", refused)
    cut = plan_series(hot, block_rows=10, limit=30)
    made = operator(hot, cut)
    assert "SortMergeJoin" in made._jdf.queryExecution().executedPlan().toString()
    assert rows(made) == expected


def test_large_plan_of_queues(traffic):
    plans = scenario.scenario_union(optimized(traffic))
    cut = plan_series(traffic.readings, block_rows=9, limit=14)
    found = scenario.queue_balance(traffic.readings, plans, 60, cut)
    assert rows(found) == rows(scenario.queue_balance(traffic.readings, plans, 60, traffic.plan))


def test_readings_without_time_or_segment(spark, hot):
    """Without a time they come first; those without a segment are not cut."""
    odd = hot.withColumns(
        {
            "timestamp": F.when(F.col("volume_vehicles") != 113, F.col("timestamp")),
            "segment_id": F.when(F.col("segment_id") != "SEG_07", F.col("segment_id")),
        }
    )
    ties = ("density_vehicles_per_km", "volume_vehicles")
    for operator in (splits.temporal_split, splits.series_split):
        expected = rows(operator(odd, plan=plan_series(odd, ties=ties)))
        for limit in (12, 1_000_000):
            assert rows(operator(odd, plan=plan_series(odd, 15, ties, limit))) == expected


def test_no_estimate_broadcasts_the_blocks_of_a_plan(hot, plans):
    """Blocks and cells meet by shuffle, and tables of a plan are broadcast up to a bound."""
    cut = plan_series(hot, block_rows=10)
    assert cut.limit == series.PLAN_ROWS <= 200_000
    made = series._targets(cut, 24, 0)
    made.collect()
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    expected = rows(features.add_lags(hot, plan=plans[0]))
    assert rows(features.add_lags(hot, plan=cut)) == expected
