"""Hand-checked answers on small tables."""

import math

import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadstream.operators import (
    classify,
    features,
    forecast,
    joins,
    metrics,
    missing,
    profile,
    scaling,
    scenario,
    signals,
)
from roadstream.plans.features import feature_tables
from roadstream.sources.synthetic import derived_measures

READING = (
    "segment_id string, timestamp timestamp_ntz, speed_kmh double, volume_vehicles int, "
    "density_vehicles_per_km double, is_rush_hour boolean, hour int"
)
ROAD = "segment_id string, speed_limit double, road_type string, latitude double, longitude double"


def readings(spark, values, segment="A", rush=False):
    data = [
        (segment, i, None if v is None else float(v), 10 * i, 1.0, rush, i % 24)
        for i, v in enumerate(values)
    ]
    kind = READING.replace("timestamp timestamp_ntz", "i int")
    return spark.createDataFrame(data, kind).selectExpr(
        "segment_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 15 * i) AS timestamp",
        "* EXCEPT (segment_id, i)",
    )


def roads(spark, *segments, limit=100.0):
    return spark.createDataFrame([(s, limit, "highway", 1.0, 2.0) for s in segments], ROAD)


def labelled(spark, values, **kw):
    return features.add_congestion_labels(readings(spark, values, **kw), roads(spark, "A"))


def test_unknown_segment_is_severe(spark):
    row = features.add_congestion_labels(readings(spark, [50]), roads(spark, "B")).first()
    assert (row.speed_limit, row.speed_ratio) == (None, None)
    assert (row.congestion_level, row.congestion_code) == ("Severe", 3)


def test_thresholds_are_inclusive(spark):
    found = labelled(spark, [80, 79.99, 60, 59.99, 40, 39.99]).orderBy("timestamp")
    assert [r.congestion_code for r in found.collect()] == [0, 1, 1, 2, 2, 3]


def test_nan_and_null_speed_are_severe_and_not_averaged(spark):
    df = labelled(spark, [math.nan, None, 90])
    codes = [r.congestion_code for r in df.orderBy("timestamp").collect()]
    assert codes == [3, 3, 0]
    by_hour = profile.hourly_profile(df).orderBy("hour").collect()
    assert [r.avg_speed for r in by_hour] == [None, None, 90.0]


def test_zero_speed(spark):
    raw = spark.sql(
        """SELECT 'A' AS segment_id, timestamp_ntz'2024-01-01 08:00:00' AS timestamp, 0D AS speed,
        12.9D AS volume, 60D AS speed_limit, 2D AS length_km, false AS has_accident"""
    )
    row = derived_measures(raw).first()
    assert (row.density_vehicles_per_km, row.travel_time_min) == (0.0, 999.0)
    assert (row.speed_kmh, row.volume_vehicles, row.is_rush_hour) == (5.0, 12, True)


def test_single_reading(spark):
    row = features.add_series_features(readings(spark, [30])).first()
    assert (row.speed_lag_1, row.speed_rolling_std_4) == (None, None)
    assert row.speed_rolling_mean_4 == 30.0
    history = forecast.split_history(readings(spark, [30]))
    assert rows(forecast.ar1_per_segment(history).select("forecast")) == [(None,)]


def test_ar1_of_a_constant_series_is_its_mean(spark):
    history = forecast.split_history(readings(spark, [30] * 10))
    found = forecast.ar1_per_segment(history).select("actual", "forecast")
    assert rows(found) == [(30.0, 30.0)] * 2


@pytest.mark.parametrize("n,windows", [(27, 0), (28, 0), (29, 1), (30, 2)])
def test_window_count(spark, n, windows):
    found = features.supervised_windows(readings(spark, range(n))).collect()
    assert len(found) == windows
    if found:
        assert found[0].x == [float(v) for v in range(24)]
        assert found[0].y == [24.0, 25.0, 26.0, 27.0]


def test_window_keeps_place_of_nulls(spark):
    values = [None if i == 3 else i for i in range(29)]
    assert features.supervised_windows(readings(spark, values)).first().x[2:5] == [2.0, None, 4.0]


def test_forward_fill_leaves_the_head(spark):
    df = readings(spark, [None, 1, None, None, 4])
    filled = features.forward_fill(df, ["speed_kmh"]).orderBy("timestamp")
    assert [r.speed_kmh for r in filled.collect()] == [None, 1.0, 1.0, 1.0, 4.0]


def test_fill_missing(spark):
    df = (
        readings(spark, [10, 20, 40])
        .withColumn("x_lag_1", F.when(F.col("speed_kmh") > 10, F.col("speed_kmh")))
        .withColumn("nothing", F.lit(None).cast("double"))
        .withColumn("flag", F.lit(None).cast("boolean"))
        .withColumn("name", F.lit(None).cast("string"))
    )
    found = missing.fill_missing(df).orderBy("timestamp").collect()
    assert [r.x_lag_1 for r in found] == [30.0, 20.0, 40.0]
    assert (found[0].nothing, found[0].flag, found[0]["name"]) == (None, False, "0")
    report = missing.null_report(df).first()
    assert (report.x_lag_1, report.nothing, report.total) == (1, 3, 10)


def test_latest_by_column_and_by_row(spark):
    df = readings(spark, [10, 20, None])
    by_column = profile.latest_per_segment(df, ["speed_kmh", "volume_vehicles"]).first()
    by_row = profile.latest_per_segment(df, ["speed_kmh", "volume_vehicles"], "row").first()
    assert (by_column.speed_kmh, by_column.volume_vehicles) == (20.0, 20)
    assert (by_row.speed_kmh, by_row.volume_vehicles) == (None, 20)
    assert by_column.timestamp == by_row.timestamp


def test_peak_metrics_fall_back_to_all_hours(spark):
    calm = labelled(spark, [10, 90])
    assert profile.peak_metrics(calm).first().avg_speed == 50.0
    rush = calm.withColumn("is_rush_hour", F.col("speed_kmh") > 50)
    row = profile.peak_metrics(rush).first()
    assert (row.avg_speed, row.congested_share) == (90.0, 0.0)
    silent = rush.withColumn("speed_kmh", F.when(~F.col("is_rush_hour"), F.col("speed_kmh")))
    assert profile.peak_metrics(silent).first().avg_speed is None


def test_signal_without_readings(spark):
    table = spark.createDataFrame([("S0", "A"), ("S1", "Z")], "signal_id string, segment_id string")
    df = labelled(spark, [50, 60])
    assert rows(joins.signal_metrics(table, df).select("signal_id")) == [("S0",)]
    assert rows(joins.signals_without_data(table, df)) == [("Z", "S1")]


def predictions(spark, pairs):
    data = [(t, p, [1.0 if k == p else 0.0 for k in range(4)]) for t, p in pairs]
    return spark.createDataFrame(data, "label int, prediction int, scores array<double>")


def test_missing_class(spark):
    df = predictions(spark, [(0, 0), (1, 0), (2, 2), (2, 2)])
    assert metrics.auc_ovr_weighted(df).first().auc is None
    assert [tuple(r) for r in metrics.confusion_matrix(df).collect()] == [
        (0, 1, 0, 0, 0),
        (1, 1, 0, 0, 0),
        (2, 0, 0, 2, 0),
        (3, 0, 0, 0, 0),
    ]
    report = {r["class"]: r for r in metrics.class_report(df).collect()}
    assert tuple(report["Severe"])[1:] == (0.0, 0.0, 0.0, 0)
    assert report["Free Flow"].precision == 0.5
    assert report["weighted avg"].recall == pytest.approx(0.75)


def test_auc_counts_ties_half(spark):
    labels, scores = [0, 1, 2, 3, 0, 1, 2, 3], [0.5, 0.5, 0.1, 0.2, 0.9, 0.5, 0.1, 0.9]
    data = [(t, [s, 1 - s, s * s, 0.3]) for t, s in zip(labels, scores)]
    df = spark.createDataFrame(data, "label int, scores array<double>")
    expected = 0.0
    for k in range(4):
        inside = [s[k] for t, s in data if t == k]
        outside = [s[k] for t, s in data if t != k]
        wins = sum((a > b) + (a == b) / 2 for a in inside for b in outside)
        expected += wins / len(inside) / len(outside) * len(inside) / len(data)
    assert metrics.auc_ovr_weighted(df).first().auc == pytest.approx(expected)


def test_best_model_takes_first_name_among_equals(spark):
    table = spark.createDataFrame(
        [("b", 0.9, 2.0), ("a", 0.9, 3.0), ("c", None, None)],
        "model string, accuracy double, rmse double",
    )
    assert metrics.best_model(table).first().model == "a"
    assert metrics.best_model(table, "rmse", lowest=True).first().model == "b"


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame(
        [(5.0, 1.0, "train"), (5.0, 3.0, "train"), (7.0, 5.0, "test")], "c double, v double, split string"
    )
    assert rows(scaling.standard_scale(df, ["c", "v"])) == [
        (0.0, -1.0, "train"),
        (0.0, 1.0, "train"),
        (2.0, 3.0, "test"),
    ]


@pytest.mark.parametrize(
    "volume,best", [(0, (120, 120)), (80, (120, 120)), (100, (120, 20)), (300, (20, 20))]
)
def test_best_corner(spark, volume, best):
    df = signals.with_volumes(spark.range(1).select(F.lit(float(volume)).alias("avg_volume")))
    corner = signals.best_timing(df).first().best
    grid = signals.best_timing(df, step=25).first().best
    assert (corner.green_ns, corner.green_ew) == best
    assert grid.objective_value == pytest.approx(corner.objective_value)


def test_over_saturated_queue_grows(spark):
    df = readings(spark, [50] * 6).withColumn("volume_vehicles", F.lit(3600))
    plan = spark.createDataFrame(
        [("baseline", "S", "A", 50, 50, 110)],
        "scenario string, signal_id string, segment_id string, green_ns int, green_ew int, cycle_length int",
    )
    queues = scenario.queue_balance(df, plan)
    found = [r.queue_ns for r in queues.orderBy("timestamp").collect()]
    assert found == [85 * (i + 1) for i in range(6)]
    result = scenario.scenario_compare(queues).first()
    assert result.total_vehicles_served == 6 * (25 + 25)
    assert result.total_vehicles_arrived == 6 * (110 + 88)
    assert result.max_queue_length == (85 * 6 + 63 * 6) / 2


def test_queue_matches_the_cycle_by_cycle_rule(spark):
    volumes = [(i * 577) % 1700 for i in range(60)]
    df = readings(spark, [50] * 60).withColumn(
        "volume_vehicles", (F.col("volume_vehicles") / 10 * 577 % 1700).cast("int")
    )
    plan = spark.createDataFrame(
        [("baseline", "S", "A", 50, 50, 110)],
        "scenario string, signal_id string, segment_id string, green_ns int, green_ew int, cycle_length int",
    )
    found = scenario.queue_balance(df, plan).orderBy("timestamp").collect()
    left = 0
    for row, volume in zip(found, volumes):
        left = max(0, left + volume * 110 // 3600 - 25)
        assert row.queue_ns == left


def test_iso_week_at_year_end(spark):
    df = spark.sql(
        """SELECT explode(array(timestamp_ntz'2024-12-30 10:15:00', timestamp_ntz'2025-01-01 00:00:00'))
        AS timestamp, true AS is_rush_hour"""
    )
    found = features.add_calendar(df).select("year", "week_of_year", "day_of_week", "day_of_year")
    assert rows(found) == [(2024, 1, 0, 365), (2025, 1, 2, 1)]


def test_status_color_of_an_unknown_level(spark):
    from roadstream.functions.traffic import status_color

    df = spark.createDataFrame([("Severe",), ("?",), (None,)], "l string")
    assert [r[0] for r in df.select(status_color(F.col("l"))).collect()] == ["darkred", "gray", "gray"]


def test_empty_input(spark):
    empty = labelled(spark, [1]).filter("false")
    assert features.add_series_features(empty).count() == 0
    assert features.supervised_windows(empty).count() == 0
    assert profile.level_distribution(empty).count() == 0
    assert profile.segment_stats(empty).count() == 0
    assert profile.congested_share(empty).first().congested_share is None
    assert metrics.confusion_matrix(classify.rule_classifier(empty)).count() == 4
    assert metrics.classification_metrics(classify.rule_classifier(empty)).first().accuracy == 0.0
    assert missing.fill_missing(empty).count() == 0


def test_feature_tables(traffic):
    made = feature_tables(traffic.readings, traffic.roads, roads_at_most=1000)
    assert len(made.processed.columns) == 53
    assert made.processed.count() == made.scaled.count() == 1000
    sizes = {r.split: r["count"] for r in made.scaled.groupBy("split").count().collect()}
    assert sum(sizes.values()) == 1000 and set(sizes) == {"train", "val", "test"}
    train = made.scaled.filter("split = 'train'")
    mean, std = train.agg(F.avg("speed_lag_1"), F.stddev_pop("speed_lag_1")).first()
    assert mean == pytest.approx(0, abs=1e-9) and std == pytest.approx(1)


@pytest.mark.parametrize("name", ["latest_per_segment", "latest_row_per_segment", "map_status"])
def test_latest_state_sorts_no_readings(spark, name):
    from conftest import DATA
    from roadstream.plans.queries import QUERIES

    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate" in plan and "SortAggregate" not in plan
