"""The study from generated readings to benefits."""

import pytest
from pyspark.sql import functions as F

from roadstream.plans import steps
from roadstream.sources.tables import load_model


@pytest.fixture(scope="module")
def study(spark, tmp_path_factory):
    made = steps.Study(spark, str(tmp_path_factory.mktemp("study")))
    steps.generate_all(made, segments=15, signal_count=4, end="2024-01-08 23:45:00", minutes=60)
    return made


def test_generated_tables(study):
    assert study.load("traffic_data").count() == 15 * 8 * 24
    assert study.load("road_network").count() == 15
    assert 1 <= study.load("traffic_signals").count() <= 4


def test_features(study):
    names = steps.process_all(study)
    assert len(names) == 47  # 44 features, the road type as a number and three flags
    processed = study.load("processed_traffic_data")
    assert len(processed.columns) == 53
    splits = study.spark.read.parquet(f"{study.folder}/splits")
    assert splits.count() == processed.count()
    assert study.load("feature_names").count() == len(names)
    # Fill values and daily sketches are kept; new readings need nothing else.
    assert study.load("fill_values").count() == 27
    daily = study.load("daily_sketches")
    assert daily.agg(F.sum("rows")).first()[0] == processed.count()
    new = steps.processed_by_saved(study, study.load("traffic_data"))
    assert new.count() == processed.count() and set(new.columns) == set(processed.columns)
    # New rows are scored from the saved folder alone, like the rows it was fitted on.
    again = steps.scaled_by_saved(study, processed)
    keys = ["segment_id", "timestamp"]
    both = splits.select(*keys, F.col(names[0]).alias("a")).join(
        again.select(*keys, F.col(names[0]).alias("b")), keys
    )
    assert both.count() == processed.count() and both.filter("abs(a - b) > 1e-12").isEmpty()


def test_models(study):
    scores = steps.train_classifiers(
        study, {"trees": 5, "depth": 5}, {"rounds": 2, "depth": 3}, {"most_rounds": 10}
    )
    assert scores.count() == study.load("log_losses").count() == 3
    losses = study.load("neural_losses").orderBy("rounds").collect()
    assert [r.rounds for r in losses] == [5, 10] and losses[0].is_best
    errors = steps.train_forecasts(study, {"rounds": 3, "depth": 3})
    assert errors.count() == 11
    assert errors.filter("is_best").count() == errors.select("kind").distinct().count() == 3
    best = {r.kind: r for r in steps.evaluate_all(study).collect()}
    assert best["classifier"].score == scores.agg(F.max("accuracy")).first()[0]
    for kind in ("one_step", "four_steps", "span"):
        least = errors.filter(F.col("kind") == kind).agg(F.min("rmse")).first()[0]
        assert best[f"{kind}_forecaster"].score == least
    assert study.load("validation_metrics").count() == 3
    assert study.load("confusion_matrices").count() == 3 * 4
    assert study.load("class_reports").count() == 3 * 6
    assert study.load("future_forecasts").count() == 15 * 4
    for name in ("ar_diff", "fourier", "boosted_1", "boosted_4"):
        assert load_model(study.folder, name).stages
    assert study.load("direct_weights").count() == 4 * 25
    assert study.load("arma_weights").count() == 9 + 8 and study.load("ar_orders").count() == 15
    assert study.load("trend_weights").count() == 25 and study.load("trend_means").count() == 15
    assert study.load("fourier_means").count() == study.load("ar1_lines").count() == 15


def test_signals(study):
    optimized = steps.run_optimization(study)
    assert optimized.count() == study.load("traffic_signals").count()
    value = steps.run_simulation(study).first()
    assert value.total_economic_benefit_usd == pytest.approx(
        value.time_savings_value_usd + value.fuel_savings_value_usd
    )
    results = study.load("scenario_results")
    assert results.filter("total_vehicles_served > total_vehicles_arrived").isEmpty()
    assert results.filter("utilization < 0 OR max_queue_length < 0").isEmpty()


def test_generated_study_has_all_signals(spark, tmp_path):
    made = steps.Study(spark, str(tmp_path))
    steps.generate_all(made, segments=200, end="2024-01-01 01:00:00", minutes=60)
    every = steps.signals.signal_segments(made.load("road_network")).count()
    assert made.load("traffic_signals").count() == every > 30
