"""The registered queries: each operator over the given tables.

Times come out as microseconds, doubles rounded to six places and integers as
BIGINT, so that results compare by value.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import signal, traffic
from roadstream.functions.clock import clock_micros
from roadstream.operators import (
    arima,
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
    sketches,
    splits,
    trend,
)
from roadstream.operators.series import SeriesPlan, plan_series
from roadstream.operators.sizes import checkpointed, dimension_join, run_folder
from roadstream.plans.features import processed_table
from roadstream.sources import synthetic
from roadstream.sources.events import TrafficTables, raw_measures, road_columns
from roadstream.sources.tables import load_table, save_table, series_table
from roadstream.streaming import reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SPAN = ("2024-01-01 00:00:00", "2024-06-30 00:00:00", 15)  # of the study
MONTH = ("2024-01-01 00:00:00", "2024-01-30 00:00:00", 15)  # of the load-test readings
RULE_LAGS = (1, 2, 4)


def tables(spark: SparkSession, folder: str) -> TrafficTables:
    return TrafficTables(spark, folder)


def rounded(c: Column) -> Column:
    """A double rounded to nine places, then to six: sums that differ in the last bit
    may not part at a tie.

    ``round`` makes a decimal of every value. Away from ties the first step changes nothing,
    and whole millionths below 1e12 divide exactly rounded.
    """
    millionths = c * 1e6
    off_ties = F.abs(millionths - F.floor(millionths) - 0.5) > 1e-3
    plain = F.floor(millionths + 0.5) / F.lit(1e6)
    return F.when((F.abs(c) < 1e6) & off_ties, plain).otherwise(F.round(F.round(c, 9), 6))


def tidy(df: DataFrame) -> DataFrame:
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df

    def column(name: str, kind: str) -> Column:
        c = F.col(name)
        if kind == "timestamp_ntz":
            return clock_micros(df, name).alias(f"{name}_us")
        if kind == "double":
            return rounded(c).alias(name)
        if kind == "float":
            return F.round(F.round(c, 9), 6).alias(name)
        if kind in ("int", "smallint", "tinyint"):
            return c.cast("bigint").alias(name)
        return c

    return df.select(*[column(*item) for item in df.dtypes])


def query(make: Callable[[TrafficTables], DataFrame]) -> Callable:
    """Register under the function's name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(make(tables(spark, sf_dir)))

    QUERIES[make.__name__] = run
    return make


def keyed(df: DataFrame, *columns) -> DataFrame:
    return df.select("segment_id", "timestamp", *columns)


# Sources


@query
def dense_panel(t: TrafficTables) -> DataFrame:
    return synthetic.dense_panel(t.roads.select("segment_id"), *SPAN)


@query
def synth_road_network(t: TrafficTables) -> DataFrame:
    return synthetic.synth_road_network(t.roads.select("segment_id"))


@query
def synth_readings(t: TrafficTables) -> DataFrame:
    roads = synthetic.synth_road_network(t.roads.select("segment_id"))
    return synthetic.synth_readings(roads, *MONTH)


@query
def traffic_pattern(t: TrafficTables) -> DataFrame:
    ts = F.col("timestamp")
    speed, volume = traffic.base_pattern(
        F.hour(ts), F.weekday(ts) >= 5, F.col("speed_limit"), F.col("road_type")
    )
    return keyed(t.raw, speed.alias("base_speed"), volume.alias("base_volume"))


@query
def derived_measures(t: TrafficTables) -> DataFrame:
    return synthetic.derived_measures(t.raw)


@query
def save_load_tables(t: TrafficTables) -> DataFrame:
    folder = run_folder(t.spark)
    save_table(t.readings, folder, "traffic_data")
    return load_table(t.spark, folder, "traffic_data")


@query
def rush_hour_flag(t: TrafficTables) -> DataFrame:
    flag = traffic.rush_hour(F.hour("timestamp")).alias("is_rush_hour")
    return keyed(t.raw, flag)


@query
def build_signals(t: TrafficTables) -> DataFrame:
    return signals.build_signals(t.roads)


# Projections and filters


@query
def speed_ratio(t: TrafficTables) -> DataFrame:
    return keyed(t.labelled, "speed_ratio")


@query
def congestion_level(t: TrafficTables) -> DataFrame:
    return keyed(t.labelled, "congestion_level")


@query
def congestion_code(t: TrafficTables) -> DataFrame:
    return keyed(t.labelled, "congestion_code")


@query
def calendar_features(t: TrafficTables) -> DataFrame:
    names = ("year", "month", "day", "hour", "minute", "day_of_week", "day_of_year")
    return keyed(features.add_calendar(t.readings), *names, "week_of_year")


@query
def cyclical_features(t: TrafficTables) -> DataFrame:
    names = ("hour_sin", "hour_cos", "dow_sin", "dow_cos")
    return keyed(features.add_calendar(t.readings), *names)


@query
def weekend_flag(t: TrafficTables) -> DataFrame:
    return keyed(features.add_calendar(t.readings), "is_weekend", "is_rush_hour")


@query
def segment_filter(t: TrafficTables) -> DataFrame:
    # On the stored column, so that the Parquet scan skips the other segments.
    wanted = t.events.filter(F.col("user_id").isin(1, 5, 12))
    return keyed(synthetic.derived_measures(raw_measures(wanted)), "speed_kmh")


@query
def signal_segments(t: TrafficTables) -> DataFrame:
    return signals.signal_segments(t.roads)


@query
def feature_projection(t: TrafficTables) -> DataFrame:
    return features.prepare_features_target(features.add_calendar(t.labelled))


@query
def status_color(t: TrafficTables) -> DataFrame:
    return keyed(t.labelled, traffic.status_color(F.col("congestion_level")).alias("color"))


@query
def status_text(t: TrafficTables) -> DataFrame:
    columns = ("segment_id", "speed_kmh", "volume_vehicles", "congestion_level")
    return keyed(t.labelled, traffic.status_text(*map(F.col, columns)).alias("status"))


# Joins


@query
def label_join(t: TrafficTables) -> DataFrame:
    return keyed(t.labelled, "speed_kmh", "speed_limit", "road_type", "congestion_code")


@query
def roadtype_join(t: TrafficTables) -> DataFrame:
    joined = joins.roadtype_join(t.labelled, t.roads, t.roads_at_most)
    return keyed(joined, "volume_vehicles", "road_type")


@query
def map_status(t: TrafficTables) -> DataFrame:
    return joins.map_status(t.labelled, t.roads, t.roads_at_most)


@query
def signal_metrics_join(t: TrafficTables) -> DataFrame:
    return joins.signal_metrics(t.signals, t.labelled, t.roads_at_most).select(
        "signal_id", "segment_id", "avg_volume", "avg_speed", "avg_density", "congested_share"
    )


@query
def signals_without_data(t: TrafficTables) -> DataFrame:
    # A road for each customer; only those that are users have readings.
    customers = t.spark.read.parquet(f"{t.folder}/customer.parquet")
    roads = road_columns(customers.select(F.col("c_custkey").alias("user_id")).distinct())
    placed = signals.build_signals(roads, None)
    return joins.signals_without_data(placed, t.readings).select("signal_id", "segment_id")


# Aggregations


@query
def level_distribution(t: TrafficTables) -> DataFrame:
    return profile.level_distribution(t.labelled)


@query
def volume_by_road_type(t: TrafficTables) -> DataFrame:
    joined = joins.roadtype_join(t.readings, t.roads, t.roads_at_most)
    return profile.volume_by_road_type(joined)


@query
def hourly_profile(t: TrafficTables) -> DataFrame:
    return profile.hourly_profile(t.readings)


@query
def segment_stats(t: TrafficTables) -> DataFrame:
    return profile.segment_stats(t.labelled)


@query
def congested_share(t: TrafficTables) -> DataFrame:
    return profile.congested_share(t.labelled)


@query
def peak_metrics(t: TrafficTables) -> DataFrame:
    return profile.peak_metrics(t.labelled)


# The code stands for the level: numbers aggregate in a hash table, text does not.
LATEST = ["speed_kmh", "volume_vehicles", "congestion_code"]


def named_level(df: DataFrame) -> DataFrame:
    level = traffic.level_name(F.col("congestion_code")).alias("congestion_level")
    return df.select("*", level).drop("congestion_code")


@query
def latest_per_segment(t: TrafficTables) -> DataFrame:
    return named_level(profile.latest_per_segment(t.labelled, LATEST))


@query
def latest_row_per_segment(t: TrafficTables) -> DataFrame:
    return named_level(profile.latest_per_segment(t.labelled, LATEST, mode="row"))


@query
def dataset_counts(t: TrafficTables) -> DataFrame:
    return profile.dataset_counts(t.readings, t.roads, t.signals)


@query
def distinct_segments(t: TrafficTables) -> DataFrame:
    return profile.distinct_segments(t.readings)


@query
def null_report(t: TrafficTables) -> DataFrame:
    return missing.null_report(t.features)


@query
def merged_sketches(t: TrafficTables) -> DataFrame:
    """Exact counts of each day, and whether its merged sketches are within their bounds."""
    # Half-day sketches, merged into those of the days.
    half = F.expr("hour < 12")
    parts = [sketches.daily_sketches(t.readings.filter(c)) for c in (half, ~half)]
    daily = sketches.merged(checkpointed(parts[0].unionByName(parts[1])), ["day"])
    found = sketches.check_rows(t.readings, daily)
    return found.withColumn("day", F.unix_date("day").cast("bigint"))


@query
def median_fill(t: TrafficTables) -> DataFrame:
    filled = missing.fill_missing(t.features, t.plan)
    return keyed(filled, *features.series_feature_names(filled))


@query
def processed_features(t: TrafficTables) -> DataFrame:
    return processed_table(t.readings, t.roads, t.plan, t.roads_at_most)


@query
def map_center(t: TrafficTables) -> DataFrame:
    return profile.map_center(t.roads)


@query
def hour_heatmap(t: TrafficTables) -> DataFrame:
    return profile.hour_heatmap(t.labelled)


@query
def forecast_alerts(t: TrafficTables) -> DataFrame:
    # Predicted percentage of a test row: the segment's training share in that hour.
    code = features.add_congestion_labels(t.readings, t.roads, t.roads_at_most)
    share = code.withColumn("congested", profile.congested() * 100.0)
    history = forecast.split_history(share, value="congested", plan=t.plan)
    predicted = forecast.seasonal_profile(history, t.plan)
    return profile.forecast_alerts(predicted.withColumnRenamed("forecast", "predicted"))


@query
def hotspots(t: TrafficTables) -> DataFrame:
    return profile.hotspots(t.labelled)


# Windows and splits


@query
def lag_features(t: TrafficTables) -> DataFrame:
    lagged = features.add_lags(t.readings, plan=t.plan)
    return keyed(lagged, *features.series_feature_names(lagged))


@query
def stored_lag_features(t: TrafficTables) -> DataFrame:
    """Lags of a table stored by series, without a shuffle."""
    stored = series_table(t.readings, f"{run_folder(t.spark)}/readings")
    found = features.add_lags(stored, plan=t.plan)
    return keyed(found, *features.series_feature_names(found))


def rolling(t: TrafficTables, kind: str) -> DataFrame:
    rolled = features.add_rolling(t.readings, plan=t.plan)
    return keyed(rolled, *[c for c in rolled.columns if f"rolling_{kind}" in c])


@query
def rolling_mean(t: TrafficTables) -> DataFrame:
    return rolling(t, "mean")


@query
def rolling_std(t: TrafficTables) -> DataFrame:
    return rolling(t, "std")


@query
def rolling_max(t: TrafficTables) -> DataFrame:
    return rolling(t, "max")


@query
def forward_fill(t: TrafficTables) -> DataFrame:
    names = features.series_feature_names(t.features)
    return keyed(features.forward_fill(t.features, plan=t.plan), *names)


@query
def supervised_windows(t: TrafficTables) -> DataFrame:
    # As text, in full, the arrays compare in SQL.
    def text(name: str) -> Column:
        return F.array_join(F.transform(name, lambda v: v.cast("string")), ",").alias(name)

    windows = features.supervised_windows(t.readings, plan=t.plan)
    return keyed(windows, text("x"), text("y"), "split")


@query
def positional_split(t: TrafficTables) -> DataFrame:
    return keyed(splits.positional_split(t.readings, plan=t.plan), "split")


@query
def temporal_split(t: TrafficTables) -> DataFrame:
    return keyed(splits.temporal_split(t.readings, plan=t.plan), "split")


@query
def random_split(t: TrafficTables) -> DataFrame:
    return keyed(splits.random_split(t.readings), "split")


@query
def series_split(t: TrafficTables) -> DataFrame:
    return keyed(splits.series_split(t.readings, plan=t.plan), "split")


@query
def split_counts(t: TrafficTables) -> DataFrame:
    return splits.split_counts(splits.positional_split(t.readings, plan=t.plan))


@query
def encode_road_type(t: TrafficTables) -> DataFrame:
    flags = [f"is_{name}" for name in p.ROAD_TYPES]
    return keyed(features.encode_road_type(t.labelled), "road_type_code", *flags)


@query
def standard_scale(t: TrafficTables) -> DataFrame:
    names = ["speed_kmh", "volume_vehicles", "density_vehicles_per_km", "hour"]
    numbers = [F.col(c).cast("double").alias(c) for c in names]
    rows = keyed(splits.temporal_split(t.readings, plan=t.plan), "split", *numbers)
    return scaling.standard_scale(rows, names)


# Classification


def rules(t: TrafficTables, lags=RULE_LAGS) -> DataFrame:
    return classify.rule_classifier(t.labelled, lags, t.plan)


@query
def rule_classifier(t: TrafficTables) -> DataFrame:
    return keyed(rules(t), "model", "label", "prediction")


@query
def argmax(t: TrafficTables) -> DataFrame:
    return keyed(rules(t), "model", traffic.argmax(F.col("scores")).alias("best"))


@query
def classification_metrics(t: TrafficTables) -> DataFrame:
    return metrics.classification_metrics(rules(t), ["model"])


@query
def auc_ovr_weighted(t: TrafficTables) -> DataFrame:
    return metrics.auc_ovr_weighted(rules(t), ["model"], t.plan.rows * len(RULE_LAGS))


@query
def log_loss(t: TrafficTables) -> DataFrame:
    rows = rules(t).withColumn("scores", metrics.normalised("scores"))
    return metrics.log_loss(rows, ["model"])


@query
def confusion_matrix(t: TrafficTables) -> DataFrame:
    return metrics.confusion_matrix(rules(t, (1,)))


@query
def class_report(t: TrafficTables) -> DataFrame:
    return metrics.class_report(rules(t, (1,)))


@query
def metric_unpivot(t: TrafficTables) -> DataFrame:
    wide = metrics.classification_metrics(rules(t), ["model"])
    return metrics.metric_unpivot(wide, ["accuracy", "precision", "recall", "f1_score"])


@query
def best_model(t: TrafficTables) -> DataFrame:
    return metrics.best_model(metrics.classification_metrics(rules(t), ["model"]))


def training(t: TrafficTables) -> DataFrame:
    return classify.training_table(t.labelled, plan=t.plan)


@query
def training_table(t: TrafficTables) -> DataFrame:
    rows = training(t)
    names = [c for c in rows.columns if "lag_" in c or "rolling_" in c]
    return keyed(rows, "split", "label", *names)


def written_training(t: TrafficTables) -> DataFrame:
    """The training table written once, for the passes of a fit."""
    return checkpointed(training(t))


def _forest(rows: DataFrame):
    return classify.random_forest(rows, trees=20, depth=8)


def tested(rows: DataFrame, name: str, model) -> DataFrame:
    # Written, because the metrics read the predictions twice.
    return checkpointed(classify.predict(name, model, rows.filter("split = 'test'")))


@query
def random_forest(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    return classify.evaluate(tested(rows, "random_forest", _forest(rows)), t.plan.rows)


@query
def boosted_trees(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    return classify.evaluate(tested(rows, "boosted_trees", _boosted(rows)), t.plan.rows)


@query
def neural_classifier(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    model = classify.neural_classifier(rows)
    return classify.evaluate(tested(rows, "neural_network", model), t.plan.rows)


@query
def predict(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    return keyed(tested(rows, "random_forest", _forest(rows)), "label", "prediction", "scores")


def _boosted(rows: DataFrame):
    return classify.boosted_trees(rows, rounds=10, depth=4, rate=0.2)


def calibrated(rows: DataFrame, model) -> tuple[DataFrame, DataFrame]:
    """Test predictions of boosted trees with raw scores and with probabilities."""
    held_out = classify.predict("boosted_trees", model, rows.filter("split = 'val'"))
    raw = tested(rows, "boosted_trees", model)
    return raw, classify.calibrate(checkpointed(held_out)).probabilities(raw)


@query
def boosted_probabilities(t: TrafficTables) -> DataFrame:
    """Log loss of probabilities pooled on validation rows, and of raw scores' softmax."""
    rows = written_training(t)
    raw, done = calibrated(rows, _boosted(rows))
    softmax = raw.withColumns(
        {
            "scores": metrics.normalised(F.transform("scores", lambda x: F.exp(x))),
            "model": F.lit("softmax"),
        }
    )
    return metrics.log_loss(done.unionByName(softmax), ["model"])


@query
def neural_early_stopping(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    model = classify.neural_early_stopping(rows).model
    return classify.evaluate(tested(rows, "neural_network", model), t.plan.rows)


@query
def predicted_rows(t: TrafficTables) -> DataFrame:
    """Rows that each classifier predicts, and whether its scores are probabilities that
    name the class."""
    rows = written_training(t)
    network = classify.neural_early_stopping(rows, most_rounds=10).model
    found = [
        tested(rows, "random_forest", _forest(rows)),
        calibrated(rows, _boosted(rows))[1],
        tested(rows, "neural_network", network),
    ]
    every = found[0].unionByName(found[1]).unionByName(found[2])
    total = F.reduce("scores", F.lit(0.0), lambda s, x: s + x)
    named = F.get("scores", "prediction") == F.array_max("scores")
    valid = (F.abs(total - 1) < 1e-9) & (F.array_min("scores") >= 0) & named
    return keyed(every, "model", "label", valid.alias("valid"))


@query
def feature_importance(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    return classify.feature_importance(_forest(rows), rows)


@query
def top_features(t: TrafficTables) -> DataFrame:
    rows = written_training(t)
    return classify.top_features(classify.feature_importance(_forest(rows), rows))


# Forecasts


def history(t: TrafficTables) -> DataFrame:
    return forecast.split_history(t.readings, plan=t.plan)


@query
def rename_ds_y(t: TrafficTables) -> DataFrame:
    return forecast.ds_y(t.readings)


@query
def seasonal_naive(t: TrafficTables) -> DataFrame:
    return forecast.seasonal_naive(history(t))


@query
def seasonal_profile(t: TrafficTables) -> DataFrame:
    return forecast.seasonal_profile(history(t), t.plan)


@query
def ar1_per_segment(t: TrafficTables) -> DataFrame:
    return forecast.ar1_per_segment(history(t), t.plan)


@query
def ar_diff5(t: TrafficTables) -> DataFrame:
    return forecast.ar_diff(t.readings, plan=t.plan)


@query
def fourier_seasonal(t: TrafficTables) -> DataFrame:
    return forecast.fourier_seasonal(t.readings, plan=t.plan)


@query
def trend_seasonal(t: TrafficTables) -> DataFrame:
    return trend.trend_seasonal(t.readings, plan=t.plan)


AR_MOST = 5


def lagged(t: TrafficTables) -> DataFrame:
    return forecast.split_history(t.readings, AR_MOST, plan=t.plan)


@query
def ar_order(t: TrafficTables) -> DataFrame:
    orders = arima.ar_orders(lagged(t), AR_MOST)
    phi = [F.coalesce(F.get("phi", F.lit(k)), F.lit(0.0)).alias(f"phi_{k + 1}") for k in range(AR_MOST)]
    return orders.select("segment_id", "n", "ar_order", *phi, "variance")


@query
def ar_auto(t: TrafficTables) -> DataFrame:
    return arima.ar_auto(lagged(t), AR_MOST, t.plan)


@query
def arma_span(t: TrafficTables) -> DataFrame:
    return arima.arma_span(t.readings, plan=t.plan)


@query
def ar1_span(t: TrafficTables) -> DataFrame:
    return forecast.ar1_span(history(t), t.plan)


@query
def ar1_future(t: TrafficTables) -> DataFrame:
    return forecast.ar1_future(t.readings, history(t), plan=t.plan)


@query
def future_frame(t: TrafficTables) -> DataFrame:
    return forecast.future_frame(t.readings)


@query
def direct_multi_horizon(t: TrafficTables) -> DataFrame:
    return forecast.direct_multi_horizon(t.readings, plan=t.plan)


def boosted_steps(t: TrafficTables) -> DataFrame:
    return forecast.boosted_multi_horizon(t.readings, rounds=10, depth=3, plan=t.plan)


@query
def boosted_multi_horizon(t: TrafficTables) -> DataFrame:
    return boosted_steps(t)


@query
def boosted_horizon_rows(t: TrafficTables) -> DataFrame:
    """Rows, steps and actual values of the boosted forecasts, and whether each is known."""
    found = boosted_steps(t)
    known = F.col("forecast").isNotNull() & ~F.isnan("forecast")
    return keyed(found, "step", "actual", known.alias("known"))


@query
def forecast_metrics(t: TrafficTables) -> DataFrame:
    return metrics.forecast_metrics(forecast.ar1_per_segment(history(t), t.plan))


@query
def forecast_report(t: TrafficTables) -> DataFrame:
    others = [
        ("one_step", "ar_auto", arima.ar_auto(lagged(t), AR_MOST, t.plan)),
        ("span", "arma_span", arima.arma_span(t.readings, plan=t.plan)),
    ]
    found = forecast.baseline_forecasts(history(t), t.plan)
    for kind, model, rows in others:
        named = rows.withColumns({"kind": F.lit(kind), "model": F.lit(model)})
        found = found.unionByName(named)
    return metrics.forecast_report(found)


# Signals and scenarios


def volumes(t: TrafficTables) -> DataFrame:
    """Peak volumes of every segment, not only of those with a signal."""
    return signals.with_volumes(profile.peak_metrics(t.labelled))


def optimized(t: TrafficTables) -> DataFrame:
    return signals.optimize_signals(t.signals, t.labelled, signals_at_most=t.roads_at_most)


@query
def timing_objective(t: TrafficTables) -> DataFrame:
    green = F.lit(p.GREEN)
    objective = signal.timing_objective(green, green, F.col("volume_ns"), F.col("volume_ew"))
    return volumes(t).select("segment_id", objective.alias("objective_value"))


@query
def optimize_timing(t: TrafficTables) -> DataFrame:
    return signals.best_timing(volumes(t)).select("segment_id", "best.*")


@query
def optimize_timing_grid(t: TrafficTables) -> DataFrame:
    return signals.best_timing(volumes(t), step=10).select("segment_id", "best.*")


@query
def search_timing(t: TrafficTables) -> DataFrame:
    return signals.search_timing(volumes(t)).select("segment_id", "best.*")


@query
def optimized_signals(t: TrafficTables) -> DataFrame:
    return optimized(t)


@query
def proportional_timing(t: TrafficTables) -> DataFrame:
    return signals.proportional_timing(volumes(t)).select(
        "segment_id", "green_ns", "green_ew", "cycle_length"
    )


@query
def signal_changes(t: TrafficTables) -> DataFrame:
    return signals.signal_changes(optimized(t))


@query
def first_n(t: TrafficTables) -> DataFrame:
    return signals.first_n(signals.signal_changes(optimized(t)))


@query
def timing_change(t: TrafficTables) -> DataFrame:
    return signals.timing_change(optimized(t))


def queues(t: TrafficTables) -> DataFrame:
    plans = checkpointed(scenario.scenario_union(optimized(t)))
    return scenario.queue_balance(t.readings, plans, 2 * t.roads_at_most, t.plan)


@query
def scenario_union(t: TrafficTables) -> DataFrame:
    return scenario.scenario_union(optimized(t))


@query
def queue_balance(t: TrafficTables) -> DataFrame:
    return queues(t).select(
        "signal_id", "scenario", "timestamp", "arrivals_ns", "arrivals_ew", "queue_ns", "queue_ew"
    )


@query
def scenario_compare(t: TrafficTables) -> DataFrame:
    return scenario.scenario_compare(queues(t))


@query
def scenario_pairs(t: TrafficTables) -> DataFrame:
    return scenario.scenario_pairs(scenario.scenario_compare(queues(t)))


@query
def scenario_improvement(t: TrafficTables) -> DataFrame:
    return scenario.scenario_improvement(scenario.scenario_compare(queues(t)))


@query
def benefits(t: TrafficTables) -> DataFrame:
    return scenario.benefits(scenario.scenario_compare(queues(t)))


@query
def what_if_incident(t: TrafficTables) -> DataFrame:
    affected = F.col("road_type") == "arterial"
    return profile.segment_stats(features.what_if_incident(t.labelled, affected))


# Streams


def event_stream(t: TrafficTables) -> DataFrame:
    files = reports.read_stream(t.spark, t.folder, t.events.schema, "events.parquet")
    return reports.timed(synthetic.derived_measures(raw_measures(files)))


WINDOW = ["segment_id", "window_start", "window_end"]


@query
def stream_interval_avg(t: TrafficTables) -> DataFrame:
    averages = reports.interval_averages(event_stream(t))
    return reports.run_latest(averages, run_folder(t.spark), WINDOW)


@query
def stream_latest(t: TrafficTables) -> DataFrame:
    latest = reports.status(reports.latest_state(event_stream(t)), t.roads)
    return reports.run_latest(latest, run_folder(t.spark))


@query
def stream_alerts(t: TrafficTables) -> DataFrame:
    labelled = reports.with_road(event_stream(t), t.roads)
    shares = reports.run_latest(reports.congested_windows(labelled), run_folder(t.spark), WINDOW)
    return reports.alerts(shares)


# The ways that only large tables take, forced on the given ones

CUT_ROWS = 20


def cut_plan(t: TrafficTables) -> SeriesPlan:
    """Series cut into blocks of a few rows."""
    return plan_series(t.readings, block_rows=CUT_ROWS)


@query
def large_label_join(t: TrafficTables) -> DataFrame:
    limits = t.roads.select("segment_id", "speed_limit", "road_type")
    joined = dimension_join(t.readings, limits, "segment_id", "left", limit=1)
    labelled = features.with_labels(joined)
    return keyed(labelled, "speed_kmh", "speed_limit", "road_type", "congestion_code")


@query
def large_median_fill(t: TrafficTables) -> DataFrame:
    filled = missing.fill_missing(t.features, t.plan, limit=0)
    return keyed(filled, *features.series_feature_names(filled))


@query
def large_positional_split(t: TrafficTables) -> DataFrame:
    plan = SeriesPlan(t.plan.rows, 10**9, t.plan.block_rows)
    return keyed(splits.positional_split(t.readings, plan=plan, limit=16), "split")


@query
def large_auc(t: TrafficTables) -> DataFrame:
    return metrics.auc_ovr_weighted(rules(t), ["model"], limit=100)


@query
def cut_lag_features(t: TrafficTables) -> DataFrame:
    lagged = features.add_lags(t.readings, plan=cut_plan(t))
    return keyed(lagged, *features.series_feature_names(lagged))


@query
def cut_rolling_mean(t: TrafficTables) -> DataFrame:
    rolled = features.add_rolling(t.readings, plan=cut_plan(t))
    return keyed(rolled, *[c for c in rolled.columns if "rolling_mean" in c])


@query
def cut_forward_fill(t: TrafficTables) -> DataFrame:
    names = features.series_feature_names(t.features)
    return keyed(features.forward_fill(t.features, plan=cut_plan(t)), *names)


@query
def cut_queue_balance(t: TrafficTables) -> DataFrame:
    plans = checkpointed(scenario.scenario_union(optimized(t)))
    found = scenario.queue_balance(t.readings, plans, 2 * t.roads_at_most, cut_plan(t))
    return found.select(
        "signal_id", "scenario", "timestamp", "arrivals_ns", "arrivals_ew", "queue_ns", "queue_ew"
    )
