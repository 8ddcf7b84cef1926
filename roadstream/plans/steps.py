"""The whole study, step by step over a folder of tables.

Each step reads the tables of the steps before it and writes its own. The written
tables cut the lineage between steps: a lost executor repeats part of one step.
"""

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.operators import arima, classify, forecast, metrics, scenario, signals, sketches, trend
from roadstream.operators.features import (
    add_congestion_labels,
    encode_road_type,
    prepare_features_target,
)
from roadstream.operators.scaling import apply_scaler, scaler_statistics
from roadstream.operators.series import plan_series
from roadstream.operators.sizes import checkpointed
from roadstream.plans.features import feature_rows, processed_table
from roadstream.sources import synthetic
from roadstream.sources.tables import load_table, save_model, save_splits, save_table


AR_MOST = 5


@dataclass(frozen=True)
class Study:
    spark: SparkSession
    folder: str

    def load(self, name: str) -> DataFrame:
        return load_table(self.spark, self.folder, name)

    def save(self, df: DataFrame, name: str, csv: bool = False) -> DataFrame:
        save_table(df, self.folder, name, csv)
        return self.load(name)

    def labelled(self) -> DataFrame:
        return add_congestion_labels(self.load("traffic_data"), self.load("road_network"))


def generate_all(
    study: Study,
    segments: int = 120,
    signal_count: int | None = None,
    start: str = "2024-01-01 00:00:00",
    end: str = "2024-06-30 00:00:00",
    minutes: int = 15,
    seed: int = p.SEED,
) -> None:
    """Roads, signals and readings, for load tests."""
    ids = synthetic.segment_ids(study.spark, segments)
    roads = study.save(synthetic.synth_road_network(ids, seed), "road_network", csv=True)
    study.save(signals.build_signals(roads, signal_count), "traffic_signals", csv=True)
    readings = synthetic.synth_readings(roads, start, end, minutes, seed)
    study.save(readings, "traffic_data", csv=True)


def process_all(study: Study, task: str = "classification", split: str = "temporal") -> list[str]:
    """Processed readings, scaler, and scaled features by split; returns the feature names.

    Splits and scores come from the written table, so its windows are computed once.
    """
    readings = study.load("traffic_data")
    plan = plan_series(readings)
    fitted: dict[str, DataFrame] = {}
    made = processed_table(readings, study.load("road_network"), plan, fitted=fitted)
    processed = study.save(made, "processed_traffic_data", csv=True)
    study.save(fitted["fill_values"], "fill_values")
    study.save(sketches.daily_sketches(readings), "daily_sketches")
    rows, features = feature_rows(processed, task, split, plan)
    scaler = study.save(scaler_statistics(rows, features), "scaler")
    save_splits(apply_scaler(rows, scaler), study.folder)
    names = study.spark.createDataFrame([(f,) for f in features], "feature string")
    study.save(names, "feature_names")
    return features


def processed_by_saved(study: Study, readings: DataFrame) -> DataFrame:
    """New readings processed with the saved fill values, from the folder alone."""
    saved = study.load("fill_values")
    return processed_table(readings, study.load("road_network"), saved=saved)


def scaled_by_saved(study: Study, processed: DataFrame, task: str = "classification") -> DataFrame:
    """New processed rows scored with the saved scaler."""
    rows = prepare_features_target(encode_road_type(processed), task)
    scaler = study.load("scaler")
    numbers = {r.feature: F.col(r.feature).cast("double") for r in scaler.collect()}
    return apply_scaler(rows.withColumns(numbers), scaler)


def train_classifiers(
    study: Study, forest: dict | None = None, boosted: dict | None = None, network: dict | None = None
) -> DataFrame:
    """Fit and save the three classifiers; scores on the test rows, one row per model.

    The network stops early by its loss on the validation rows, and boosting's raw scores
    become probabilities on them. Saves the scores on the validation rows, the network's
    losses, and the confusion matrix and class report of each model, too.
    """
    table = checkpointed(classify.training_table(study.labelled()))
    test, validation = table.filter("split = 'test'"), table.filter("split = 'val'")
    stopped = classify.neural_early_stopping(table, **(network or {}))
    study.save(stopped.table(study.spark), "neural_losses")
    fitted: dict[str, PipelineModel] = {
        "random_forest": classify.random_forest(table, **(forest or {})),
        "boosted_trees": classify.boosted_trees(table, **(boosted or {})),
        "neural_network": stopped.model,
    }
    importance, predictions, validated = [], [], []
    for name, model in fitted.items():
        save_model(model, study.folder, name)
        found, checked = (classify.predict(name, model, rows) for rows in (test, validation))
        if name == "boosted_trees":
            calibration = classify.calibrate(checkpointed(checked))
            for k, isotonic in enumerate(calibration.models):
                isotonic.write().overwrite().save(f"{study.folder}/calibration_{k}")
            found, checked = (calibration.probabilities(rows) for rows in (found, checked))
        predictions.append(found)
        validated.append(checked)
        if name != "neural_network":
            weights = classify.feature_importance(model, table)
            importance.append(weights.withColumn("model", F.lit(name)))
    study.save(_union(importance), "feature_importance")
    found = study.save(_union(predictions), "classification_predictions")
    checked = study.save(_union(validated), "validation_predictions")
    study.save(classify.evaluate(checked), "validation_metrics")
    study.save(metrics.log_loss(found, ["model"]), "log_losses")
    of_each = [(n, found.filter(F.col("model") == n)) for n in fitted]
    for table_name, make in (
        ("confusion_matrices", metrics.confusion_matrix),
        ("class_reports", metrics.class_report),
    ):
        parts = [make(rows).drop("model").withColumn("model", F.lit(n)) for n, rows in of_each]
        study.save(_union(parts), table_name)
    return study.save(classify.evaluate(found), "classification_metrics")


def train_forecasts(study: Study, boosted: dict | None = None) -> DataFrame:
    """Forecasts of every model for every segment; their errors, one row per model.

    The fitted models are saved, and the AR(1) forecasts of the next times.
    """
    readings = study.load("traffic_data").select("segment_id", "timestamp", "speed_kmh")
    plan = plan_series(readings)
    history = checkpointed(forecast.split_history(readings, plan=plan))
    study.save(forecast.ar1_lines(history), "ar1_lines")
    study.save(forecast.ar1_future(readings, history, plan=plan), "future_forecasts")
    lagged = checkpointed(forecast.split_history(readings, AR_MOST, plan=plan))
    study.save(arima.ar_orders(lagged, AR_MOST), "ar_orders")
    fitted: dict[str, PipelineModel | DataFrame] = {}
    made = {
        ("ar_diff5", "one_step"): forecast.ar_diff(readings, plan=plan, fitted=fitted),
        ("fourier_seasonal", "span"): forecast.fourier_seasonal(
            readings, plan=plan, fitted=fitted
        ),
        ("direct_multi_horizon", "four_steps"): forecast.direct_multi_horizon(
            readings, plan=plan, fitted=fitted
        ).drop("step"),
        ("boosted_multi_horizon", "four_steps"): forecast.boosted_multi_horizon(
            readings, plan=plan, fitted=fitted, **(boosted or {})
        ).drop("step"),
        ("ar_auto", "one_step"): arima.ar_auto(lagged, AR_MOST, plan),
        ("arma_span", "span"): arima.arma_span(readings, plan=plan, fitted=fitted),
        ("trend_seasonal", "span"): trend.trend_seasonal(readings, plan=plan, fitted=fitted),
    }
    for name, one in fitted.items():
        if isinstance(one, DataFrame):
            study.save(one, name)
        else:
            save_model(one, study.folder, name)
    columns = ["kind", "model", "segment_id", "timestamp", "actual", "forecast"]
    parts = [forecast.baseline_forecasts(history, plan)]
    parts += [
        df.withColumns({"model": F.lit(name), "kind": F.lit(kind)})
        for (name, kind), df in made.items()
    ]
    found = study.save(_union([part.select(columns) for part in parts]), "forecasts")
    return study.save(metrics.forecast_report(found), "forecast_metrics")


def run_optimization(study: Study) -> DataFrame:
    """Signals with the timing that suits their peak volume."""
    table = study.load("traffic_signals")
    made = signals.optimize_signals(table, study.labelled())
    return study.save(made, "optimized_signals", csv=True)


def run_simulation(study: Study) -> DataFrame:
    """Results of the old and the new timing on the observed arrivals, and their value."""
    plans = scenario.scenario_union(study.load("optimized_signals"))
    queues = scenario.queue_balance(study.load("traffic_data"), plans)
    results = study.save(scenario.scenario_compare(queues), "scenario_results", csv=True)
    study.save(scenario.scenario_improvement(results), "improvements")
    return study.save(scenario.benefits(results), "benefits")


def evaluate_all(study: Study) -> DataFrame:
    """Best classifier by accuracy and best forecast of each kind by RMSE:
    (kind, model, metric, score)."""
    errors = study.load("forecast_metrics")
    best = {"classifier": ("accuracy", metrics.best_model(study.load("classification_metrics")))}
    for kind in ("one_step", "four_steps", "span"):
        of_kind = metrics.best_model(errors.filter(F.col("kind") == kind), "rmse", lowest=True)
        best[f"{kind}_forecaster"] = ("rmse", of_kind)
    rows = [
        df.select(
            F.lit(kind).alias("kind"),
            "model",
            F.lit(metric).alias("metric"),
            F.col(metric).alias("score"),
        )
        for kind, (metric, df) in best.items()
    ]
    return study.save(_union(rows), "best_models")


def _union(frames: list[DataFrame]) -> DataFrame:
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame)
    return whole
