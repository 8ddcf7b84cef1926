"""Models learn something, and their results are finite."""

import math

import pytest
from pyspark.sql import functions as F

from roadstream.operators import classify, forecast, metrics
from roadstream.plans.queries import training
from roadstream.sources.synthetic import segment_ids, synth_readings, synth_road_network
from roadstream.sources.tables import load_model, save_model


@pytest.fixture(scope="module")
def generated(spark):
    roads = synth_road_network(segment_ids(spark, 12))
    readings = synth_readings(roads, "2024-01-01 00:00:00", "2024-01-14 23:45:00", 60)
    return readings.persist(), roads.persist()


@pytest.fixture(scope="module")
def table(generated):
    from roadstream.operators.features import add_congestion_labels

    readings, roads = generated
    return classify.training_table(add_congestion_labels(readings, roads, 12)).persist()


@pytest.mark.parametrize(
    "fit",
    [
        lambda t: classify.random_forest(t, trees=20, depth=8),
        lambda t: classify.boosted_trees(t, rounds=5, depth=4, rate=0.3),
        lambda t: classify.neural_classifier(t, rounds=60),
    ],
)
def test_classifier_beats_the_majority(table, fit):
    test = table.filter("split = 'test'")
    found = classify.evaluate(classify.predict("m", fit(table), test), 10_000).first()
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    assert found.accuracy > majority
    assert 0.5 < found.auc <= 1


def test_importance_and_saved_model(spark, table, tmp_path):
    model = classify.random_forest(table, trees=5, depth=4)
    importance = classify.feature_importance(model, table)
    assert importance.agg(F.sum("importance")).first()[0] == pytest.approx(1)
    assert importance.count() == len(classify.feature_columns(table))
    top = classify.top_features(importance).collect()
    assert len(top) == 10 and top[0].importance == max(r.importance for r in top)
    save_model(model, str(tmp_path), "forest")
    test = table.filter("split = 'test'")
    again = classify.predict("m", load_model(str(tmp_path), "forest"), test)
    assert again.exceptAll(classify.predict("m", model, test)).isEmpty()


def test_training_table_has_no_current_measure(traffic):
    names = classify.feature_columns(training(traffic))
    assert not {"speed_kmh", "density_vehicles_per_km", "volume_vehicles"} & set(names)


def test_forecasts_beat_the_mean(generated):
    readings, _ = generated
    for make in (forecast.fourier_seasonal, forecast.direct_multi_horizon):
        found = metrics.forecast_metrics(make(readings)).first()
        assert found.n > 0 and math.isfinite(found.rmse) and found.r2 > 0.5


def test_fourier_equals_regression_with_indicators(generated, spark):
    """Centring gives the coefficients that one indicator per segment gives."""
    import numpy as np

    readings, _ = generated
    ours = {
        (r.segment_id, r.timestamp): r.forecast
        for r in forecast.fourier_seasonal(readings).collect()
    }
    terms = forecast.fourier_terms(F.col("timestamp"), {24: 4, 168: 3})
    day = F.unix_date(F.col("timestamp").cast("date")) + F.hour("timestamp") / 24
    data = forecast.split_history(readings).select(
        "segment_id", "timestamp", "split", F.ln("actual").alias("y"), day.alias("trend"),
        *[c.alias(n) for n, c in terms.items()],
    ).toPandas()
    x = data[["trend", *terms]].to_numpy()
    dummies = (data["segment_id"].to_numpy()[:, None] == np.unique(data["segment_id"])).astype(float)
    full, train = np.hstack([x, dummies]), (data["split"] == "train").to_numpy()
    beta = np.linalg.lstsq(full[train], data["y"].to_numpy()[train], rcond=None)[0]
    expected = np.exp(full[~train] @ beta)
    keys = zip(data["segment_id"][~train], data["timestamp"][~train])
    for key, value in zip(keys, expected):
        assert ours[key[0], key[1].to_pydatetime()] == pytest.approx(value, rel=1e-6)


def test_ar_diff_on_a_known_process(spark):
    """y grows by half of its last growth: the next value is exactly known."""
    values, step = [0.0], 64.0
    for _ in range(40):
        values.append(values[-1] + step)
        step = step / 2 + 3
    data = [("A", i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(data, "segment_id string, i int, speed_kmh double").selectExpr(
        "segment_id",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 15 * i) AS timestamp",
        "speed_kmh",
    )
    found = forecast.ar_diff(df, order=1).collect()
    assert all(r.forecast == pytest.approx(r.actual, abs=1e-6) for r in found)


def test_probabilities_of_boosting(table):
    """Pooled on validation rows: rising in the score, summing to 1, a lower loss."""
    model = classify.boosted_trees(table, rounds=5, depth=4, rate=0.3)
    held_out, test = (
        classify.predict("m", model, table.filter(F.col("split") == split)) for split in ("val", "test")
    )
    calibration = classify.calibrate(held_out, bins=50)
    done = calibration.probabilities(test)
    assert done.columns == test.columns and done.count() == test.count()
    for row in done.collect():
        assert sum(row.scores) == pytest.approx(1) and min(row.scores) > 0
        assert row.scores[row.prediction] == max(row.scores)
    for k, isotonic in enumerate(calibration.models):
        shares = list(isotonic.predictions)
        assert shares == sorted(shares) and 0 <= shares[0] and shares[-1] <= 1
        assert len(shares) <= 50 + 1, k
    softmax = test.withColumn("scores", metrics.normalised(F.transform("scores", lambda x: F.exp(x))))
    loss = [metrics.log_loss(d).first() for d in (done, softmax)]
    assert loss[0].rows == loss[1].rows and loss[0].log_loss < loss[1].log_loss


def test_pooling_equals_brute_force(spark):
    """One row a bin: adjacent violators pooled as in the plain algorithm."""
    rows = [(0 if i in (2, 5, 9, 11) else 1, [float(-i), float(i), 0.0, 0.0]) for i in range(12)]
    df = spark.createDataFrame(rows, "label int, scores array<double>")
    found = classify.calibrate(df, bins=1000, rows_per_bin=1).models[1]
    pools = []
    for label, _ in rows:
        pools.append([float(label), 1])
        while len(pools) > 1 and pools[-2][0] > pools[-1][0]:
            value, n = pools.pop()
            pools[-1] = [(pools[-1][0] * pools[-1][1] + value * n) / (pools[-1][1] + n), pools[-1][1] + n]
    want = [value for value, n in pools for _ in range(n)]
    scored = found.transform(df.withColumn("_score_1", F.get("scores", F.lit(1))))
    got = [r._p_1 for r in scored.orderBy("_score_1").collect()]
    assert got == pytest.approx(want)


def test_network_stops_early_with_the_best_weights(spark, table):
    done = classify.neural_early_stopping(
        table, hidden=(8,), most_rounds=60, block_rounds=2, patience=4, plateau=2
    )
    rounds = [r[0] for r in done.losses]
    losses = [r[1] for r in done.losses]
    best = min(range(len(losses)), key=losses.__getitem__)
    assert rounds == list(range(2, 2 * len(rounds) + 1, 2))
    assert rounds[-1] == 60 or rounds[-1] - rounds[best] >= 4
    assert [r[3] for r in done.losses] == [x < min([*losses[:i], math.inf]) for i, x in enumerate(losses)]
    held_out = classify.predict("m", done.model, table.filter("split = 'val'"))
    assert metrics.log_loss(held_out).first().log_loss == pytest.approx(losses[best])
    assert done.table(spark).count() == len(losses)


def test_network_halves_its_step_on_a_plateau(table):
    done = classify.neural_early_stopping(
        table, hidden=(4,), most_rounds=12, block_rounds=2, patience=8, plateau=2, solver="gd", step=1e-9
    )
    steps = [r[2] for r in done.losses]
    for k in range(1, len(steps)):
        assert steps[k] == (steps[k - 1] if done.losses[k - 1][3] else max(steps[k - 1] / 2, 1e-6))


def test_network_takes_the_steps_of_spark(table):
    """Weights after some rounds, from the first ones and from given ones."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.feature import StandardScaler

    from roadstream.operators import network

    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    stages = [classify.assembler(table, "raw"), scaler]
    train = table.filter("split = 'train'")
    rows = Pipeline(stages=stages).fit(train).transform(train).persist()
    layers = [len(classify.feature_columns(table)), 16, 8, 4]
    perceptron = MultilayerPerceptronClassifier(layers=layers, maxIter=12, blockSize=64, seed=42)
    blocks = network.matrices(rows, 4, 64)
    want, found = perceptron.fit(rows), network.fit_network(rows, perceptron, blocks)
    assert found.weights.toArray() == pytest.approx(want.weights.toArray(), rel=1e-4, abs=1e-5)
    perceptron = perceptron.setInitialWeights(want.weights)
    want, found = perceptron.fit(rows), network.fit_network(rows, perceptron, blocks)
    assert found.weights.toArray() == pytest.approx(want.weights.toArray(), rel=1e-3, abs=1e-4)


def test_network_refuses_labels_that_are_no_class(table):
    from pyspark.ml.feature import VectorAssembler

    from roadstream.operators import network

    odd = table.filter("split = 'train'").withColumn("label", F.lit(4))
    rows = VectorAssembler(inputCols=["speed_limit"], outputCol="features").transform(odd)
    with pytest.raises(Exception, match="numbers below 4"):
        network.matrices(rows, 4, 64)
