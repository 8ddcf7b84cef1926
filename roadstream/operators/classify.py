"""Congestion classifiers on features that are known before the reading."""

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    MultilayerPerceptronClassifier,
    OneVsRest,
    OneVsRestModel,
    RandomForestClassifier,
)
from pyspark.ml.feature import Bucketizer, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import traffic
from roadstream.operators import metrics
from roadstream.operators.features import (
    add_calendar,
    encode_road_type,
    lag_columns,
    rolling_columns,
)
from roadstream.operators.network import fit_network, matrices
from roadstream.operators.series import SeriesPlan, plan_series, windowed
from roadstream.operators.sizes import checkpointed
from roadstream.operators.splits import named_split

KEYS = ("segment_id", "timestamp")
CALENDAR = ("hour_sin", "hour_cos", "dow_sin", "dow_cos", "is_weekend", "is_rush_hour")
# Typical speed ratio of each level, the middle of its range.
CENTERS = (0.9, 0.7, 0.5, 0.2)


def training_table(
    labelled: DataFrame, lags=p.LAGS, windows=p.ROLLING, plan: SeriesPlan | None = None
) -> DataFrame:
    """Keys, label, split and features without the current reading's measures.

    The first readings of each series have no complete history and drop out.
    """

    def build(d, s):
        split = named_split(s.position, s.length, p.TEST_SHARE, p.VALIDATION_SHARE)
        history = {**lag_columns(s, lags), **rolling_columns(s, windows, shift=1)}
        return d.withColumns({**history, "split": split})

    table = windowed(labelled, build, lookback=max(max(lags), max(windows)), plan=plan)
    coded = encode_road_type(add_calendar(table))
    names = [c for c in coded.columns if "lag_" in c or "rolling_" in c]
    names += [*CALENDAR, "speed_limit", *[f"is_{t}" for t in p.ROAD_TYPES]]
    kinds = dict(coded.dtypes)
    numbers = [c if kinds[c] == "double" else F.col(c).cast("double").alias(c) for c in names]
    # One condition per column: the optimizer handles a single one over all of them
    # (as na.drop makes) in time exponential in the number of columns.
    complete = reduce(and_, [F.col(c).isNotNull() for c in names])
    label = F.col("congestion_code").alias("label")
    return coded.filter(complete).select(*KEYS, "split", label, *numbers)


def feature_columns(table: DataFrame) -> list[str]:
    return [c for c in table.columns if c not in (*KEYS, "split", "label")]


def assembler(table: DataFrame, output: str = "features") -> VectorAssembler:
    return VectorAssembler(
        inputCols=feature_columns(table), outputCol=output, handleInvalid="error"
    )


def random_forest(
    table: DataFrame, trees: int = 200, depth: int = 20, min_rows: int = 2, seed: int = p.SEED
) -> PipelineModel:
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=min_rows, seed=seed
    )
    return Pipeline(stages=[assembler(table), forest]).fit(_train(table))


def boosted_trees(
    table: DataFrame,
    rounds: int = 300,
    depth: int = 8,
    rate: float = 0.05,
    row_share: float = 0.8,
    column_share: float = 0.8,
    seed: int = p.SEED,
) -> PipelineModel:
    """One boosted ensemble per level against the rest."""
    trees = GBTClassifier(
        maxIter=rounds,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_share,
        featureSubsetStrategy=str(column_share),
        seed=seed,
    )
    return Pipeline(stages=[assembler(table), OneVsRest(classifier=trees)]).fit(_train(table))


def neural_classifier(
    table: DataFrame,
    hidden=(128, 64, 32),
    rounds: int = 50,
    block: int = 64,
    seed: int = p.SEED,
) -> PipelineModel:
    layers = [len(feature_columns(table)), *hidden, len(p.LEVELS)]
    network = MultilayerPerceptronClassifier(
        layers=layers, maxIter=rounds, blockSize=block, seed=seed
    )
    scaler = StandardScaler(inputCol="raw", outputCol="features", withMean=True)
    train = _train(table)
    prepared = Pipeline(stages=[assembler(table, "raw"), scaler]).fit(train)
    rows = prepared.transform(train)
    model = fit_network(rows, network, matrices(rows, layers[-1], block))
    return PipelineModel([*prepared.stages, model])


@dataclass(frozen=True)
class Calibration:
    """A rising step function from score to probability for each class."""

    models: list[IsotonicRegressionModel]
    least: float

    def probabilities(self, predictions: DataFrame) -> DataFrame:
        """``predictions`` with probabilities, which sum to 1, for ``scores``, and the class
        with the greatest as ``prediction``."""
        columns = predictions.columns
        rows = predictions
        for k, model in enumerate(self.models):
            rows = model.transform(rows.withColumn(f"_score_{k}", F.get("scores", F.lit(k))))
        bounded = [F.greatest(F.col(f"_p_{k}"), F.lit(self.least)) for k in range(len(self.models))]
        scores = metrics.normalised(F.array(*bounded))
        best = traffic.argmax(F.col("scores")).cast("int")
        return rows.withColumn("scores", scores).withColumn("prediction", best).select(columns)


def calibrate(
    predictions: DataFrame, bins: int = 4096, rows_per_bin: int = 50
) -> Calibration:
    """Isotonic regression of each class on its score, from rows that no model learned from.

    Scores are first put into at most ``bins`` bins of about equal size, so that pooling
    works on a bounded number of points whatever the number of rows, and of about
    ``rows_per_bin`` rows at least, so that few rows are not followed one by one. A class
    seldom or never seen at a score keeps the probability of half a row.
    """
    count = predictions.count()
    bins = max(2, min(bins, count // rows_per_bin))
    classes = range(len(p.LEVELS))
    names = [f"_score_{k}" for k in classes]
    rows = predictions.select(
        "label", *[F.get("scores", F.lit(k)).alias(names[k]) for k in classes]
    )
    shares = [i / bins for i in range(1, bins)]
    cuts = rows.approxQuantile(names, shares, 1 / (4 * bins))
    models = []
    for k in classes:
        edges = [-float("inf"), *sorted(set(cuts[k])), float("inf")]
        binned = Bucketizer(splits=edges, inputCol=names[k], outputCol="bin").transform(rows)
        points = binned.groupBy("bin").agg(
            F.avg(names[k]).alias(names[k]),
            F.avg((F.col("label") == k).cast("double")).alias("share"),
            F.count("*").cast("double").alias("weight"),
        )
        isotonic = IsotonicRegression(
            featuresCol=names[k], labelCol="share", weightCol="weight", predictionCol=f"_p_{k}"
        )
        models.append(isotonic.fit(points))
    return Calibration(models, 0.5 / (count + 1))


@dataclass(frozen=True)
class Stopped:
    """The best of several networks, and the validation loss after each block of rounds."""

    model: PipelineModel
    losses: list[tuple[int, float, float, bool]]

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            self.losses, "rounds int, log_loss double, step double, is_best boolean"
        )


def neural_early_stopping(
    table: DataFrame,
    hidden=(128, 64, 32),
    most_rounds: int = 50,
    block_rounds: int = 5,
    patience: int = 10,
    plateau: int = 5,
    solver: str = "l-bfgs",
    step: float = 0.03,
    least_step: float = 1e-6,
    block: int = 64,
    seed: int = p.SEED,
) -> Stopped:
    """Network trained in blocks of rounds, each from the weights of the one before.

    After each block the validation rows are scored. Training ends when ``patience`` rounds
    bring no lower loss, and the weights with the lowest are kept. With ``solver="gd"``
    the step is halved after each ``plateau`` rounds without a lower loss.
    """
    prepared = Pipeline(
        stages=[assembler(table, "raw"), StandardScaler(inputCol="raw", outputCol="features", withMean=True)]
    ).fit(_train(table))
    rows = checkpointed(prepared.transform(table).select(*KEYS, "split", "label", "features"))
    train, held_out = _train(rows), rows.filter(F.col("split") == "val")
    layers = [len(feature_columns(table)), *hidden, len(p.LEVELS)]
    best, least, last, weights, losses = None, float("inf"), 0, None, []
    at_plateau = 0
    blocks = matrices(train, layers[-1], block) if solver == "l-bfgs" else None
    for done in range(block_rounds, most_rounds + 1, block_rounds):
        network = MultilayerPerceptronClassifier(
            layers=layers, maxIter=block_rounds, blockSize=block, seed=seed, solver=solver, stepSize=step
        )
        if weights is not None:
            network = network.setInitialWeights(weights)
        model = network.fit(train) if blocks is None else fit_network(train, network, blocks)
        weights = model.weights
        scored = predict("network", PipelineModel([model]), held_out)
        loss = metrics.log_loss(scored).first()["log_loss"]
        loss = float("inf") if loss is None or loss != loss else loss
        better = best is None or loss < least
        losses.append((done, loss, step, better))
        if better:
            best, least, last, at_plateau = model, loss, done, done
        if done - last >= patience:
            break
        if done - at_plateau >= plateau:
            step, at_plateau = max(step / 2, least_step), done
    return Stopped(PipelineModel([*prepared.stages, best]), losses)


def _train(table: DataFrame) -> DataFrame:
    return table.filter(F.col("split") == "train")


def predict(name: str, model: PipelineModel, rows: DataFrame) -> DataFrame:
    """Keys, label, model name, predicted class and one score per class.

    Models with probabilities give those; one-against-rest gives raw scores.
    """
    out = model.transform(rows)
    scores = "probability" if "probability" in out.columns else "rawPrediction"
    return out.select(
        *KEYS,
        "label",
        F.lit(name).alias("model"),
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array(scores).alias("scores"),
    )


def rule_classifier(labelled: DataFrame, lags=(1,), plan: SeriesPlan | None = None) -> DataFrame:
    """Predict the level that an earlier reading had: one model per lag.

    The score of a class falls with the distance of the old ratio from its centre.
    """
    plan = plan or plan_series(labelled)
    old = windowed(
        plan.narrow(labelled, "speed_kmh", "speed_limit", "congestion_code"),
        lambda d, s: d.withColumns(
            {f"old_{k}": F.lag("speed_kmh", k).over(s.window) for k in lags}
        ),
        lookback=max(lags),
        plan=plan,
    ).filter("congestion_code IS NOT NULL")

    def model(k: int) -> Column:
        ratio = traffic.speed_ratio(F.col(f"old_{k}"), F.col("speed_limit"))
        level = traffic.congestion_level(ratio)
        scores = F.array(*[1 / (1 + F.abs(ratio - center)) for center in CENTERS])
        known = F.col(f"old_{k}").isNotNull()
        return F.when(
            known,
            F.struct(
                F.lit(f"rule_lag_{k}").alias("model"),
                traffic.congestion_code(level).alias("prediction"),
                scores.alias("scores"),
            ),
        )

    models = F.explode(F.array(*[model(k) for k in lags])).alias("m")
    rows = old.select(*KEYS, F.col("congestion_code").alias("label"), models)
    return rows.filter("m IS NOT NULL").select(*KEYS, "label", "m.*")


def evaluate(predictions: DataFrame, rows_at_most: int | None = None) -> DataFrame:
    """One row per model: accuracy, precision, recall, f1_score, auc."""
    scores = metrics.classification_metrics(predictions, ["model"])
    return scores.join(metrics.auc_ovr_weighted(predictions, ["model"], rows_at_most), "model")


def feature_importance(model: PipelineModel, table: DataFrame) -> DataFrame:
    """(feature, importance) of a tree model; one-against-rest averages its models."""
    last = model.stages[-1]
    parts = last.models if isinstance(last, OneVsRestModel) else [last]
    weights = sum(part.featureImportances.toArray() for part in parts) / len(parts)
    rows = [(name, float(w)) for name, w in zip(feature_columns(table), weights)]
    return table.sparkSession.createDataFrame(rows, "feature string, importance double")


def top_features(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance"), "feature").limit(k)
