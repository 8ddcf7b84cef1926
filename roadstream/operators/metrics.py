"""Quality of class predictions and of forecasts."""

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.operators.sizes import SMALL_ROWS, prefix_sum

CLASSES = range(len(p.LEVELS))


def _cells(df: DataFrame, by: list[str]) -> DataFrame:
    """All true x predicted counts in one row, in one pass over the predictions."""
    return df.groupBy(*by).agg(
        *[
            F.count_if((F.col("label") == i) & (F.col("prediction") == j)).alias(f"c{i}{j}")
            for i in CLASSES
            for j in CLASSES
        ]
    )


def confusion_matrix(df: DataFrame) -> DataFrame:
    """4 x 4 counts: one row per true class, one column per predicted class."""
    rows = F.array(
        *[
            F.struct(
                F.lit(i).alias("label"), *[F.col(f"c{i}{j}").alias(f"pred_{j}") for j in CLASSES]
            )
            for i in CLASSES
        ]
    )
    return _cells(df, []).select(F.inline(rows))


def _total(columns) -> Column:
    return reduce(add, columns)


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _per_class() -> dict[int, dict[str, Column]]:
    """Precision, recall, F1 and support of each class from the count row."""
    out = {}
    for k in CLASSES:
        hit = F.col(f"c{k}{k}")
        support = _total([F.col(f"c{k}{j}") for j in CLASSES])
        predicted = _total([F.col(f"c{i}{k}") for i in CLASSES])
        out[k] = {
            "precision": _ratio(hit, predicted),
            "recall": _ratio(hit, support),
            "f1_score": _ratio(2 * hit, support + predicted),
            "support": support,
        }
    return out


SCORES = ("precision", "recall", "f1_score")


def _weighted(classes: dict[int, dict[str, Column]], score: str) -> Column:
    weighted = _total([c[score] * c["support"] for c in classes.values()])
    return _ratio(weighted, _total([c["support"] for c in classes.values()]))


def classification_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Accuracy and support-weighted precision, recall and F1, as one row per ``by``."""
    classes = _per_class()
    hits = _total([F.col(f"c{k}{k}") for k in CLASSES])
    rows = _total([c["support"] for c in classes.values()])
    return _cells(df, by or []).select(
        *(by or []),
        _ratio(hits, rows).alias("accuracy"),
        *[_weighted(classes, score).alias(score) for score in SCORES],
    )


def class_report(df: DataFrame) -> DataFrame:
    """Scores of each class, their plain mean and their mean weighted by support."""
    classes = _per_class()
    support = _total([c["support"] for c in classes.values()])

    def line(name: str, scores: dict[str, Column], rows: Column) -> Column:
        return F.struct(
            F.lit(name).alias("class"),
            *[scores[s].alias(s) for s in SCORES],
            rows.alias("support"),
        )

    lines = [line(p.LEVELS[k], classes[k], classes[k]["support"]) for k in CLASSES]
    macro = {s: _total([c[s] for c in classes.values()]) / len(classes) for s in SCORES}
    weighted = {s: _weighted(classes, s) for s in SCORES}
    lines += [line("macro avg", macro, support), line("weighted avg", weighted, support)]
    return _cells(df, []).select(F.inline(F.array(*lines)))


def log_loss(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Rows and mean of -ln of the probability given to the true class.

    ``scores`` are probabilities, one per class; none counts as less than 1e-15.
    """
    given = F.greatest(F.get("scores", F.col("label").cast("int")), F.lit(1e-15))
    return df.groupBy(*(by or [])).agg(
        F.count("*").alias("rows"), F.avg(-F.ln(given)).alias("log_loss")
    )


def normalised(scores: Column | str) -> Column:
    """Scores divided by their sum; equal ones if the sum is 0."""
    column = F.col(scores) if isinstance(scores, str) else scores
    total = F.reduce(column, F.lit(0.0), lambda s, x: s + x)
    share = F.lit(1.0) / F.size(column)
    return F.transform(column, lambda x: F.when(total > 0, x / total).otherwise(share))


def auc_ovr_weighted(
    df: DataFrame,
    by: list[str] | None = None,
    rows_at_most: int | None = None,
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """One-against-rest AUC weighted by class support; null if a class is missing.

    ``scores`` holds one score per class. The rows collapse to distinct scores
    first, then a running sum counts the negatives below each; ties count half.
    """
    by = by or []
    pairs = F.array(
        *[F.struct(F.lit(k).alias("class"), F.get("scores", F.lit(k)).alias("score")) for k in CLASSES]
    )
    each = df.select(*by, "label", F.inline(pairs))
    counts = each.groupBy(*by, "class", "score").agg(
        F.count_if(F.col("label") == F.col("class")).alias("positives"),
        F.count_if(F.col("label") != F.col("class")).alias("negatives"),
    )
    bound = None if rows_at_most is None else rows_at_most * len(p.LEVELS)
    ranked = prefix_sum(counts, [*by, "class"], ["score"], "negatives", "below", bound, limit)
    below = F.col("below") + F.col("negatives") / 2
    per_class = ranked.groupBy(*by, "class").agg(
        F.sum(F.col("positives") * below).alias("wins"),
        F.sum("positives").alias("p"),
        F.sum("negatives").alias("n"),
    )
    area = F.try_divide(F.col("wins"), F.col("p").cast("double") * F.col("n"))
    complete = (F.count("*") == len(p.LEVELS)) & (F.count(area) == len(p.LEVELS))
    return per_class.groupBy(*by).agg(
        F.when(complete, F.try_divide(F.sum(area * F.col("p")), F.sum("p"))).alias("auc")
    )


def forecast_metrics(df: DataFrame, by: list[str] | None = None) -> DataFrame:
    """RMSE, MAE, MAPE in percent and R2 of ``forecast`` against ``actual``."""
    error = F.col("actual") - F.col("forecast")
    known = df.filter(F.col("actual").isNotNull() & F.col("forecast").isNotNull())
    spread = F.var_pop("actual") * F.count("*")
    return known.groupBy(*(by or [])).agg(
        F.count("*").alias("n"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (F.avg(F.abs(F.try_divide(error, F.col("actual")))) * 100).alias("mape"),
        (1 - F.try_divide(F.sum(error * error), spread)).alias("r2"),
    )


def forecast_report(df: DataFrame) -> DataFrame:
    """Metrics of every model, with a mark on the one of its kind with the least RMSE."""
    rank = F.struct("rmse", "model")
    best = F.min(rank).over(Window.partitionBy("kind"))
    return forecast_metrics(df, ["kind", "model"]).withColumn("is_best", rank == best)


def best_model(metrics: DataFrame, metric: str = "accuracy", lowest: bool = False) -> DataFrame:
    """The model with the best value of a metric; the first by name among equals."""
    value = F.col(metric) if lowest else -F.col(metric)
    best = F.min_by(F.struct("model", metric), F.struct(value, F.col("model"))).alias("best")
    return metrics.filter(F.col(metric).isNotNull()).agg(best).select("best.*")


def metric_unpivot(metrics: DataFrame, names: list[str]) -> DataFrame:
    """Wide model metrics as (model, metric, score) with readable metric names."""
    long = metrics.unpivot("model", names, "metric", "score")
    return long.withColumn("metric", F.initcap(F.regexp_replace("metric", "_", " ")))
