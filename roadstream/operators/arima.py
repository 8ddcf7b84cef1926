"""Autoregressions of chosen order and models with moving-average terms.

Null readings make the rows that need them unusable: they are left out of the fits, and
a forecast that needs one is null.
"""

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.operators.forecast import KEYS, TEST, TRAIN, split_history
from roadstream.operators.regression import linear, products, solve, weight_table
from roadstream.operators.series import SeriesPlan
from roadstream.operators.sizes import checkpointed, dimension_join


def autocovariances(history: DataFrame, most: int) -> DataFrame:
    """Of each segment's training values: ``n``, ``mean`` and the array ``c`` of
    autocovariances at lag 0 to ``most``, from one aggregate of sums."""
    y = F.col("actual")
    sums = [F.count(y).alias("n"), F.avg(y).alias("mean"), F.sum(y * y).alias("s_0")]
    for k in range(1, most + 1):
        lag = F.col(f"lag_{k}")
        sums += [
            F.sum(y * lag).alias(f"s_{k}"),
            F.sum(F.when(y.isNotNull(), lag) + y).alias(f"t_{k}"),
            F.count(y + lag).alias(f"m_{k}"),
        ]
    mean, n = F.col("mean"), F.col("n")
    c = [F.col("s_0") / n - mean * mean] + [
        F.coalesce((F.col(f"s_{k}") - mean * F.col(f"t_{k}") + F.col(f"m_{k}") * mean * mean) / n, F.lit(0.0))
        for k in range(1, most + 1)
    ]
    found = history.filter(TRAIN).groupBy("segment_id").agg(*sums).filter("n > 0")
    return found.select("segment_id", "n", "mean", F.array(*c).alias("c"))


def levinson(c: Column, n: Column, most: int) -> Column:
    """Order, coefficients and noise variance of the autoregression with the least
    n * ln(variance) + 2 * order, by the Levinson-Durbin recursion on autocovariances."""
    dot = lambda phi, m: F.reduce(
        F.zip_with(phi, F.reverse(F.slice(c, 2, m - 1)), lambda f, x: f * x),
        F.lit(0.0),
        lambda s, x: s + x,
    )

    def once(value: Column, use) -> Column:
        """``use`` of a value that is computed once."""
        return F.get(F.transform(F.array(value), use), F.lit(0))

    def step(state: Column, m: Column) -> Column:
        phi, error = state["phi"], state["error"]
        share = F.when(error > 0, (F.get(c, m) - dot(phi, m)) / error).otherwise(0.0)

        def grown(k: Column) -> Column:
            longer = F.concat(
                F.zip_with(phi, F.reverse(phi), lambda f, x: f - k * x), F.array(k)
            )
            left = error * (1 - k * k)
            score = n * F.ln(left) + 2.0 * m
            return F.struct(longer.alias("phi"), left.alias("error"), score.alias("score"))

        def better(new: Column) -> Column:
            kept = F.coalesce(new["score"] < state["score"], F.lit(False))
            return F.struct(
                new["phi"].alias("phi"),
                new["error"].alias("error"),
                F.when(kept, new["score"]).otherwise(state["score"]).alias("score"),
                F.when(kept, new["phi"]).otherwise(state["best"]).alias("best"),
                F.when(kept, new["error"]).otherwise(state["variance"]).alias("variance"),
            )

        return once(once(share, grown), better)

    none = F.array().cast("array<double>")
    begin = F.struct(
        none.alias("phi"),
        F.get(c, F.lit(0)).alias("error"),
        (n * F.ln(F.get(c, F.lit(0)))).alias("score"),
        none.alias("best"),
        F.get(c, F.lit(0)).alias("variance"),
    )
    orders = F.array(*[F.lit(m) for m in range(1, most + 1)])
    return F.reduce(
        orders,
        begin,
        step,
        lambda s: F.struct(
            F.size(s["best"]).alias("ar_order"), s["best"].alias("phi"), s["variance"].alias("variance")
        ),
    )


def ar_orders(history: DataFrame, most: int = 5) -> DataFrame:
    """One row per segment: ``n``, ``mean``, ``ar_order``, ``phi`` and ``variance``.

    ``history`` needs its lags up to ``most``. A constant series has order 0.
    """
    found = autocovariances(history, most)
    chosen = levinson(F.col("c"), F.col("n"), most).alias("chosen")
    return found.select("segment_id", "n", "mean", chosen).select("segment_id", "n", "mean", "chosen.*")


def ar_auto(history: DataFrame, most: int = 5, plan: SeriesPlan | None = None) -> DataFrame:
    """One-step forecast of test rows by the autoregression of each segment's own order."""
    segments = plan.segments_at_most if plan else None
    orders = ar_orders(history, most).select("segment_id", "mean", "phi")
    rows = dimension_join(history.filter(TEST), orders, "segment_id", "left", segments)
    lags = F.slice(F.array(*[F.col(f"lag_{k}") for k in range(1, most + 1)]), 1, F.size("phi"))
    parts = F.zip_with("phi", lags, lambda f, x: f * (x - F.col("mean")))
    value = F.col("mean") + F.reduce(parts, F.lit(0.0), lambda s, x: s + x)
    return rows.select(*KEYS, "actual", value.alias("forecast"))


@dataclass(frozen=True)
class Arma:
    """A model of the differences: constant, then weights of earlier differences and of
    earlier errors; the errors are those of a longer autoregression."""

    long: list[float]
    constant: float
    ar: list[float]
    ma: list[float]

    def step(self) -> np.ndarray:
        """One step of (sum of differences, last differences, last errors, 1) as a matrix."""
        n_ar, n_ma = len(self.ar), len(self.ma)
        size = n_ar + n_ma + 2
        out = np.zeros((size, size))
        change = np.array([0.0, *self.ar, *self.ma, self.constant])
        out[0], out[1], out[-1, -1] = change, change, 1
        out[0, 0] = 1
        for k in range(1, n_ar):
            out[1 + k, k] = 1
        for k in range(1, n_ma):
            out[1 + n_ar + k, n_ar + k] = 1
        return out


def _difference(k: int) -> Column:
    later = F.col("actual") if k == 0 else F.col(f"lag_{k}")
    return later - F.col(f"lag_{k + 1}")


def _error(k: int, long: list[float]) -> Column:
    """Error of the long autoregression k readings back."""
    earlier = [F.lit(1.0), *[_difference(k + j) for j in range(1, len(long))]]
    return _difference(k) - linear(long, earlier)


def fit_arma(history: DataFrame, ar: int = 5, ma: int = 2, long: int = 8) -> Arma:
    """Two-stage estimate for all segments together, each stage one aggregate.

    ``history`` needs its lags up to ``ma + long + 1``.
    """
    train = history.filter(TRAIN)
    target = _difference(0).alias("y")
    before = {f"d_{k}": _difference(k) for k in range(1, max(ar, long) + 1)}
    first = train.select(*[before[f"d_{k}"].alias(f"d_{k}") for k in range(1, long + 1)], target)
    long_weights = solve(products(first, first.columns))[0][:, 0].tolist()
    errors = [_error(k, long_weights).alias(f"e_{k}") for k in range(1, ma + 1)]
    second = train.select(
        *[before[f"d_{k}"].alias(f"d_{k}") for k in range(1, ar + 1)], *errors, target
    )
    weights = solve(products(second, second.columns))[0][:, 0].tolist()
    return Arma(long_weights, weights[0], weights[1 : 1 + ar], weights[1 + ar :])


def arma_span(
    df: DataFrame,
    ar: int = 5,
    ma: int = 2,
    long: int = 8,
    plan: SeriesPlan | None = None,
    fitted: dict | None = None,
) -> DataFrame:
    """Forecast of every test row from the end of training alone, differences with
    ``ar`` earlier differences and ``ma`` earlier errors.

    All steps of the recursion are powers of one matrix. Step h = a * base + b needs the
    power a of the base step and the first row of the power b, so two tables of about the
    square root of the longest span hold all of them; no row holds a span.
    """
    spark = df.sparkSession
    history = checkpointed(split_history(df, ma + long + 1, plan=plan))
    model = fit_arma(history, ar, ma, long)
    if fitted is not None:
        names = [f"long_{k}" for k in range(long + 1)] + ["constant"]
        names += [f"ar_{k + 1}" for k in range(ar)] + [f"ma_{k + 1}" for k in range(ma)]
        weights = [*model.long, model.constant, *model.ar, *model.ma]
        fitted["arma_weights"] = weight_table(spark, names, weights)
    state = [F.lit(0.0), *[_difference(k) for k in range(ar)]]
    state += [_error(k, model.long) for k in range(ma)] + [F.lit(1.0)]
    train = history.filter(TRAIN)
    last = train.groupBy("segment_id").agg(
        F.max_by(F.struct("position", "actual", F.array(*state).alias("state")), "position").alias("last")
    )
    segments = plan.segments_at_most if plan else None
    test = dimension_join(history.filter(TEST), last, "segment_id", "left", segments)
    test = test.withColumn("h", F.col("position") - F.col("last.position"))
    steps = test.agg(F.max("h")).first()[0] or 0
    base = max(1, int(np.ceil(np.sqrt(steps + 1))))
    one = model.step()
    within, power = [], np.eye(len(one))
    for b in range(base):
        within.append((b, power[0].tolist()))
        power = power @ one
    across, far = [], np.eye(len(one))
    for a in range(steps // base + 1):
        across.append((a, far.T.tolist()))
        far = far @ power
    near = spark.createDataFrame(within, "b long, weights array<double>")
    jumps = spark.createDataFrame(across, "a long, columns array<array<double>>")
    placed = test.withColumns({"a": F.floor(F.col("h") / base), "b": F.col("h") % base})
    rows = dimension_join(placed, near, "b", "left", rows_at_most=base)
    rows = dimension_join(rows, jumps, "a", "left", rows_at_most=len(across))

    def dot(one: Column, other: Column) -> Column:
        return F.reduce(F.zip_with(one, other, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)

    weight = F.transform("columns", lambda column: dot(F.col("weights"), column))
    forecast = F.col("last.actual") + dot(weight, F.col("last.state"))
    return rows.select(*KEYS, "actual", forecast.alias("forecast"))
