"""Trend with changepoints and seasonality, under a prior scale for each."""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream.functions.clock import clock_micros
from roadstream.operators.forecast import KEYS, TEST, TRAIN, fourier_terms, split_history
from roadstream.operators.regression import linear, products, solve, weight_table
from roadstream.operators.series import SeriesPlan, plan_series
from roadstream.operators.sizes import checkpointed, dimension_join

LEVEL_SCALE = 5.0  # of the first slope


def hinge_terms(share: Column, changepoints: int, reach: float) -> dict[str, Column]:
    """Share of the training span passed, and passed since each of the changepoints, which
    lie evenly in its first ``reach``."""
    cuts = [reach * (k + 1) / (changepoints + 1) for k in range(changepoints)]
    hinges = {f"hinge_{k}": F.greatest(share - cut, F.lit(0.0)) for k, cut in enumerate(cuts)}
    return {"slope": share, **hinges}


def prior_penalties(sums: np.ndarray, scales: list[float]) -> list[float]:
    """Penalty of each coefficient: the noise variance of the plain fit over the square of
    its prior scale. ``sums`` start with the row count and end with the target."""
    inner = sums[1:, 1:]
    rest = float(solve(inner)[1][0])
    freedom = max(1.0, sums[0, 0] - len(scales))
    return [max(rest, 0.0) / freedom / scale**2 for scale in scales]


def trend_seasonal(
    df: DataFrame,
    orders: dict[int, int] | None = None,
    changepoints: int = 10,
    reach: float = 0.8,
    trend_scale: float = 0.05,
    season_scale: float = 10.0,
    plan: SeriesPlan | None = None,
    fitted: dict | None = None,
) -> DataFrame:
    """Forecast of every test row from the training rows alone.

    The log of the speed follows a piecewise linear trend and daily and weekly terms,
    common to all segments, around a level of each segment. Changes of slope and seasonal
    terms are shrunk by their prior scales: a ridge regression with a penalty for each
    block, solved from one matrix of products of fixed size. The weights are put into
    ``fitted``, by name.
    """
    orders = orders or {24: 4, 168: 3}
    plan = plan or plan_series(df)
    history = split_history(df, plan=plan)
    seconds = clock_micros(history, "timestamp") / 1_000_000
    first, last = history.filter(TRAIN).agg(F.min(seconds), F.max(seconds)).first()
    first = first or 0.0
    span = (last or 0.0) - first or 1.0
    trend = hinge_terms((seconds - F.lit(first)) / F.lit(span), changepoints, reach)
    terms = {**trend, **fourier_terms(F.col("timestamp"), orders)}
    names = [*terms, "log_actual"]
    known = F.when(F.col("actual") > 0, F.ln("actual"))
    narrow = history.select(*KEYS, "actual", "split", known.alias("log_actual"))
    rows = checkpointed(narrow.withColumns(terms))
    means = (
        rows.filter(TRAIN)
        .filter(F.col("log_actual").isNotNull())
        .groupBy("segment_id")
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in names])
    )
    centred = dimension_join(rows, means, "segment_id", rows_at_most=plan.segments_at_most)
    centred = centred.withColumns({c: F.col(c) - F.col(f"mean_{c}") for c in names})
    sums = products(centred.filter(TRAIN), names)
    scales = [LEVEL_SCALE] + [trend_scale] * changepoints
    scales += [season_scale] * (len(terms) - len(scales))
    weights = solve(sums[1:, 1:], prior_penalties(sums, scales))[0][:, 0].tolist()
    if fitted is not None:
        fitted["trend_weights"] = weight_table(df.sparkSession, terms, weights)
        fitted["trend_means"] = means
    value = F.exp(F.col("mean_log_actual") + linear(weights, [F.col(c) for c in terms]))
    return centred.filter(TEST).select(*KEYS, "actual", value.alias("forecast"))
