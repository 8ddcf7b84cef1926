"""Forecasts of speed for every segment at once."""

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.operators.features import supervised_windows
from roadstream.operators.regression import linear, products, solve, weight_table
from roadstream.operators.series import Series, SeriesPlan, plan_series, windowed
from roadstream.operators.sizes import checkpointed, dimension_join

TEST, TRAIN = "split = 'test'", "split = 'train'"
KEYS = ["segment_id", "timestamp"]


def ds_y(df: DataFrame, value: str = "speed_kmh") -> DataFrame:
    """A series as (segment_id, ds, y)."""
    return df.select("segment_id", F.col("timestamp").alias("ds"), F.col(value).alias("y"))


def split_history(
    df: DataFrame, lags: int = 1, value: str = "speed_kmh", plan: SeriesPlan | None = None
) -> DataFrame:
    """Actual value, its previous values, position in the series and split."""

    def build(d: DataFrame, s: Series) -> DataFrame:
        lagged = {f"lag_{k}": F.lag(value, k).over(s.window) for k in range(1, lags + 1)}
        cut = F.floor(s.length * p.SERIES_TRAIN_SHARE)
        split = F.when(s.position < cut, "train").otherwise("test")
        return d.withColumns({**lagged, "position": s.position, "split": split})

    plan = plan or plan_series(df)
    narrow = plan.narrow(df, value)
    built = windowed(narrow, build, lookback=lags, plan=plan)
    return built.drop(*(set(plan.ties) - {value})).withColumnRenamed(value, "actual")


def seasonal_naive(history: DataFrame) -> DataFrame:
    """Forecast of a test row: the reading before it."""
    return history.filter(TEST).select(*KEYS, "actual", F.col("lag_1").alias("forecast"))


def _slot(df: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    return df.withColumns({"day_of_week": F.weekday(ts), "hour": F.hour(ts)})


def with_profile(
    test: DataFrame, train: DataFrame, plan: SeriesPlan | None = None
) -> DataFrame:
    """Add ``profile``: the segment's training mean for the weekday and hour.

    A slot without training rows takes the segment's mean over all slots.
    """
    slots = (
        _slot(train)
        .groupBy("segment_id", "day_of_week", "hour")
        .agg(F.sum("actual").alias("s"), F.count("actual").alias("n"))
    )
    overall = slots.groupBy("segment_id").agg(
        F.try_divide(F.sum("s"), F.sum("n")).alias("overall")
    )
    keys = ["segment_id", "day_of_week", "hour"]
    by_slot = slots.select(*keys, F.try_divide("s", "n").alias("slot_mean"))
    segments = plan.segments_at_most if plan else None
    slots_at_most = min(plan.rows, plan.segments_at_most * 7 * 24) if plan else None
    joined = dimension_join(_slot(test), by_slot, keys, "left", slots_at_most)
    joined = dimension_join(joined, overall, "segment_id", "left", segments)
    return joined.withColumn("profile", F.coalesce("slot_mean", "overall")).drop(
        "slot_mean", "overall", "day_of_week", "hour"
    )


def seasonal_profile(history: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """Forecast of a test row: the training mean of its weekday and hour."""
    return with_profile(history.filter(TEST), history.filter(TRAIN), plan).select(
        *KEYS, "actual", F.col("profile").alias("forecast")
    )


def ar1_coefficients(history: DataFrame) -> DataFrame:
    """Slope and intercept of each segment's value on the one before it."""
    slope, intercept = F.regr_slope("actual", "lag_1"), F.regr_intercept("actual", "lag_1")
    usable = slope.isNotNull() & ~F.isnan(slope)
    return (
        history.filter(TRAIN)
        .groupBy("segment_id")
        .agg(
            F.when(usable, slope).otherwise(0.0).alias("slope"),
            F.when(usable, intercept).otherwise(F.avg("actual")).alias("intercept"),
        )
    )


def with_ar1(
    test: DataFrame, history: DataFrame, plan: SeriesPlan | None = None
) -> DataFrame:
    """Add ``ar1``: the value that the segment's own line gives for the one before.

    A segment whose line is not defined takes its training mean.
    """
    lines = ar1_coefficients(history)
    segments = plan.segments_at_most if plan else None
    slope, intercept = F.col("slope"), F.col("intercept")
    line = F.when(slope == 0, intercept).otherwise(intercept + slope * F.col("lag_1"))
    return dimension_join(test, lines, "segment_id", "left", segments).withColumn("ar1", line)


def ar1_per_segment(history: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """One-step forecast of test rows by the segment's own line."""
    return with_ar1(history.filter(TEST), history, plan).select(
        *KEYS, "actual", F.col("ar1").alias("forecast")
    )


def ar1_lines(history: DataFrame) -> DataFrame:
    """Each segment's line with its last known training value and that value's position."""
    known = history.filter(TRAIN).filter(F.col("actual").isNotNull())
    last = known.groupBy("segment_id").agg(
        F.max("position").alias("last_position"), F.max_by("actual", "position").alias("last")
    )
    return ar1_coefficients(history).join(last, "segment_id")


def ar1_ahead(steps: Column) -> Column:
    """Value of the line of ``ar1_lines`` so many steps after its last value.

    The steps of a line have a closed form: the distance to its fixed point shrinks by
    the slope at each; with slope 1 each adds the intercept.
    """
    slope, intercept, last = F.col("slope"), F.col("intercept"), F.col("last")
    fixed = intercept / F.when(slope != 1, 1 - slope)
    return F.when(slope == 1, last + steps * intercept).otherwise(
        fixed + F.pow(slope, steps.cast("double")) * (last - fixed)
    )


def ar1_span(history: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """Forecast of every test row from the end of training alone."""
    segments = plan.segments_at_most if plan else None
    test = history.filter(TEST)
    joined = dimension_join(test, ar1_lines(history), "segment_id", rows_at_most=segments)
    value = ar1_ahead(F.col("position") - F.col("last_position"))
    return joined.select(*KEYS, "actual", value.alias("forecast"))


def ar1_future(
    df: DataFrame, history: DataFrame, steps: int = p.HORIZON, plan: SeriesPlan | None = None
) -> DataFrame:
    """Forecast of the times of ``future_frame``, from the last known reading on."""
    known = df.filter(F.col("speed_kmh").isNotNull())
    last = known.groupBy("segment_id").agg(F.max_by("speed_kmh", "timestamp").alias("last"))
    lines = ar1_coefficients(history).join(last, "segment_id")
    times = Window.partitionBy("segment_id").orderBy("timestamp")
    ahead = future_frame(df, steps).withColumn("step", F.row_number().over(times))
    segments = plan.segments_at_most if plan else None
    joined = dimension_join(ahead, lines, "segment_id", rows_at_most=segments)
    return joined.select(*KEYS, "step", ar1_ahead(F.col("step")).alias("forecast"))


def baseline_forecasts(history: DataFrame, plan: SeriesPlan | None = None) -> DataFrame:
    """Naive, profile and AR(1) forecasts of the test rows, as (kind, model, ..., forecast).

    ``one_step`` models see the reading before each test row, ``span`` models only the
    training rows.
    """
    segments = plan.segments_at_most if plan else None
    test = with_profile(history.filter(TEST), history.filter(TRAIN), plan)
    joined = dimension_join(test, ar1_lines(history), "segment_id", "left", segments)
    slope, intercept = F.col("slope"), F.col("intercept")
    line = F.when(slope == 0, intercept).otherwise(intercept + slope * F.col("lag_1"))
    models = ["seasonal_naive", "seasonal_profile", "ar1", "ar1_span"]
    long = joined.select(
        *KEYS,
        "actual",
        F.col("lag_1").alias("seasonal_naive"),
        F.col("profile").alias("seasonal_profile"),
        line.alias("ar1"),
        ar1_ahead(F.col("position") - F.col("last_position")).alias("ar1_span"),
    ).unpivot([*KEYS, "actual"], models, "model", "forecast")
    span = F.col("model").isin("seasonal_profile", "ar1_span")
    return long.withColumn("kind", F.when(span, "span").otherwise("one_step"))


def future_frame(df: DataFrame, steps: int = p.HORIZON, minutes: int = 15) -> DataFrame:
    """The next ``steps`` grid times after the last reading of each segment."""
    last = df.groupBy("segment_id").agg(F.max("timestamp").alias("last"))
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    times = F.sequence(F.col("last") + step, F.col("last") + step * steps, step)
    return last.select("segment_id", F.explode(times).alias("timestamp"))


def _regression(train: DataFrame, features: list[str], label: str):
    """Least squares over all rows: one aggregation pass of the feature products."""
    assembler = VectorAssembler(inputCols=features, outputCol="features", handleInvalid="skip")
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal")
    return assembler, model.fit(assembler.transform(train.filter(F.col(label).isNotNull())))


def ar_diff(
    df: DataFrame,
    order: int = 5,
    plan: SeriesPlan | None = None,
    fitted: dict[str, PipelineModel | DataFrame] | None = None,
) -> DataFrame:
    """One-step forecast from the last ``order`` differences, one model for all.

    The model is put into ``fitted``, by name.
    """
    history = split_history(df, order + 1, plan=plan)
    steps = [F.col(f"lag_{k}") - F.col(f"lag_{k + 1}") for k in range(1, order + 1)]
    names = [f"step_{k}" for k in range(1, order + 1)]
    rows = history.withColumns(
        {**dict(zip(names, steps)), "change": F.col("actual") - F.col("lag_1")}
    )
    rows = checkpointed(rows)  # read by the fit and by the forecast
    assembler, model = _regression(rows.filter(TRAIN), names, "change")
    if fitted is not None:
        fitted["ar_diff"] = PipelineModel([assembler, model])
    predicted = model.transform(assembler.transform(rows.filter(TEST)))
    return predicted.select(
        *KEYS, "actual", (F.col("lag_1") + F.col("prediction")).alias("forecast")
    )


def fourier_terms(ts: Column, orders: dict[int, int]) -> dict[str, Column]:
    """sin and cos of each period (in hours) up to the given order, from the clock."""
    hours = F.weekday(ts) * 24 + F.hour(ts) + F.minute(ts) / 60
    return {
        f"{name}_{period}_{k}": f(2 * F.pi() * k * hours / period)
        for period, order in orders.items()
        for k in range(1, order + 1)
        for name, f in (("sin", F.sin), ("cos", F.cos))
    }


def fourier_seasonal(
    df: DataFrame,
    orders: dict[int, int] | None = None,
    plan: SeriesPlan | None = None,
    fitted: dict[str, PipelineModel | DataFrame] | None = None,
) -> DataFrame:
    """Multiplicative trend, daily and weekly seasonality, with a level per segment.

    The regression is on the log of the speed. The level of each segment is taken
    out by its training means, which gives the same coefficients as one indicator
    per segment at any number of segments. The model and the means are put into
    ``fitted``, by name.
    """
    orders = orders or {24: 4, 168: 3}
    plan = plan or plan_series(df)
    history = split_history(df, plan=plan)
    ts = F.col("timestamp")
    terms = {"trend": F.unix_date(ts.cast("date")) + F.hour(ts) / 24, **fourier_terms(ts, orders)}
    names = list(terms)
    known = F.when(F.col("actual") > 0, F.ln("actual"))
    rows = checkpointed(history.withColumns({**terms, "log_actual": known}))
    means = (
        rows.filter(TRAIN)
        .filter(F.col("log_actual").isNotNull())
        .groupBy("segment_id")
        .agg(*[F.avg(c).alias(f"mean_{c}") for c in [*names, "log_actual"]])
    )
    centred = dimension_join(rows, means, "segment_id", rows_at_most=plan.segments_at_most).withColumns(
        {c: F.col(c) - F.col(f"mean_{c}") for c in [*names, "log_actual"]}
    )
    assembler, model = _regression(centred.filter(TRAIN), names, "log_actual")
    if fitted is not None:
        fitted |= {"fourier": PipelineModel([assembler, model]), "fourier_means": means}
    predicted = model.transform(assembler.transform(centred.filter(TEST)))
    forecast = F.exp(F.col("mean_log_actual") + F.col("prediction"))
    return predicted.select(*KEYS, "actual", forecast.alias("forecast"))


def _complete_windows(df: DataFrame, plan: SeriesPlan | None, **sizes) -> DataFrame:
    """Windows whose previous values are all known."""
    windows = supervised_windows(df, plan=plan, **sizes)
    return windows.filter("NOT exists(x, v -> v IS NULL)")


def _by_step(rows: DataFrame, horizon: int) -> DataFrame:
    """One row per step of columns y_0 and forecast_0 and so on."""
    pairs = F.array(
        *[
            F.struct(
                F.lit(h + 1).alias("step"),
                F.col(f"y_{h}").alias("actual"),
                F.col(f"forecast_{h}").alias("forecast"),
            )
            for h in range(horizon)
        ]
    )
    return rows.select(*KEYS, F.inline(pairs))


def direct_multi_horizon(
    df: DataFrame,
    lookback: int = p.LOOKBACK,
    horizon: int = p.HORIZON,
    plan: SeriesPlan | None = None,
    fitted: dict[str, PipelineModel | DataFrame] | None = None,
) -> DataFrame:
    """Forecast each of the next values by its own regression on the previous ones.

    All regressions come from one aggregate, as they share their inputs and rows: those
    with all next values known. The weights are put into ``fitted``, by name.
    """
    windows = _complete_windows(df, plan, lookback=lookback, horizon=horizon)
    before = {f"x_{k}": F.get("x", F.lit(k)) for k in range(lookback)}
    after = {f"y_{h}": F.get("y", F.lit(h)) for h in range(horizon)}
    flat = windows.select(
        *KEYS, "split", *[c.alias(name) for name, c in (before | after).items()]
    )
    rows = checkpointed(flat)  # read by the fit and by the forecasts
    sums = products(rows.filter(TRAIN), [*before, *after])
    weights = solve(sums, [0.0] * (lookback + 1))[0]
    if fitted is not None:
        names = [f"{x}_to_{y}" for y in after for x in ("constant", *before)]
        values = weights.T.ravel().tolist()
        fitted["direct_weights"] = weight_table(df.sparkSession, names, values)
    columns = [F.lit(1.0), *[F.col(name) for name in before]]
    forecasts = {
        f"forecast_{h}": linear(weights[:, h].tolist(), columns) for h in range(horizon)
    }
    return _by_step(rows.filter(TEST).withColumns(forecasts), horizon)


def boosted_multi_horizon(
    df: DataFrame,
    lookback: int = p.LOOKBACK,
    horizon: int = p.HORIZON,
    rounds: int = 100,
    depth: int = 5,
    rate: float = 0.1,
    validation_share: float = 0.125,
    tolerance: float = 0.01,
    plan: SeriesPlan | None = None,
    fitted: dict[str, PipelineModel | DataFrame] | None = None,
) -> DataFrame:
    """Forecast each of the next values by its own boosted trees on the previous ones.

    The last ``validation_share`` of each series' training windows is not learned from;
    boosting stops when their error falls by less than ``tolerance`` of it. The models
    are put into ``fitted``, by name and step.
    """
    windows = _complete_windows(
        df, plan, lookback=lookback, horizon=horizon, validation_share=validation_share
    )
    after = {f"y_{h}": F.get("y", F.lit(h)) for h in range(horizon)}
    rows = checkpointed(
        windows.withColumns(
            {**after, "features": array_to_vector("x"), "stop": F.col("split") == "val"}
        ).drop("x", "y")
    )
    predicted = rows.filter(TEST)
    for h in range(horizon):
        trees = GBTRegressor(
            labelCol=f"y_{h}",
            predictionCol=f"forecast_{h}",
            maxIter=rounds,
            maxDepth=depth,
            stepSize=rate,
            validationIndicatorCol="stop",
            validationTol=tolerance,
            seed=p.SEED,
        )
        known = rows.filter(F.col("split") != "test").filter(F.col(f"y_{h}").isNotNull())
        model = trees.fit(known)
        predicted = model.transform(predicted)
        if fitted is not None:
            fitted[f"boosted_{h + 1}"] = PipelineModel([model])
    return _by_step(predicted, horizon)
