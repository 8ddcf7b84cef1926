"""Labels, calendar features and time-series features of readings."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import traffic
from roadstream.operators.series import Series, SeriesPlan, plan_series, running, windowed
from roadstream.operators.sizes import dimension_join

MEASURES = {
    "speed": "speed_kmh",
    "volume": "volume_vehicles",
    "density": "density_vehicles_per_km",
}


def with_labels(df: DataFrame, thresholds=p.THRESHOLDS) -> DataFrame:
    """speed_ratio, congestion_level and congestion_code from speed and limit."""
    ratio = traffic.speed_ratio(traffic.nan_to_null(F.col("speed_kmh")), F.col("speed_limit"))
    return (
        df.withColumn("speed_ratio", ratio)
        .withColumn("congestion_level", traffic.congestion_level(F.col("speed_ratio"), thresholds))
        .withColumn("congestion_code", traffic.congestion_code(F.col("congestion_level")))
    )


def add_congestion_labels(
    readings: DataFrame, roads: DataFrame, roads_at_most: int | None = None
) -> DataFrame:
    """Join the speed limit of the segment and label each reading.

    A reading on an unknown segment keeps a null limit and counts as Severe.
    """
    limits = roads.select("segment_id", "speed_limit", "road_type")
    return with_labels(dimension_join(readings, limits, "segment_id", "left", roads_at_most))


def add_calendar(df: DataFrame) -> DataFrame:
    """Calendar parts, their cyclical encoding and 0/1 flags."""
    ts = F.col("timestamp")
    parts = df.withColumns(
        {
            "year": F.year(ts),
            "month": F.month(ts),
            "day": F.day(ts),
            "hour": F.hour(ts),
            "minute": F.minute(ts),
            "day_of_week": F.weekday(ts),
            "day_of_year": F.dayofyear(ts),
            "week_of_year": F.weekofyear(ts),
        }
    )
    hour_sin, hour_cos = traffic.cyclical(F.col("hour"), 24)
    dow_sin, dow_cos = traffic.cyclical(F.col("day_of_week"), 7)
    return parts.withColumns(
        {
            "hour_sin": hour_sin,
            "hour_cos": hour_cos,
            "dow_sin": dow_sin,
            "dow_cos": dow_cos,
            "is_weekend": F.col("day_of_week").isin(5, 6).cast("int"),
            "is_rush_hour": F.col("is_rush_hour").cast("int"),
        }
    )


def lag_columns(series: Series, lags=p.LAGS) -> dict[str, Column]:
    return {
        f"{name}_lag_{k}": F.lag(F.col(column).cast("double"), k).over(series.window)
        for k in lags
        for name, column in MEASURES.items()
    }


def rolling_columns(series: Series, windows=p.ROLLING, shift: int = 0) -> dict[str, Column]:
    """Statistics of the last n rows; ``shift=1`` leaves out the current row."""
    out = {}
    for n in windows:
        frame = series.window.rowsBetween(-(n - 1) - shift, -shift)
        out[f"speed_rolling_mean_{n}"] = F.avg("speed_kmh").over(frame)
        out[f"speed_rolling_std_{n}"] = F.stddev_samp("speed_kmh").over(frame)
        out[f"volume_rolling_max_{n}"] = F.max(F.col("volume_vehicles").cast("double")).over(frame)
    return out


def add_lags(df: DataFrame, lags=p.LAGS, plan: SeriesPlan | None = None) -> DataFrame:
    """Values of the k-th reading before this one on the same segment."""
    return windowed(
        df, lambda d, s: d.withColumns(lag_columns(s, lags)), lookback=max(lags), plan=plan
    )


def add_rolling(
    df: DataFrame, windows=p.ROLLING, shift: int = 0, plan: SeriesPlan | None = None
) -> DataFrame:
    """Mean and deviation of speed and maximum of volume over the last n readings."""
    return windowed(
        df,
        lambda d, s: d.withColumns(rolling_columns(s, windows, shift)),
        lookback=max(windows) - 1 + shift,
        plan=plan,
    )


def add_series_features(
    df: DataFrame,
    lags=p.LAGS,
    windows=p.ROLLING,
    shift: int = 0,
    plan: SeriesPlan | None = None,
    keep_blocks: bool = False,
) -> DataFrame:
    """Lags and rolling statistics together: one shuffle and one sort for both."""
    return windowed(
        df,
        lambda d, s: d.withColumns(
            {**lag_columns(s, lags), **rolling_columns(s, windows, shift)}
        ),
        lookback=max(max(lags), max(windows) - 1 + shift),
        plan=plan,
        keep_blocks=keep_blocks,
    )


def series_feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if "lag_" in c or "rolling_" in c]


def forward_fill(
    df: DataFrame, columns: list[str] | None = None, plan: SeriesPlan | None = None
) -> DataFrame:
    """Replace a null by the segment's last known value before it."""
    names = series_feature_names(df) if columns is None else columns

    def last_known(window, suffix: str = "") -> dict[str, Column]:
        return {f"{c}{suffix}": F.last(c, ignorenulls=True).over(window) for c in names}

    if not names:
        return df
    plan = plan or plan_series(df)
    return running(
        df,
        within=lambda d, w: d.withColumns(last_known(w)),
        summarise={
            c: F.max_by(c, F.when(F.col(c).isNotNull(), plan.moment)) for c in names
        },
        combine=lambda d, w: d.withColumns(last_known(w, "_before")),
        carried=[f"{c}_before" for c in names],
        finish=lambda d: d.withColumns({c: F.coalesce(c, f"{c}_before") for c in names}),
        plan=plan,
    )


def supervised_windows(
    df: DataFrame,
    lookback: int = p.LOOKBACK,
    horizon: int = p.HORIZON,
    value: str = "speed_kmh",
    plan: SeriesPlan | None = None,
    validation_share: float = 0.0,
) -> DataFrame:
    """(x, y) arrays: the previous ``lookback`` values, the next ``horizon`` values.

    A series of n rows gives max(0, n - lookback - horizon) windows. The first
    ``SERIES_TRAIN_SHARE`` of them are for training, of these the last
    ``validation_share`` for validation.
    """

    def build(d: DataFrame, s: Series) -> DataFrame:
        # Wrapped, so that a null value keeps its place in the array.
        item = F.struct(F.col(value).alias("v"))
        return d.withColumns(
            {
                "x": F.collect_list(item).over(s.window.rowsBetween(-lookback, -1))["v"],
                "y": F.collect_list(item).over(s.window.rowsBetween(0, horizon - 1))["v"],
                "_position": s.position,
                "_windows": s.length - lookback - horizon,
            }
        )

    index = F.col("_position") - lookback
    learned = F.col("_windows") * p.SERIES_TRAIN_SHARE
    plan = plan or plan_series(df)
    split = F.when(index < F.floor(learned * (1 - validation_share)), "train").when(
        index < F.floor(learned), "val"
    )
    return (
        windowed(
            plan.narrow(df, value),
            build,
            lookback=lookback,
            lookahead=horizon - 1,
            plan=plan,
        )
        .filter((index >= 0) & (index < F.col("_windows")))
        .select("segment_id", "timestamp", "x", "y", split.otherwise("test").alias("split"))
    )


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c not in p.NOT_FEATURES]


def prepare_features_target(df: DataFrame, task: str = "classification") -> DataFrame:
    """Keys, the features in table order, and the target as ``label``."""
    target = "congestion_code" if task == "classification" else "speed_kmh"
    return df.select(
        "segment_id", "timestamp", *feature_names(df), F.col(target).alias("label")
    )


def encode_road_type(df: DataFrame) -> DataFrame:
    """Replace the road type by its number and one 0/1 column per type."""
    number = F
    for i, name in enumerate(p.ROAD_TYPES):
        number = number.when(F.col("road_type") == name, i)
    flags = {
        f"is_{name}": F.coalesce((F.col("road_type") == name).cast("int"), F.lit(0))
        for name in p.ROAD_TYPES
    }
    return df.withColumns({"road_type_code": number.cast("int"), **flags}).drop("road_type")


def what_if_incident(df: DataFrame, affected: Column) -> DataFrame:
    """The same readings with an accident on the affected rows, labelled again."""
    speed = F.when(affected, F.col("speed_kmh") * p.ACCIDENT_SPEED).otherwise(F.col("speed_kmh"))
    volume = F.when(affected, F.col("volume_vehicles") * p.ACCIDENT_VOLUME).otherwise(
        F.col("volume_vehicles").cast("double")
    )
    return with_labels(
        df.withColumns({"speed_kmh": speed, "volume_vehicles": volume.cast("int")})
    )
