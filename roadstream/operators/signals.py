"""Signals, and the choice of their green times."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import signal as timing
from roadstream.operators.joins import signal_metrics
from roadstream.operators.sizes import prefix_sum


def signal_segments(roads: DataFrame) -> DataFrame:
    return roads.filter("has_traffic_signal")


def build_signals(
    roads: DataFrame, count: int | None = p.SIGNAL_COUNT, roads_at_most: int | None = None
) -> DataFrame:
    """Signalised segments, numbered by segment, with the standard timing.

    ``count`` takes only the first ones; None takes all.
    """
    chosen = signal_segments(roads)
    if count is not None:
        # The limit is a distributed top-n; only its rows reach the one window partition.
        chosen, roads_at_most = chosen.orderBy("segment_id").limit(count), count
    numbered = prefix_sum(
        chosen.withColumn("_one", F.lit(1)), [], ["segment_id"], "_one", "_number", roads_at_most
    )
    return numbered.select(
        F.format_string("SIG_%03d", "_number").alias("signal_id"),
        "segment_id",
        "latitude",
        "longitude",
        F.lit(p.CYCLE).alias("cycle_length"),
        F.lit(p.GREEN).alias("green_time_ns"),
        F.lit(p.GREEN).alias("green_time_ew"),
        F.lit(p.YELLOW).alias("yellow_time"),
        F.lit(p.ALL_RED).alias("all_red_time"),
    )


def best_timing(
    df: DataFrame,
    low: int = p.MIN_GREEN,
    high: int = p.MAX_GREEN,
    step: int | None = None,
    weights=p.WEIGHTS,
) -> DataFrame:
    """Add the plan (objective, green_ns, green_ew) with the least objective.

    The objective is linear in each green time, so its least value over the box
    is at a corner and four candidates suffice. ``step`` scores a grid instead,
    for objectives that are not linear. The candidates are compared inside the
    row: no join and no shuffle.
    """
    values = [low, high] if step is None else [*range(low, high, step), high]
    pairs = F.array(
        *[
            F.struct(F.lit(ns).alias("green_ns"), F.lit(ew).alias("green_ew"))
            for ns in values
            for ew in values
        ]
    )

    def scored(pair: Column) -> Column:
        objective = timing.timing_objective(
            pair["green_ns"], pair["green_ew"], F.col("volume_ns"), F.col("volume_ew"), weights
        )
        return F.struct(
            objective.alias("objective_value"),
            pair["green_ns"].alias("green_ns"),
            pair["green_ew"].alias("green_ew"),
        )

    return df.withColumn("best", F.array_min(F.transform(pairs, scored)))


def search_timing(
    df: DataFrame,
    objective: Callable[[Column, Column, Column, Column], Column] = timing.delay_objective,
    low: int = p.MIN_GREEN,
    high: int = p.MAX_GREEN,
    spacings: tuple[int, ...] = (20, 5, 1),
    reach: int = 5,
) -> DataFrame:
    """Add the plan (objective, green_ns, green_ew) found by a search from coarse to fine.

    Each level scores a square of ``2 * reach + 1`` steps a side around the best plan of
    the level before, inside the box, so a row scores a bounded number of candidates:
    363 where a one-second grid has 10,201. Levels overlap, and for a convex objective of
    a moderate slant the result is the best of that grid. Ties go to the smaller times.
    """
    ahead = range(-reach, reach + 1)
    moves = F.array(
        *[F.struct(F.lit(x).alias("ns"), F.lit(y).alias("ew")) for x in ahead for y in ahead]
    )
    volumes = F.col("volume_ns"), F.col("volume_ew")

    def inside(green: Column) -> Column:
        return F.greatest(F.lit(low), F.least(F.lit(high), green))

    def plan(green_ns: Column, green_ew: Column) -> Column:
        return F.struct(
            objective(green_ns, green_ew, *volumes).alias("objective_value"),
            green_ns.alias("green_ns"),
            green_ew.alias("green_ew"),
        )

    def level(best: Column, spacing: Column) -> Column:
        near = lambda move: plan(
            inside(best["green_ns"] + move["ns"] * spacing),
            inside(best["green_ew"] + move["ew"] * spacing),
        )
        return F.array_min(F.transform(moves, near))

    middle = F.lit((low + high) // 2)
    steps = F.array(*[F.lit(s) for s in spacings])
    return df.withColumn("best", F.reduce(steps, plan(middle, middle), level))


def with_volumes(metrics: DataFrame, scale: float = 1.0) -> DataFrame:
    """Directional volumes from the mean peak volume."""
    return metrics.withColumn("volume_ns", F.col("avg_volume") * scale).withColumn(
        "volume_ew", F.col("volume_ns") * p.EAST_WEST_SHARE
    )


def proportional_timing(df: DataFrame) -> DataFrame:
    """Green times in proportion to the directional volumes."""
    total = F.col("volume_ns") + F.col("volume_ew")
    green_ns = timing.proportional_green(F.col("volume_ns"), total)
    green_ew = timing.proportional_green(F.col("volume_ew"), total)
    return df.withColumns(
        {
            "green_ns": green_ns,
            "green_ew": green_ew,
            "cycle_length": timing.cycle_length(green_ns, green_ew),
        }
    )


def optimize_signals(
    signals: DataFrame,
    labelled: DataFrame,
    scale: float = 1.0,
    signals_at_most: int | None = None,
) -> DataFrame:
    """Signals with data: old timing as ``*_original``, new timing, objective, volumes."""
    metrics = with_volumes(signal_metrics(signals, labelled, signals_at_most), scale)
    best = F.col("best")
    return best_timing(metrics).select(
        "signal_id",
        "segment_id",
        "latitude",
        "longitude",
        timing.cycle_length(
            best["green_ns"], best["green_ew"], F.col("yellow_time"), F.col("all_red_time")
        ).alias("cycle_length"),
        best["green_ns"].alias("green_time_ns"),
        best["green_ew"].alias("green_time_ew"),
        "yellow_time",
        "all_red_time",
        F.col("green_time_ns").alias("green_time_ns_original"),
        F.col("green_time_ew").alias("green_time_ew_original"),
        F.col("cycle_length").alias("cycle_length_original"),
        best["objective_value"].alias("objective_value"),
        F.col("volume_ns").alias("traffic_volume_ns"),
        F.col("volume_ew").alias("traffic_volume_ew"),
    )


def signal_changes(optimized: DataFrame) -> DataFrame:
    """Old and new timing side by side."""
    return optimized.select(
        "signal_id",
        F.col("green_time_ns_original").alias("ns_original"),
        F.col("green_time_ns").alias("ns_optimized"),
        F.col("green_time_ew_original").alias("ew_original"),
        F.col("green_time_ew").alias("ew_optimized"),
        F.col("cycle_length_original").alias("cycle_original"),
        F.col("cycle_length").alias("cycle_optimized"),
    )


def first_n(changes: DataFrame, n: int = 10) -> DataFrame:
    return changes.orderBy("signal_id").limit(n)


def timing_change(optimized: DataFrame) -> DataFrame:
    """Mean change of the green time in each direction."""
    return optimized.agg(
        (F.avg("green_time_ns") - F.avg("green_time_ns_original")).alias("change_ns"),
        (F.avg("green_time_ew") - F.avg("green_time_ew_original")).alias("change_ew"),
    )
