"""Counts and quantiles that merge: one small sketch per day, never read again."""

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LG_REGISTERS = 14
# Standard error of a distinct count from so many registers.
DISTINCT_ERROR = 1.04 / 2 ** (LG_REGISTERS / 2)
QUANTILE_K = 800
# Ranks of quantiles are off by less than this with great likelihood.
RANK_ERROR = 0.01
COLUMNS = ("speed_kmh", "volume_vehicles")


def daily_sketches(readings: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Per day: rows, a sketch of the segments and one of the values of each column.

    Tasks build partial sketches, so nothing but sketches is shuffled. Null segments and
    values are left out; a day without any value has a null sketch.
    """
    values = [
        F.kll_sketch_agg_double(F.col(c).cast("double"), F.lit(QUANTILE_K)).alias(f"values_{c}")
        for c in columns
    ]
    return readings.groupBy(F.to_date("timestamp").alias("day")).agg(
        F.count("*").alias("rows"),
        F.hll_sketch_agg("segment_id", LG_REGISTERS).alias("segments"),
        *values,
    )


def merged(daily: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Sketches of several days as one row per ``by``, from the daily rows alone."""
    names = [c for c in daily.columns if c.startswith("values_")]
    return daily.groupBy(*(by or [])).agg(
        F.sum("rows").alias("rows"),
        F.hll_union_agg("segments").alias("segments"),
        *[F.kll_merge_agg_double(c).alias(c) for c in names],
    )


def distinct_count(sketch: str = "segments") -> Column:
    """Estimated number of different segments."""
    return F.hll_sketch_estimate(sketch)


def quantile(column: str, share: float) -> Column:
    """Estimated quantile of a column's values."""
    return F.kll_sketch_get_quantile_double(f"values_{column}", F.lit(share))


def check_rows(readings: DataFrame, found: DataFrame, columns: tuple[str, ...] = COLUMNS) -> DataFrame:
    """Per day the exact counts, and whether the sketches are within their bounds.

    ``found`` are daily sketches, or merged ones by day. A median is within its bound if
    its rank among the day's values is.
    """
    estimates = found.select(
        "day",
        distinct_count().alias("estimate"),
        *[quantile(c, 0.5).alias(f"median_{c}") for c in columns],
    )
    day = F.to_date("timestamp").alias("day")
    rows = readings.select(day, "segment_id", *columns).join(estimates, "day")
    below = [F.avg((F.col(c) < F.col(f"median_{c}")).cast("double")) for c in columns]
    upto = [F.avg((F.col(c) <= F.col(f"median_{c}")).cast("double")) for c in columns]
    medians = [
        (low <= 0.5 + RANK_ERROR) & (high >= 0.5 - RANK_ERROR) for low, high in zip(below, upto, strict=True)
    ]
    segments = F.count_distinct("segment_id")
    near = F.abs(F.max("estimate") - segments) <= 1 + 4 * DISTINCT_ERROR * segments
    return rows.groupBy("day").agg(
        F.count("*").alias("rows"),
        segments.alias("segments"),
        near.alias("count_in_bound"),
        reduce(and_, medians).alias("medians_in_bound"),
    )
