"""Standard scores with statistics of the training rows only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def scaler_statistics(df: DataFrame, columns: list[str]) -> DataFrame:
    """(feature, mean, std) over the rows whose split is train, in one pass."""
    train = df.filter(F.col("split") == "train")
    one_row = train.agg(
        *[F.avg(c).alias(f"mean_{c}") for c in columns],
        *[F.stddev_pop(c).alias(f"std_{c}") for c in columns],
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c).alias("feature"),
                F.col(f"mean_{c}").alias("mean"),
                F.col(f"std_{c}").alias("std"),
            )
            for c in columns
        ]
    )
    return one_row.select(F.inline(rows))


def apply_scaler(df: DataFrame, statistics: DataFrame) -> DataFrame:
    """z-scores by saved statistics, one row per feature; a constant feature becomes 0."""
    out = {}
    for feature, mean, std in statistics.select("feature", "mean", "std").collect():
        if mean is not None:
            out[feature] = (F.col(feature) - mean) / (std or 1.0)
    return df.withColumns(out) if out else df


def standard_scale(df: DataFrame, columns: list[str]) -> DataFrame:
    """z-scores for every split, with statistics of the training rows."""
    return apply_scaler(df, scaler_statistics(df, columns))
