"""Train, validation and test rows."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions.clock import clock_micros
from roadstream.functions.hashing import uniforms
from roadstream.operators.series import SeriesPlan, plan_series, windowed
from roadstream.operators.sizes import SMALL_ROWS, dimension_join, prefix_sum


def named_split(position: Column, length: Column, test: float, validation: float) -> Column:
    return (
        F.when(position < F.floor(length * F.lit(1 - test - validation)), "train")
        .when(position < F.floor(length * F.lit(1 - test)), "val")
        .otherwise("test")
    )


def positional_split(
    df: DataFrame,
    test: float = p.TEST_SHARE,
    validation: float = p.VALIDATION_SHARE,
    plan: SeriesPlan | None = None,
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """Cut the rows in (segment, time) order: the test rows are the last segments.

    The position of a row is the number of rows on earlier segments plus its
    position in its own series.
    """
    plan = plan or plan_series(df)
    counts = df.groupBy("segment_id").agg(F.count("*").alias("_n"))
    offsets = prefix_sum(
        counts, [], ["segment_id"], "_n", "_offset", plan.segments_at_most, limit
    ).select("segment_id", "_offset")
    positioned = windowed(df, lambda d, s: d.withColumn("_position", s.position), plan=plan)
    split = named_split(F.col("_offset") + F.col("_position"), F.lit(plan.rows), test, validation)
    return (
        dimension_join(
            positioned, offsets, "segment_id", rows_at_most=plan.segments_at_most, limit=limit
        )
        .withColumn("split", split)
        .drop("_offset", "_position")
    )


def temporal_split(
    df: DataFrame,
    test: float = p.TEST_SHARE,
    validation: float = p.VALIDATION_SHARE,
    plan: SeriesPlan | None = None,
) -> DataFrame:
    """Cut every series by time: the test rows are the last of each segment."""
    return windowed(
        df,
        lambda d, s: d.withColumn("split", named_split(s.position, s.length, test, validation)),
        plan=plan,
    )


def random_split(
    df: DataFrame,
    test: float = p.TEST_SHARE,
    validation: float = p.VALIDATION_SHARE,
    seed: int = p.SEED,
) -> DataFrame:
    """Split by a hash of the row's key: no shuffle, and stable under repartitioning."""
    u = uniforms(F.col("segment_id"), clock_micros(df, "timestamp"), seed=seed, salt="split")[0]
    split = F.when(u < test, "test").when(u < test + validation, "val").otherwise("train")
    return df.withColumn("split", split)


def series_split(
    df: DataFrame, train: float = p.SERIES_TRAIN_SHARE, plan: SeriesPlan | None = None
) -> DataFrame:
    """The first rows of each series are for training, the rest for testing."""
    return windowed(
        df,
        lambda d, s: d.withColumn(
            "split", F.when(s.position < F.floor(s.length * train), "train").otherwise("test")
        ),
        plan=plan,
    )


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(F.count("*").alias("rows"))
