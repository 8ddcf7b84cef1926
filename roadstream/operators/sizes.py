"""Size checks, and joins that choose their strategy from them."""

import atexit
import shutil
import tempfile
import uuid
import warnings
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# A table of at most this many narrow rows (about 100 MB) may be broadcast, sit
# in one window partition or come to the driver. Larger ones never do.
SMALL_ROWS = 1_000_000


def is_small(df: DataFrame, rows_at_most: int | None = None, limit: int = SMALL_ROWS) -> bool:
    """Whether ``df`` has at most ``limit`` rows; a known bound saves the check."""
    if rows_at_most is not None and rows_at_most <= limit:
        return True
    return df.limit(limit + 1).count() <= limit


def dimension_join(
    fact: DataFrame,
    dimension: DataFrame,
    on: str | list[str],
    how: str = "inner",
    rows_at_most: int | None = None,
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """Many-to-one join of a fact with a table that has one row per key.

    A dimension that passes the size check is broadcast, so the fact stays where
    it is. Beyond that, both sides are shuffled in a sort-merge join, whose skewed
    partitions adaptive execution splits, as no aggregate stands between. Rows with
    a null key match nothing; they stay out of the shuffle.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"not a many-to-one join: {how}")
    if is_small(dimension, rows_at_most, limit):
        return fact.join(F.broadcast(dimension), keys, how)
    known = reduce(and_, [F.col(k).isNotNull() for k in keys])
    joined = fact.filter(known).join(dimension.hint("shuffle_merge"), keys, how)
    if how in ("inner", "left_semi"):
        return joined
    return joined.unionByName(fact.filter(~known), allowMissingColumns=True)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the session names; outside local mode it must be set.

    In local mode a new temporary folder stands in, which goes when the process ends.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="roadstream-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        warnings.warn(f"spark.checkpoint.dir is not set; tables go to {folder}", stacklevel=2)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def run_folder(spark: SparkSession) -> str:
    """A new folder for one run, below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark)}/run-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, for steps that read it repeatedly.

    As Parquet, so that each step reads only the columns it needs.
    """
    spark = df.sparkSession
    folder = f"{run_folder(spark)}/table"
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def prefix_sum(
    df: DataFrame,
    by: list[str],
    order: list[str],
    value: str,
    output: str,
    rows_at_most: int | None = None,
    limit: int = SMALL_ROWS,
) -> DataFrame:
    """Sum of ``value`` over the rows before this one, per ``by``, in ``order``.

    ``order`` is unique within ``by``. A table known to be small takes one window.
    Any other is written once and counted. A large one is range-partitioned by the order and written, so that the part number of
    a row is stored data; each part adds its own running sum to the total of the
    parts before it. No task then holds more than one part.
    """
    ahead = (Window.unboundedPreceding, -1)

    def before(keys: list[str], ordering: list[str], column: str):
        window = Window.partitionBy(*keys).orderBy(*ordering).rowsBetween(*ahead)
        return F.coalesce(F.sum(column).over(window), F.lit(0))

    if rows_at_most is not None and rows_at_most <= limit:
        return df.withColumn(output, before(by, order, value))
    stored = checkpointed(df)
    rows = stored.count()
    if rows <= limit:
        return stored.withColumn(output, before(by, order, value))
    parts = max(2, -(-rows // limit))
    placed = checkpointed(
        stored.repartitionByRange(parts, *by, *order).withColumn(
            "_part", F.spark_partition_id()
        )
    )
    totals = placed.groupBy(*by, "_part").agg(F.sum(value).alias("_sum"))
    ahead_of_part = before(by, ["_part"], "_sum").alias("_ahead")
    # A group's neighbours share its part, so there are at most groups + parts rows.
    return (
        dimension_join(
            placed, totals.select(*by, "_part", ahead_of_part), by + ["_part"], limit=limit
        )
        .withColumn("_within", before(by + ["_part"], order, value))
        .select(*df.columns, (F.col("_ahead") + F.col("_within")).alias(output))
    )
