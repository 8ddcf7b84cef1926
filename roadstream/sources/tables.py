"""Read and write the tables and fitted models."""

import uuid

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.functions.traffic import nan_to_null
from roadstream.params import SEGMENT
from roadstream.schema import SCHEMAS

DAY = "date"  # folder column of tables laid out by day


def _known_values(df: DataFrame) -> DataFrame:
    """NaN becomes null, which every operator treats as missing."""
    floats = [c for c, kind in df.dtypes if kind in ("float", "double")]
    return df.withColumns({c: nan_to_null(F.col(c)) for c in floats}) if floats else df


def load_table(
    spark: SparkSession,
    folder: str,
    name: str,
    file_format: str = "parquet",
    days: tuple[str, str] | None = None,
) -> DataFrame:
    """One table; the raw tables have a declared schema, so nothing is inferred.

    ``days`` (first, last) of a table laid out by day reads only those folders.
    """
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    if file_format == "csv":
        reader = reader.option("header", True)
    table = reader.format(file_format).load(f"{folder}/{name}")
    if days is not None:
        first, last = (F.lit(day).cast("date") for day in days)
        table = table.filter(F.col(DAY).between(first, last))
    return _known_values(table.drop(DAY))


def load_tables(spark: SparkSession, folder: str, names=tuple(SCHEMAS)) -> dict[str, DataFrame]:
    return {name: load_table(spark, folder, name) for name in names}


def save_table(
    df: DataFrame, folder: str, name: str, csv: bool = False, group_bytes: int | None = None
) -> None:
    """Write a table as Parquet, and as CSV with a header if asked.

    A table with a timestamp is laid out by day, so that queries on a time range
    skip the other days. The rebalance keeps files of even size per day and splits
    a day that is much larger than the others. Within a file rows lie by segment and
    time, and each row group has a Bloom filter of its segments, so that a query on one
    segment skips the groups without it. ``group_bytes`` sets the size of a group.
    """
    out = df
    if "timestamp" in df.columns:
        out = df.withColumn(DAY, F.to_date("timestamp")).hint("rebalance", DAY)
        if SEGMENT in df.columns:
            out = out.sortWithinPartitions(DAY, SEGMENT, "timestamp")
        writer = out.write.option(f"parquet.bloom.filter.enabled#{SEGMENT}", "true")
        if group_bytes:
            writer = writer.option("parquet.block.size", str(group_bytes))
        writer.mode("overwrite").partitionBy(DAY).parquet(f"{folder}/{name}")
    else:
        out.write.mode("overwrite").parquet(f"{folder}/{name}")
    if csv:  # from the written table, which is not computed again
        written = df.sparkSession.read.schema(out.schema).parquet(f"{folder}/{name}")
        written.select(df.columns).write.mode("overwrite").option("header", True).csv(
            f"{folder}/{name}_csv"
        )


def series_table(df: DataFrame, folder: str, buckets: int | None = None) -> DataFrame:
    """``df`` written in buckets of whole series, each sorted by segment and time, and read
    back; windows by segment then need no shuffle.

    There is a bucket per shuffle partition unless told otherwise. The files stay in
    ``folder``; the catalog entry that the write needs goes at once.
    """
    spark = df.sparkSession
    number = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"series_{uuid.uuid4().hex}"
    by_segment = df.repartition(number, SEGMENT).write.bucketBy(number, SEGMENT)
    by_segment.sortBy(SEGMENT, "timestamp").option("path", folder).saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def save_splits(df: DataFrame, folder: str, name: str = "splits") -> None:
    """Feature rows by split, so that a reader of one split skips the others."""
    df.hint("rebalance", "split").write.mode("overwrite").partitionBy("split").parquet(
        f"{folder}/{name}"
    )


def save_model(model: PipelineModel, folder: str, name: str) -> None:
    model.write().overwrite().save(f"{folder}/{name}")


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(f"{folder}/{name}")
