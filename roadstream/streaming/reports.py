"""Streams of readings kept up to date as interval means, latest state and alerts.

Watermarks need TIMESTAMP, so streams carry the reading time in that type.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from roadstream import params as p
from roadstream.functions import traffic
from roadstream.operators.features import with_labels
from roadstream.operators.profile import congested, latest_per_segment

LATE = "30 minutes"


def read_stream(
    spark: SparkSession, folder: str, schema: StructType, pattern: str = "*.parquet", files=1000
) -> DataFrame:
    """Files of a folder as a stream, at most ``files`` new ones per batch."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files)
        .parquet(folder)
    )


def timed(readings: DataFrame, late: str = LATE) -> DataFrame:
    """Reading time as TIMESTAMP, with a watermark."""
    return readings.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark(
        "timestamp", late
    )


def interval_averages(readings: DataFrame, width: str = "15 minutes") -> DataFrame:
    """Mean speed and volume per segment and interval; late readings are dropped."""
    return (
        readings.groupBy("segment_id", F.window("timestamp", width).alias("w"))
        .agg(
            F.avg("speed_kmh").alias("avg_speed"),
            F.avg("volume_vehicles").alias("avg_volume"),
            F.count("*").alias("readings"),
        )
        .select(
            "segment_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "avg_speed",
            "avg_volume",
            "readings",
        )
    )


def congested_windows(
    labelled: DataFrame, width: str = "1 hour", slide: str = "15 minutes"
) -> DataFrame:
    """Congested share of each segment and sliding window."""
    return (
        labelled.groupBy("segment_id", F.window("timestamp", width, slide).alias("w"))
        .agg(F.avg(congested()).alias("congested_share"), F.count("*").alias("readings"))
        .select(
            "segment_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "congested_share",
            "readings",
        )
    )


def alerts(windows: DataFrame, threshold: float = p.ALERT_THRESHOLD / 100) -> DataFrame:
    """The windows whose congested share is above the threshold."""
    return windows.filter(F.col("congested_share") > threshold)


def congestion_alerts(
    labelled: DataFrame,
    threshold: float = p.ALERT_THRESHOLD / 100,
    width: str = "1 hour",
    slide: str = "15 minutes",
) -> DataFrame:
    """Segments and sliding windows whose congested share is above the threshold.

    For an append stream, which gives a window once it is closed. In an update stream a
    share may fall again, so there ``alerts`` comes after ``run_latest``.
    """
    return alerts(congested_windows(labelled, width, slide), threshold)


def latest_state(readings: DataFrame) -> DataFrame:
    """The last reading of each segment; the state holds one row per segment."""
    return latest_per_segment(readings, ["speed_kmh", "volume_vehicles"], mode="row")


def with_road(stream: DataFrame, roads: DataFrame) -> DataFrame:
    """Stream-static join with the speed limit, and the level it gives."""
    limits = roads.select("segment_id", "speed_limit")
    return with_labels(stream.join(limits, "segment_id"))


def status(stream: DataFrame, roads: DataFrame) -> DataFrame:
    """Latest state with level and colour."""
    colour = traffic.status_color(F.col("congestion_level"))
    return with_road(stream, roads).withColumn("color", colour)


def run_append(stream: DataFrame, folder: str) -> DataFrame:
    """Process all available input into Parquet files and return them.

    Windows that the last watermark leaves open are not among them; ``run_latest`` gives
    those too.
    """
    query = (
        stream.writeStream.outputMode("append")
        .format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{folder}/out")


def run_latest(
    stream: DataFrame, folder: str, key: str | list[str] = "segment_id"
) -> DataFrame:
    """Process all available input of an update stream and return the last row of each key.

    Each batch writes its changed rows to a folder of its own, so that a repeated
    batch replaces what it wrote before.
    """
    schema = StructType([*stream.schema.fields, StructField("batch", LongType())])

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/out/batch={number}")

    query = (
        stream.writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    changes = stream.sparkSession.read.schema(schema).parquet(f"{folder}/out")
    keys = [key] if isinstance(key, str) else key
    names = [c for c in changes.columns if c not in (*keys, "batch")]
    last = F.max_by(F.struct(*names), "batch").alias("last")
    return changes.groupBy(*keys).agg(last).select(*keys, "last.*")
