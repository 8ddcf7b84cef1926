"""Aggregates of labelled readings."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import traffic


def congested() -> Column:
    return traffic.is_congested(F.col("congestion_code"))


def level_distribution(labelled: DataFrame) -> DataFrame:
    """Rows and share of each congestion level, the most frequent first."""
    counts = (
        labelled.filter(F.col("congestion_level").isNotNull())
        .groupBy("congestion_level")
        .agg(F.count("*").alias("rows"))
    )
    # Four rows at most, so one window partition.
    total = F.sum("rows").over(Window.partitionBy())
    return counts.withColumn("share", F.col("rows") / total).orderBy(
        F.desc("rows"), "congestion_level"
    )


def volume_by_road_type(joined: DataFrame) -> DataFrame:
    return (
        joined.filter(F.col("road_type").isNotNull())
        .groupBy("road_type")
        .agg(F.avg("volume_vehicles").alias("avg_volume"))
    )


def hourly_profile(readings: DataFrame) -> DataFrame:
    return (
        readings.filter(F.col("hour").isNotNull())
        .groupBy("hour")
        .agg(
            F.avg(traffic.nan_to_null(F.col("speed_kmh"))).alias("avg_speed"),
            F.avg("volume_vehicles").alias("avg_volume"),
        )
    )


def segment_stats(labelled: DataFrame) -> DataFrame:
    """Mean speed, mean and peak volume and congested percentage of every segment."""
    return labelled.groupBy("segment_id").agg(
        F.avg("speed_kmh").alias("avg_speed"),
        F.avg("volume_vehicles").alias("avg_volume"),
        F.max("volume_vehicles").alias("peak_volume"),
        (F.avg(congested()) * 100).alias("congested_pct"),
    )


def hotspots(labelled: DataFrame, k: int = 10) -> DataFrame:
    """The k segments with the highest congested percentage."""
    return segment_stats(labelled).orderBy(F.desc("congested_pct"), "segment_id").limit(k)


def congested_share(labelled: DataFrame) -> DataFrame:
    return labelled.agg(F.avg(congested()).alias("congested_share"))


def peak_metrics(labelled: DataFrame) -> DataFrame:
    """Means over the rush hours of each segment; over all hours if it has none."""
    rush = F.col("is_rush_hour").cast("int") == 1
    has_rush = F.count_if(rush) > 0

    def peak(value: Column) -> Column:
        return F.when(has_rush, F.avg(F.when(rush, value))).otherwise(F.avg(value))

    return labelled.groupBy("segment_id").agg(
        peak(F.col("volume_vehicles")).alias("avg_volume"),
        peak(F.col("speed_kmh")).alias("avg_speed"),
        peak(F.col("density_vehicles_per_km")).alias("avg_density"),
        peak(congested()).alias("congested_share"),
    )


def latest_per_segment(
    df: DataFrame, columns: list[str] | None = None, mode: str = "column"
) -> DataFrame:
    """Latest state of each segment.

    ``column`` takes the last known value of every column, ``row`` the last row
    as it is. Numbers aggregate in a hash table; text makes Spark sort its input.
    """
    names = [c for c in columns or df.columns if c not in ("segment_id", "timestamp")]
    ts = F.col("timestamp")

    def at(name: str) -> Column:
        return ts if mode == "row" else F.when(F.col(name).isNotNull(), ts)

    return df.groupBy("segment_id").agg(
        F.max(ts).alias("timestamp"), *[F.max_by(c, at(c)).alias(c) for c in names]
    )


def dataset_counts(readings: DataFrame, roads: DataFrame, signals: DataFrame) -> DataFrame:
    """One row: number of segments, signals, readings and segments with readings."""
    per_segment = readings.groupBy("segment_id").agg(F.count("*").alias("n"))
    counts = (
        roads.agg(F.count("*").alias("segments"))
        .unionByName(signals.agg(F.count("*").alias("signals")), allowMissingColumns=True)
        .unionByName(
            per_segment.agg(
                F.sum("n").alias("readings"), F.count("*").alias("observed_segments")
            ),
            allowMissingColumns=True,
        )
    )
    return counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns])


def distinct_segments(readings: DataFrame) -> DataFrame:
    return readings.select("segment_id").distinct()


def map_center(roads: DataFrame) -> DataFrame:
    return roads.agg(F.avg("latitude").alias("latitude"), F.avg("longitude").alias("longitude"))


def hour_heatmap(labelled: DataFrame) -> DataFrame:
    """Congested percentage of each segment, one column per hour of the day."""
    hour = F.col("hour")
    return labelled.groupBy("segment_id").agg(
        *[(F.avg(F.when(hour == h, congested())) * 100).alias(f"h{h:02d}") for h in range(24)]
    )


def forecast_alerts(forecast: DataFrame, threshold: float = p.ALERT_THRESHOLD) -> DataFrame:
    """Per segment: the peak predicted percentage and the predictions above threshold."""
    return forecast.groupBy("segment_id").agg(
        F.max("predicted").alias("peak"),
        F.count_if(F.col("predicted") > threshold).alias("alerts"),
    )
