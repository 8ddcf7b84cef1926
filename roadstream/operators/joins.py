"""Joins of readings with roads and signals."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadstream.functions import traffic
from roadstream.operators.profile import latest_per_segment, peak_metrics
from roadstream.operators.sizes import dimension_join


def roadtype_join(
    readings: DataFrame, roads: DataFrame, roads_at_most: int | None = None
) -> DataFrame:
    """Readings on known segments with the road type the road table states."""
    return dimension_join(
        readings.drop("road_type"),
        roads.select("segment_id", "road_type"),
        "segment_id",
        rows_at_most=roads_at_most,
    )


def map_status(
    labelled: DataFrame, roads: DataFrame, roads_at_most: int | None = None
) -> DataFrame:
    """One marker per road that has a reading: place, latest values, colour, text."""
    # The code stands for the level, as a number.
    latest = latest_per_segment(labelled, ["speed_kmh", "volume_vehicles", "congestion_code"])
    places = roads.select("segment_id", "latitude", "longitude")
    level = F.col("congestion_level")
    return (
        dimension_join(latest, places, "segment_id", rows_at_most=roads_at_most)
        .withColumn("congestion_level", traffic.level_name(F.col("congestion_code")))
        .withColumns(
            {
                "color": traffic.status_color(level),
                "status": traffic.status_text(
                    F.col("segment_id"), F.col("speed_kmh"), F.col("volume_vehicles"), level
                ),
            }
        )
        .drop("timestamp", "congestion_code")
    )


def signal_metrics(
    signals: DataFrame, labelled: DataFrame, signals_at_most: int | None = None
) -> DataFrame:
    """Signals with the peak metrics of their segment; without readings, none.

    Readings of segments without a signal leave before the aggregation.
    """
    segments = signals.select("segment_id").distinct()
    wanted = dimension_join(
        labelled, segments, "segment_id", "left_semi", rows_at_most=signals_at_most
    )
    return signals.join(peak_metrics(wanted), "segment_id")


def signals_without_data(signals: DataFrame, readings: DataFrame) -> DataFrame:
    """Signals whose segment has no reading."""
    seen = readings.select("segment_id").distinct()
    return signals.join(seen, "segment_id", "left_anti")
