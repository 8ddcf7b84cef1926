"""The given event table read as road traffic: a user is a segment, an event a reading."""

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream.functions.traffic import nan_to_null
from roadstream.operators.features import add_congestion_labels, add_series_features
from roadstream.operators.series import SeriesPlan, plan_series
from roadstream.operators.signals import build_signals
from roadstream.operators.sizes import checkpointed
from roadstream.sources.synthetic import derived_measures


def road_columns(df: DataFrame) -> DataFrame:
    """Road attributes as arithmetic of the segment number."""
    user = F.col("user_id")
    kind = user % 5
    road_type = F.when(kind == 0, "highway").when(kind <= 2, "arterial").otherwise("local")
    limit = F.when(kind == 0, 100.0).when(kind <= 2, 60.0).otherwise(40.0)
    return df.withColumns(
        {
            "segment_id": F.format_string("SEG_%04d", user),
            "road_type": road_type,
            "speed_limit": limit,
            "length_km": 0.5 * (1 + user % 6),
            "num_lanes": (1 + user % 4).cast("int"),
            "latitude": 40.7128 + (user % 21 - 10).cast("double") / 100,
            "longitude": -74.006 + (user % 19 - 9).cast("double") / 100,
            "has_traffic_signal": user % 10 < 3,
        }
    )


def raw_measures(events: DataFrame) -> DataFrame:
    """Unclamped speed and volume of each event, with the attributes of its road."""
    volume = 20 * F.regexp_extract("props", "([0-9]+)", 1).cast("int")
    return road_columns(events).withColumns(
        {
            "timestamp": F.col("ts"),
            "speed": nan_to_null(F.col("value")),
            "volume": volume.cast("double"),
            "has_accident": F.col("event_type") == "error",
        }
    )


@dataclass(frozen=True)
class TrafficTables:
    """The traffic tables behind one folder of given tables."""

    spark: SparkSession
    folder: str

    @cached_property
    def events(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/events.parquet")

    @cached_property
    def raw(self) -> DataFrame:
        return raw_measures(self.events)

    @cached_property
    def readings(self) -> DataFrame:
        return derived_measures(self.raw)

    @cached_property
    def roads(self) -> DataFrame:
        """Written once, so that joins and streams read the small table, not the events."""
        segments = self.events.select("user_id").distinct()
        return checkpointed(road_columns(segments).drop("user_id"))

    @cached_property
    def signals(self) -> DataFrame:
        """A signal on every segment that has one."""
        return checkpointed(build_signals(self.roads, None, self.roads_at_most))

    @cached_property
    def plan(self) -> SeriesPlan:
        """Row count and long series, counted once for the queries on this object."""
        return plan_series(self.readings)

    @cached_property
    def roads_at_most(self) -> int:
        """Rows of the written road table, counted without reading the events again."""
        return self.roads.count()

    @cached_property
    def labelled(self) -> DataFrame:
        return add_congestion_labels(self.readings, self.roads, self.roads_at_most)

    @cached_property
    def features(self) -> DataFrame:
        return add_series_features(self.labelled, plan=self.plan)
