"""Column types of the tables the operators pass to each other."""

from pyspark.sql.types import (
    BooleanType,
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _table(**columns) -> StructType:
    return StructType([StructField(name, kind()) for name, kind in columns.items()])


ROAD_NETWORK = _table(
    segment_id=StringType,
    road_type=StringType,
    speed_limit=DoubleType,
    length_km=DoubleType,
    num_lanes=IntegerType,
    latitude=DoubleType,
    longitude=DoubleType,
    has_traffic_signal=BooleanType,
)

TRAFFIC_DATA = _table(
    timestamp=TimestampNTZType,
    segment_id=StringType,
    speed_kmh=DoubleType,
    volume_vehicles=IntegerType,
    density_vehicles_per_km=DoubleType,
    travel_time_min=DoubleType,
    has_accident=BooleanType,
    day_of_week=IntegerType,
    hour=IntegerType,
    is_weekend=BooleanType,
    is_rush_hour=BooleanType,
)

TRAFFIC_SIGNALS = _table(
    signal_id=StringType,
    segment_id=StringType,
    latitude=DoubleType,
    longitude=DoubleType,
    cycle_length=IntegerType,
    green_time_ns=IntegerType,
    green_time_ew=IntegerType,
    yellow_time=IntegerType,
    all_red_time=IntegerType,
)

SCHEMAS = {
    "road_network": ROAD_NETWORK,
    "traffic_data": TRAFFIC_DATA,
    "traffic_signals": TRAFFIC_SIGNALS,
}
