"""Generated roads and readings, for load tests.

Every value is a function of the row's key and a seed: any part of the table can
be produced on its own, and a recomputed task gives the same rows.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions import traffic
from roadstream.functions.clock import clock_micros
from roadstream.functions.hashing import between, choose, uniforms


def segment_ids(spark: SparkSession, n: int) -> DataFrame:
    return spark.range(n).select(F.format_string("SEG_%03d", "id").alias("segment_id"))


def synth_road_network(segments: DataFrame, seed: int = p.SEED) -> DataFrame:
    """Road attributes for each ``segment_id``."""
    kind, length, lanes, signal = uniforms(F.col("segment_id"), seed=seed, salt="road")
    lat, lon, *_ = uniforms(F.col("segment_id"), seed=seed, salt="place")
    limit = F
    for name, value in p.SPEED_LIMITS.items():
        limit = limit.when(F.col("road_type") == name, value)
    return segments.select(
        "segment_id",
        choose(kind, p.ROAD_TYPE_SHARES, p.ROAD_TYPES).alias("road_type"),
        between(length, 0.5, 3.0).alias("length_km"),
        choose(lanes, p.LANE_SHARES, (1, 2, 3, 4)).alias("num_lanes"),
        (p.CENTER[0] + between(lat, -0.1, 0.1)).alias("latitude"),
        (p.CENTER[1] + between(lon, -0.1, 0.1)).alias("longitude"),
        (signal < p.SIGNAL_SHARE).alias("has_traffic_signal"),
    ).withColumn("speed_limit", limit)


def dense_panel(
    roads: DataFrame, start: str, end: str, minutes: int = 15, tasks: int | None = None
) -> DataFrame:
    """Each row of ``roads`` at each grid time from start to end, both included.

    The grid is made in two steps, about a day and then its times, with the days
    of all roads spread over ``tasks`` in between: a few roads over a long time
    keep every task busy.
    """
    spark = roads.sparkSession
    tasks = tasks or int(spark.conf.get("spark.sql.shuffle.partitions"))
    per_day = -(-24 * 60 // minutes)
    last = F.expr(f"timestamp_ntz'{end}'")
    step = F.expr(f"INTERVAL {minutes} MINUTES")
    day = F.expr(f"INTERVAL {minutes * per_day} MINUTES")
    days = F.sequence(F.expr(f"timestamp_ntz'{start}'"), last, day)
    spread = roads.select("*", F.explode(days).alias("_day")).repartition(
        tasks, "segment_id", "_day"
    )
    times = F.sequence("_day", F.least(F.col("_day") + step * (per_day - 1), last), step)
    return spread.select(*roads.columns, F.explode(times).alias("timestamp"))


def synth_readings(
    roads: DataFrame, start: str, end: str, minutes: int = 15, seed: int = p.SEED
) -> DataFrame:
    """Readings on the grid: time-of-day pattern, noise, weather and accidents."""
    panel = dense_panel(roads, start, end, minutes)
    ts = F.col("timestamp")
    noise = uniforms(F.col("segment_id"), clock_micros(panel, "timestamp"), seed=seed)
    weather = noise[2] < p.WEATHER_SHARE
    accident = noise[3] < p.ACCIDENT_SHARE
    base_speed, base_volume = traffic.base_pattern(
        F.hour(ts), F.weekday(ts) >= 5, F.col("speed_limit"), F.col("road_type")
    )
    speed = base_speed * between(noise[0], 0.9, 1.1)
    volume = base_volume * between(noise[1], 0.8, 1.2)
    speed = speed * F.when(weather, p.WEATHER_SPEED).otherwise(1.0)
    volume = volume * F.when(weather, p.WEATHER_VOLUME).otherwise(1.0)
    raw = panel.select(
        "segment_id",
        "timestamp",
        "speed_limit",
        "length_km",
        (speed * F.when(accident, p.ACCIDENT_SPEED).otherwise(1.0)).alias("speed"),
        (volume * F.when(accident, p.ACCIDENT_VOLUME).otherwise(1.0)).alias("volume"),
        accident.alias("has_accident"),
    )
    return derived_measures(raw)


def derived_measures(raw: DataFrame) -> DataFrame:
    """Readings from raw ``speed`` and ``volume``.

    Density and travel time use the raw speed, the speed column is clamped.
    """
    ts, speed, volume = F.col("timestamp"), F.col("speed"), F.col("volume")
    return raw.select(
        "timestamp",
        "segment_id",
        traffic.clamp_speed(speed, F.col("speed_limit")).alias("speed_kmh"),
        traffic.whole_volume(volume).alias("volume_vehicles"),
        traffic.density(volume, speed).alias("density_vehicles_per_km"),
        traffic.travel_time(F.col("length_km"), speed).alias("travel_time_min"),
        "has_accident",
        F.weekday(ts).alias("day_of_week"),
        F.hour(ts).alias("hour"),
        (F.weekday(ts) >= 5).alias("is_weekend"),
        traffic.rush_hour(F.hour(ts)).alias("is_rush_hour"),
    )
