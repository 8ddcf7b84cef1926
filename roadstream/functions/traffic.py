"""Column expressions over one reading."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadstream import params as p


def rush_hour(hour: Column) -> Column:
    (m0, m1), (e0, e1) = p.MORNING_RUSH, p.EVENING_RUSH
    return ((hour >= m0) & (hour < m1)) | ((hour >= e0) & (hour < e1))


def base_pattern(
    hour: Column, is_weekend: Column, speed_limit: Column, road_type: Column
) -> tuple[Column, Column]:
    """Expected (speed, volume) for the time of day and the kind of road."""
    (m0, m1), (e0, e1) = p.MORNING_RUSH, p.EVENING_RUSH

    def factor(i: int) -> Column:
        return (
            F.when(is_weekend, p.PATTERN["weekend"][i])
            .when((hour >= m0) & (hour < m1), p.PATTERN["morning"][i])
            .when((hour >= e0) & (hour < e1), p.PATTERN["evening"][i])
            .when((hour >= 10) & (hour < 15), p.PATTERN["midday"][i])
            .when((hour >= 22) | (hour < 6), p.PATTERN["night"][i])
            .otherwise(p.PATTERN["normal"][i])
        )

    base = (
        F.when(road_type == "highway", p.BASE_VOLUMES["highway"])
        .when(road_type == "arterial", p.BASE_VOLUMES["arterial"])
        .otherwise(p.BASE_VOLUMES["local"])
    )
    return speed_limit * factor(1), base * factor(0)


def density(volume: Column, speed: Column) -> Column:
    return F.when(speed > 0, volume / speed).otherwise(0.0)


def travel_time(length_km: Column, speed: Column) -> Column:
    return F.when(speed > 0, length_km / speed * 60).otherwise(p.BLOCKED_TRAVEL_TIME)


def clamp_speed(speed: Column, limit: Column) -> Column:
    return F.greatest(F.lit(p.MIN_SPEED), F.least(speed, limit))


def whole_volume(volume: Column) -> Column:
    return F.greatest(F.lit(0.0), volume).cast("int")


def nan_to_null(value: Column) -> Column:
    """NaN sorts above every number in Spark; readings treat it as missing."""
    return F.when(~F.isnan(value), value)


def speed_ratio(speed: Column, limit: Column) -> Column:
    return F.try_divide(speed, limit)


def congestion_level(ratio: Column, thresholds=p.THRESHOLDS) -> Column:
    """First threshold reached; a missing ratio counts as the worst level."""
    *upper, worst = p.LEVELS
    level = F
    for name, threshold in zip(upper, thresholds):
        level = level.when(ratio >= threshold, name)
    return level.otherwise(worst)


def congestion_code(level: Column) -> Column:
    code = F
    for i, name in enumerate(p.LEVELS):
        code = code.when(level == name, i)
    return code.cast("int")


def level_name(code: Column) -> Column:
    return F.get(F.array(*map(F.lit, p.LEVELS)), code)


def is_congested(code: Column) -> Column:
    """1 for heavy or severe readings; a missing code counts as not congested."""
    return F.coalesce((code >= p.CONGESTED_CODE).cast("int"), F.lit(0))


def status_color(level: Column) -> Column:
    color = F
    for name, value in p.LEVEL_COLORS.items():
        color = color.when(level == name, value)
    return color.otherwise(p.UNKNOWN_COLOR)


def status_text(segment: Column, speed: Column, volume: Column, level: Column) -> Column:
    return F.format_string(
        "%s: Speed %.1f km/h, Volume %.0f veh/h, Status %s",
        segment,
        speed,
        volume.cast("double"),
        level,
    )


def cyclical(value: Column, period: int) -> tuple[Column, Column]:
    angle = 2 * F.pi() * value / period
    return F.sin(angle), F.cos(angle)


def argmax(scores: Column) -> Column:
    """0-based index of the first greatest element."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")
