"""Column expressions over the timing of one signal."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from roadstream import params as p


def cycle_length(green_ns: Column, green_ew: Column, yellow=p.YELLOW, all_red=p.ALL_RED) -> Column:
    return green_ns + green_ew + 2 * yellow + 2 * all_red


def timing_objective(
    green_ns: Column,
    green_ew: Column,
    volume_ns: Column,
    volume_ew: Column,
    weights=p.WEIGHTS,
) -> Column:
    """Weighted wait, negative throughput and idle emissions; lower is better."""
    weight_wait, weight_throughput, weight_emissions = weights
    cycle = cycle_length(green_ns, green_ew)
    volume = volume_ns + volume_ew
    wait = ((cycle - green_ns) / 2 * volume_ns + (cycle - green_ew) / 2 * volume_ew) / (
        volume + p.EPSILON
    )
    throughput = (green_ns + green_ew) * p.SATURATION_FLOW
    return (
        wait * weight_wait
        - throughput * weight_throughput
        + wait * volume / 100 * weight_emissions
    )


def delay_objective(
    green_ns: Column, green_ew: Column, volume_ns: Column, volume_ew: Column
) -> Column:
    """Mean uniform delay of a vehicle, and the square of what each green leaves waiting.

    Convex in the green times and not linear: a direction's delay is its red squared over
    twice the cycle, and vehicles of a cycle that do not fit its green are left over.
    """
    cycle = cycle_length(green_ns, green_ew)
    red_ns, red_ew = cycle - green_ns, cycle - green_ew
    delay = (red_ns * red_ns * volume_ns + red_ew * red_ew * volume_ew) / (
        2 * cycle * (volume_ns + volume_ew + p.EPSILON)
    )

    def left(green: Column, volume: Column) -> Column:
        over = F.greatest(volume * cycle / 3600 - green * p.SATURATION_FLOW, F.lit(0.0))
        return over * over

    return delay + left(green_ns, volume_ns) + left(green_ew, volume_ew)


def proportional_green(volume: Column, total: Column) -> Column:
    """Green time in proportion to the direction's share, within the bounds."""
    share = F.floor(volume / (total + p.EPSILON) * 100)
    return F.greatest(F.lit(p.MIN_GREEN), F.least(F.lit(p.MAX_GREEN), share)).cast("int")


def capacity(green: Column) -> Column:
    """Vehicles that can leave during one green phase."""
    return F.floor(green * p.SATURATION_FLOW).cast("bigint")
