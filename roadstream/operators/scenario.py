"""Queues at signals under several timing plans, and the value of a better plan."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadstream import params as p
from roadstream.functions.signal import capacity
from roadstream.operators.series import SeriesPlan, plan_series, running
from roadstream.operators.sizes import dimension_join

DIRECTIONS = ("ns", "ew")
BASELINE, OPTIMIZED = "baseline", "optimized"
RESULTS = (
    "total_vehicles_arrived",
    "total_vehicles_served",
    "avg_wait_time_sec",
    "throughput_veh_per_hour",
    "utilization",
    "max_queue_length",
    "total_stops",
    "num_cycles",
)


def scenario_union(optimized: DataFrame) -> DataFrame:
    """One row per signal and scenario: the old plan and the new one."""

    def plan(scenario: str, suffix: str) -> Column:
        return F.struct(
            F.lit(scenario).alias("scenario"),
            "signal_id",
            "segment_id",
            F.col(f"green_time_ns{suffix}").alias("green_ns"),
            F.col(f"green_time_ew{suffix}").alias("green_ew"),
            F.col(f"cycle_length{suffix}").alias("cycle_length"),
        )

    both = F.array(plan(BASELINE, "_original"), plan(OPTIMIZED, ""))
    return optimized.select(F.inline(both))


def queue_balance(
    readings: DataFrame,
    plans: DataFrame,
    plans_at_most: int | None = None,
    plan: SeriesPlan | None = None,
) -> DataFrame:
    """Queue left after every cycle, per signal, scenario and direction.

    One reading is one cycle; its arrivals follow from the observed volume. With
    S the running sum of arrivals minus capacity, the queue that never goes below
    empty is S minus the least of 0 and the running minimum of S.
    """
    plan = plan or plan_series(readings)
    per_cycle = F.col("volume_vehicles") * F.col("cycle_length") / 3600
    arrivals = {"ns": F.floor(per_cycle), "ew": F.floor(per_cycle * p.EAST_WEST_SHARE)}
    cycles = dimension_join(
        plan.narrow(readings, "volume_vehicles"),
        plans,
        "segment_id",
        rows_at_most=plans_at_most,
    ).select(
        "signal_id",
        "scenario",
        "segment_id",
        "timestamp",
        "green_ns",
        "green_ew",
        "cycle_length",
        *plan.ties,
        *[arrivals[d].alias(f"arrivals_{d}") for d in DIRECTIONS],
        *[
            (arrivals[d] - capacity(F.col(f"green_{d}"))).alias(f"excess_{d}")
            for d in DIRECTIONS
        ],
    )

    def each(make) -> dict[str, Column]:
        out: dict[str, Column] = {}
        for d in DIRECTIONS:
            out.update(make(d))
        return out

    def within(df, w):
        sums = df.withColumns(each(lambda d: {f"sum_{d}": F.sum(f"excess_{d}").over(w)}))
        return sums.withColumns(each(lambda d: {f"low_{d}": F.min(f"sum_{d}").over(w)}))

    def combine(df, w):
        offsets = df.withColumns(
            each(lambda d: {f"offset_{d}": F.coalesce(F.sum(f"net_{d}").over(w), F.lit(0))})
        )
        floors = each(lambda d: {f"base_{d}": F.col(f"offset_{d}") + F.col(f"least_{d}")})
        return offsets.withColumns(floors).withColumns(
            each(lambda d: {f"floor_{d}": F.min(f"base_{d}").over(w)})
        )

    def queue(d: str) -> dict[str, Column]:
        offset = F.coalesce(f"offset_{d}", F.lit(0))
        low = F.least(
            F.lit(0), offset + F.col(f"low_{d}"), F.coalesce(f"floor_{d}", F.lit(0))
        )
        return {f"queue_{d}": offset + F.col(f"sum_{d}") - low}

    return running(
        cycles,
        within=within,
        summarise=each(
            lambda d: {f"net_{d}": F.sum(f"excess_{d}"), f"least_{d}": F.min(f"low_{d}")}
        ),
        combine=combine,
        carried=[f"{name}_{d}" for d in DIRECTIONS for name in ("offset", "floor")],
        finish=lambda df: df.withColumns(each(queue)).drop(
            *[f"{name}_{d}" for d in DIRECTIONS for name in ("excess", "sum", "low")],
            *plan.ties,
        ),
        keys=("signal_id", "scenario"),
        plan=plan,
    )


def scenario_compare(queues: DataFrame) -> DataFrame:
    """Results per signal and scenario from the queue after every cycle."""
    both = {
        name: F.col(f"{name}_ns") + F.col(f"{name}_ew") for name in ("arrivals", "queue")
    }
    waiting = F.col("queue_ns") * F.col("green_ns") + F.col("queue_ew") * F.col("green_ew")
    arrived, left = F.col("total_vehicles_arrived"), F.col("left")
    served = F.col("total_vehicles_served")
    return (
        queues.groupBy("signal_id", "scenario")
        .agg(
            F.sum(both["arrivals"]).alias("total_vehicles_arrived"),
            F.max_by(both["queue"], "timestamp").alias("left"),
            F.sum(waiting).alias("waiting"),
            ((F.max("queue_ns") + F.max("queue_ew")) / 2).alias("max_queue_length"),
            F.count("*").alias("num_cycles"),
            F.sum("cycle_length").alias("duration"),
        )
        .withColumn("total_vehicles_served", arrived - left)
        .withColumns(
            {
                "avg_wait_time_sec": F.col("waiting") / (served + p.EPSILON),
                "throughput_veh_per_hour": served / F.col("duration") * 3600,
                "utilization": served / (arrived + p.EPSILON),
                "total_stops": served,
            }
        )
        .select("signal_id", "scenario", *RESULTS)
    )


def scenario_pairs(results: DataFrame) -> DataFrame:
    """Both scenarios of a signal in one row; signals with one scenario drop out."""

    def pick(scenario: str) -> list[Column]:
        return [
            F.max(F.when(F.col("scenario") == scenario, F.col(c))).alias(f"{scenario}_{c}")
            for c in RESULTS
        ]

    both = F.countDistinct("scenario").alias("_scenarios")
    wide = results.groupBy("signal_id").agg(both, *pick(BASELINE), *pick(OPTIMIZED))
    return wide.filter("_scenarios = 2").drop("_scenarios")


def _mean(scenario: str, column: str) -> Column:
    return F.avg(F.when(F.col("scenario") == scenario, F.col(column)))


def scenario_improvement(results: DataFrame) -> DataFrame:
    """Percentage change of mean wait, throughput and queue, and four of the means."""
    means = {
        f"{scenario}_{name}": _mean(scenario, column)
        for name, column in (
            ("avg_wait", "avg_wait_time_sec"),
            ("throughput", "throughput_veh_per_hour"),
            ("queue", "max_queue_length"),
        )
        for scenario in (BASELINE, OPTIMIZED)
    }

    def change(name: str, sign: int) -> Column:
        base, new = F.col(f"{BASELINE}_{name}"), F.col(f"{OPTIMIZED}_{name}")
        return F.try_divide(sign * (new - base), base) * 100

    return results.agg(*[column.alias(name) for name, column in means.items()]).select(
        change("avg_wait", -1).alias("wait_time_reduction"),
        change("throughput", 1).alias("throughput_increase"),
        change("queue", -1).alias("queue_reduction"),
        *[c for c in means if not c.endswith("queue")],
    )


def benefits(results: DataFrame) -> DataFrame:
    """Hours, emissions, fuel and money saved.

    The plain columns multiply the sum of the mean waits by the sum of the
    vehicles. The ``*_per_signal`` columns multiply wait and vehicles signal by
    signal before they add up.
    """
    wait, served = F.col("avg_wait_time_sec"), F.col("total_vehicles_served")

    def hours(scenario: str) -> tuple[Column, Column]:
        mine = F.col("scenario") == scenario
        total = F.sum(F.when(mine, wait)) * F.sum(F.when(mine, served)) / 3600
        return total, F.sum(F.when(mine, wait * served)) / 3600

    (base, base_each), (new, new_each) = hours(BASELINE), hours(OPTIMIZED)
    sums = results.agg(
        base.alias("base"),
        new.alias("new"),
        base_each.alias("base_per_signal"),
        new_each.alias("new_per_signal"),
    )

    def value(suffix: str) -> list[Column]:
        before, after = F.col(f"base{suffix}"), F.col(f"new{suffix}")
        saved = before - after
        fuel = saved * p.FUEL_IDLE
        percent = F.when(before > 0, saved / before * 100).otherwise(0.0)
        columns = {
            "wait_time_saved_hours": saved,
            "co2_reduction_kg": saved * p.CO2_IDLE,
            "co2_reduction_pct": percent,
            "time_savings_value_usd": saved * p.TIME_VALUE,
            "fuel_savings_liters": fuel,
            "fuel_savings_value_usd": fuel * p.FUEL_COST,
            "total_economic_benefit_usd": saved * p.TIME_VALUE + fuel * p.FUEL_COST,
        }
        return [column.alias(f"{name}{suffix}") for name, column in columns.items()]

    return sums.select(*value(""), *value("_per_signal"))
