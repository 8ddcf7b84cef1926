"""Tables written and read back, and generated tables."""

import hashlib
import math
import re

from pyspark.sql import functions as F

from conftest import rows
from roadstream import params as p
from roadstream.functions.clock import clock_micros
from roadstream.functions.hashing import uniforms
from roadstream.operators import splits
from roadstream.plans.queries import rounded, tidy
from roadstream.schema import ROAD_NETWORK, TRAFFIC_DATA
from roadstream.sources import synthetic, tables

GRID = ("2024-01-01 00:00:00", "2024-01-03 23:45:00")


def generated(spark, n=40):
    roads = synthetic.synth_road_network(synthetic.segment_ids(spark, n))
    return roads, synthetic.synth_readings(roads, *GRID)


def test_round_trip(spark, tmp_path):
    roads, readings = generated(spark)
    readings = readings.withColumn(
        "speed_kmh", F.when(F.col("hour") == 3, math.nan).otherwise(F.col("speed_kmh"))
    )
    tables.save_table(roads, str(tmp_path), "road_network", csv=True)
    tables.save_table(readings, str(tmp_path), "traffic_data")
    loaded = tables.load_tables(spark, str(tmp_path), ("road_network", "traffic_data"))
    assert {f.name for f in loaded["traffic_data"].schema} == set(
        TRAFFIC_DATA.names
    )
    back = loaded["traffic_data"].select(readings.columns)
    assert back.count() == readings.count()
    assert back.filter("hour = 3 AND speed_kmh IS NOT NULL").count() == 0
    assert rows(back.filter("hour <> 3")) == rows(readings.filter("hour <> 3"))
    csv = spark.read.schema(ROAD_NETWORK).option("header", True)
    assert csv.csv(f"{tmp_path}/road_network_csv").count() == 40
    assert tables.load_table(spark, str(tmp_path), "road_network_csv", "csv").count() == 40


def test_day_filter_reads_one_folder(spark, tmp_path):
    _, readings = generated(spark, 3)
    tables.save_table(readings, str(tmp_path), "t")
    one = tables.load_table(spark, str(tmp_path), "t", days=("2024-01-02", "2024-01-02"))
    assert one.count() == 3 * 96
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_splits_round_trip(spark, tmp_path):
    _, readings = generated(spark, 3)
    split = splits.random_split(readings)
    tables.save_splits(split, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/splits").count() == readings.count()


def test_generated_rows_do_not_depend_on_partitions(spark):
    roads, readings = generated(spark)
    again = synthetic.synth_readings(roads.repartition(7), *GRID)
    assert rows(again) == rows(readings)
    assert readings.count() == 40 * 3 * 96


def test_generated_shares(spark):
    roads = synthetic.synth_road_network(synthetic.segment_ids(spark, 20_000))
    shares = {r.road_type: r["count"] / 20_000 for r in roads.groupBy("road_type").count().collect()}
    for name, share in zip(p.ROAD_TYPES, p.ROAD_TYPE_SHARES):
        assert abs(shares[name] - share) < 0.02
    low, high, signal = roads.agg(
        F.min("length_km"), F.max("length_km"), F.avg(F.col("has_traffic_signal").cast("int"))
    ).first()
    assert 0.5 <= low and high <= 3.0 and abs(signal - 0.3) < 0.02


def test_random_split_is_stable(traffic):
    first = rows(splits.random_split(traffic.readings))
    assert rows(splits.random_split(traffic.readings.repartition(9))) == first
    test = sum(1 for r in first if r[-1] == "test")
    assert 150 < test < 250


def test_generated_readings_have_the_table_types(spark):
    _, readings = generated(spark, 1)
    declared = {f.name: f.dataType.simpleString() for f in TRAFFIC_DATA}
    assert dict(readings.dtypes) == declared


def test_values_are_rounded_as_by_decimals(spark):
    """Ties, values beside them, both signs, small, large and odd values."""
    n = F.col("id") - 100_000
    near = spark.range(200_000).select(
        F.explode(
            F.array(
                n * 0.5e-6, n * 0.5e-6 + 4e-10, n * 0.5e-6 - 6e-10, n / 7, n / 7e9, n * 1e4 / 3, n * 1e15
            )
        ).alias("x")
    )
    odd = spark.sql("SELECT explode(array(double('NaN'), double('inf'), -0.0D, null, 1e6D)) AS x")
    both = near.unionByName(odd).select("x", rounded(F.col("x")).alias("a"), F.round(F.round("x", 9), 6).alias("b"))
    text = [F.col(c).cast("string") for c in "ab"]
    assert both.filter(~text[0].eqNullSafe(text[1])).count() == 0


def test_generated_rows_need_no_decimals_and_two_conversions(spark):
    """Each row of a panel costs no decimal number, each digest is read in two halves."""
    panel = tidy(synthetic.dense_panel(synthetic.segment_ids(spark, 5), *GRID))
    assert "secondwithfraction" not in panel._jdf.queryExecution().optimizedPlan().toString().lower()
    drawn = spark.range(3).select(*[u.alias(f"u{i}") for i, u in enumerate(uniforms(F.col("id"), seed=7))])
    plan = drawn._jdf.queryExecution().optimizedPlan().toString()
    assert len(set(re.findall(r"\), (\d+), \d+\), 16, -?10", plan))) == 2
    for row, key in zip(drawn.collect(), range(3)):
        digest = hashlib.md5(f"7|{key}".encode()).hexdigest()
        assert list(row) == [int(digest[8 * i : 8 * i + 8], 16) / 2**32 for i in range(4)]


def test_clock_time_is_the_same_in_every_zone(spark):
    made = spark.sql(
        """SELECT explode(array(timestamp_ntz'2024-03-10 02:30:00.123456', timestamp_ntz'1969-12-31 23:59:59.999999',
        timestamp_ntz'0001-01-01 00:00:00', timestamp_ntz'9999-12-31 23:59:59.5', null)) AS t"""
    )
    zone = spark.conf.get("spark.sql.session.timeZone")
    found = []
    for name in ("UTC", "America/New_York", "+05:30"):
        spark.conf.set("spark.sql.session.timeZone", name)
        try:
            found.append([r[0] for r in made.select(clock_micros(made, "t")).collect()])
        finally:
            spark.conf.set("spark.sql.session.timeZone", zone)
    assert found[0] == found[1] == found[2]
    assert found[0][0] == 1710037800123456 and found[0][1] == -1 and found[0][4] is None
