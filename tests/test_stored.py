"""Series stored for windows, row groups skipped, sketches merged, fills kept, timing searched."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from conftest import rows
from roadstream.functions import signal
from roadstream.operators import features, missing, signals, sketches
from roadstream.operators.series import SeriesPlan, plan_series
from roadstream.plans.features import processed_table
from roadstream.sources import synthetic, tables


@pytest.fixture(scope="module")
def generated(spark):
    roads = synthetic.synth_road_network(synthetic.segment_ids(spark, 12))
    made = synthetic.synth_readings(roads, "2024-01-01 00:00:00", "2024-01-04 23:45:00", 60)
    return roads, made.persist()


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_windows_on_stored_series_need_no_exchange(spark, generated, tmp_path):
    _, readings = generated
    stored = tables.series_table(readings, str(tmp_path / "series"), buckets=5)
    plan = plan_series(stored)
    assert not plan.split
    for make in (features.add_lags, features.add_rolling):
        found = make(stored, plan=plan)
        assert "Exchange" not in plan_of(found) and "Window" in plan_of(found)
        assert "Exchange" in plan_of(make(readings, plan=plan))
        assert rows(found) == rows(make(readings, plan=plan))
    gaps = features.add_lags(stored, plan=plan)
    filled = features.forward_fill(gaps, features.series_feature_names(gaps), plan)
    assert "Exchange" not in plan_of(filled)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("series_")]


def test_cut_series_on_a_stored_table(generated, tmp_path):
    """Long series are cut whatever the table; the rows stay the same."""
    _, readings = generated
    stored = tables.series_table(readings, str(tmp_path / "series"), buckets=3)
    whole = SeriesPlan(readings.count(), 12, 1_000_000)
    cut = plan_series(stored, block_rows=20)
    assert cut.split
    assert rows(features.add_lags(stored, plan=cut)) == rows(features.add_lags(readings, plan=whole))


def test_a_segment_is_in_few_row_groups(spark, generated, tmp_path):
    _, readings = generated
    many = readings.unionByName(readings.withColumn("segment_id", F.concat("segment_id", F.lit("x"))))
    wide = many.crossJoin(spark.range(60).withColumnRenamed("id", "copy"))
    tables.save_table(wide, str(tmp_path), "t", group_bytes=4096)
    groups = held = 0
    segment = readings.first().segment_id
    for file in Path(tmp_path / "t").rglob("*.parquet"):
        meta = pq.ParquetFile(file).metadata
        column = meta.schema.names.index("segment_id")
        for g in range(meta.num_row_groups):
            statistics = meta.row_group(g).column(column).statistics
            groups += 1
            held += statistics.min <= segment <= statistics.max
    assert 0 < held < groups / 4
    back = tables.load_table(spark, str(tmp_path), "t").filter(F.col("segment_id") == segment)
    assert back.count() == wide.filter(F.col("segment_id") == segment).count()
    assert "PushedFilters: [IsNotNull(segment_id), EqualTo(segment_id" in plan_of(back)


def test_sketches_merge(spark, generated):
    _, readings = generated
    daily = sketches.daily_sketches(readings)
    assert daily.count() == 4
    whole = sketches.merged(daily).select(
        "rows", sketches.distinct_count().alias("n"), sketches.quantile("speed_kmh", 0.5).alias("q")
    ).first()
    assert whole.rows == readings.count()
    assert abs(whole.n - 12) <= 1 + 4 * sketches.DISTINCT_ERROR * 12
    below = readings.filter(F.col("speed_kmh") < whole.q).count() / whole.rows
    upto = readings.filter(F.col("speed_kmh") <= whole.q).count() / whole.rows
    assert below <= 0.5 + sketches.RANK_ERROR and upto >= 0.5 - sketches.RANK_ERROR
    many = spark.range(40_000).selectExpr(
        "concat('S', id) AS segment_id", "timestamp'2024-01-01' AS timestamp",
        "double(id % 977) AS speed_kmh", "int(id) AS volume_vehicles",
    )
    half = F.col("volume_vehicles") % 2 == 0
    parts = [sketches.daily_sketches(many.filter(c)) for c in (half, ~half)]
    check = sketches.check_rows(many, sketches.merged(parts[0].unionByName(parts[1]), ["day"])).first()
    assert check.segments == 40_000 and check.count_in_bound and check.medians_in_bound
    wrong = sketches.daily_sketches(many.filter("volume_vehicles < 20000"))
    check = sketches.check_rows(many, wrong).first()
    assert not check.count_in_bound
    assert sketches.daily_sketches(many.limit(0)).count() == 0


def test_new_rows_are_filled_from_saved_values(spark, generated, tmp_path):
    roads, readings = generated
    fitted = {}
    old = readings.filter("timestamp < timestamp_ntz'2024-01-04 00:00:00'")
    processed_table(old, roads, fitted=fitted)
    tables.save_table(fitted["fill_values"], str(tmp_path), "fill_values")
    saved = tables.load_table(spark, str(tmp_path), "fill_values")
    values = {r.feature: r.value for r in saved.collect()}
    assert len(values) == 27 and None not in values.values()
    new = readings.filter("timestamp >= timestamp_ntz'2024-01-04 00:00:00'")
    done = processed_table(new, roads, saved=saved)
    assert missing.null_report(done).first().total == 0
    first = done.orderBy("timestamp").limit(1).first()
    for name in ("speed_lag_24", "volume_lag_1", "speed_rolling_std_4"):
        assert first[name] == values[name]
    # Filling the rows of the fit from the saved values gives what the fit gave.
    assert rows(processed_table(old, roads, saved=saved)) == rows(processed_table(old, roads))


def test_search_equals_the_second_grid(spark):
    volumes = [(i, 37.0 * i, 1900.0 - 41.0 * i) for i in range(45)] + [(90, 0.0, 0.0), (91, 5000.0, 1.0)]
    df = spark.createDataFrame(volumes, "id int, volume_ns double, volume_ew double")
    found = {r.id: tuple(r.best) for r in signals.search_timing(df).collect()}
    greens = spark.range(20, 121)
    grid = (
        df.crossJoin(greens.toDF("ns")).crossJoin(greens.toDF("ew"))
        .withColumn("o", signal.delay_objective(*[F.col(c) for c in ("ns", "ew", "volume_ns", "volume_ew")]))
        .groupBy("id").agg(F.min(F.struct("o", "ns", "ew")).alias("best"))
    )
    for r in grid.collect():
        assert found[r.id] == pytest.approx(tuple(r.best))
    plan = plan_of(signals.search_timing(df))
    assert "Join" not in plan and "Exchange" not in plan


def test_search_finds_the_corner_of_a_linear_objective(spark):
    df = spark.createDataFrame([(1, 300.0, 900.0), (2, 0.0, 5.0)], "id int, volume_ns double, volume_ew double")
    linear = signals.search_timing(df, signal.timing_objective).select("id", "best").collect()
    corner = signals.best_timing(df).select("id", "best").collect()
    assert sorted(linear) == sorted(corner)
