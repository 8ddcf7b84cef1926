"""Streams give what the batch gives on the same rows."""

from conftest import rows
from roadstream.streaming import reports

SCHEMA = (
    "segment_id string, timestamp timestamp, speed_kmh double, volume_vehicles int"
)


def write(spark, folder, data):
    spark.createDataFrame(data, "segment_id string, t string, s double, v int").selectExpr(
        "segment_id", "cast(t AS timestamp) AS timestamp", "s AS speed_kmh", "v AS volume_vehicles"
    ).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    from pyspark.sql.types import _parse_datatype_string

    files = reports.read_stream(spark, folder, _parse_datatype_string(SCHEMA), files=1)
    return reports.timed(files)


def test_late_rows_are_dropped(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder, [("A", "2024-01-01 10:01:00", 10.0, 1), ("A", "2024-01-01 10:02:00", 20.0, 3)])
    write(spark, folder, [("A", "2024-01-01 12:00:00", 50.0, 1)])
    # A batch drops what is older than the watermark of the batch before it.
    write(spark, folder, [("A", "2024-01-01 12:01:00", 70.0, 1)])
    write(spark, folder, [("A", "2024-01-01 10:03:00", 90.0, 1)])
    write(spark, folder, [("A", "2024-01-01 14:00:00", 50.0, 1)])
    out = reports.run_append(
        reports.interval_averages(stream(spark, folder)), str(tmp_path / "run")
    )
    found = {r.window_start.strftime("%H:%M"): (r.avg_speed, r.avg_volume, r.readings) for r in out.collect()}
    assert found["10:00"] == (15.0, 2.0, 2)
    assert found["12:00"] == (60.0, 1.0, 2)
    assert "14:00" not in found


def test_latest_over_several_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    write(spark, folder, [("A", "2024-01-01 10:00:00", 10.0, 1), ("B", "2024-01-01 10:00:00", 11.0, 2)])
    write(spark, folder, [("A", "2024-01-01 10:15:00", 30.0, 3)])
    write(spark, folder, [("A", "2024-01-01 10:05:00", 20.0, 4)])
    roads = spark.createDataFrame([("A", 40.0), ("B", 100.0)], "segment_id string, speed_limit double")
    latest = reports.status(reports.latest_state(stream(spark, folder)), roads)
    out = reports.run_latest(latest, str(tmp_path / "run"))
    found = rows(out.select("segment_id", "speed_kmh", "congestion_level", "color"))
    assert found == [("A", 30.0, "Moderate", "orange"), ("B", 11.0, "Severe", "darkred")]


def test_alerts_equal_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    data = [(s, f"2024-01-01 {h:02d}:{m:02d}:00", float(5 + (h * 7 + m) % 60), 1)
            for s in "AB" for h in range(8) for m in (0, 15, 30, 45)]
    write(spark, folder, data)
    roads = spark.createDataFrame([("A", 40.0), ("B", 100.0)], "segment_id string, speed_limit double")
    out = reports.run_append(
        reports.congestion_alerts(reports.with_road(stream(spark, folder), roads)),
        str(tmp_path / "run"),
    )
    batch = reports.congestion_alerts(reports.with_road(spark.read.parquet(folder), roads))
    closed = "window_end <= timestamp'2024-01-01 07:15:00'"
    assert out.count() > 0
    assert rows(out) == rows(batch.filter(closed))
