from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.alerts import critical_alerts
from gaugeline.operators.detect import detect_breaches
from gaugeline.operators.panels import anomaly_panel, sensor_panel, sensor_panel_of_readings
from gaugeline.operators.points import breach_points, to_points
from gaugeline.schema import SENSORS

NOON = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def wide(spark, *rows):
    names = ["well_id", "well_status", "ts", "ingest_ts", *SENSORS]
    schema = "well_id string, well_status string, ts timestamp, ingest_ts timestamp, " + ", ".join(
        f"{s} double" for s in SENSORS
    )
    return spark.createDataFrame([tuple(row.get(n) for n in names) for row in rows], schema)


@pytest.fixture(scope="module")
def readings(spark):
    return wide(
        spark,
        {"well_id": "a", "well_status": "producing", "ts": NOON, "water_cut": 90.0, "sand_rate": 1.0},
        {"well_id": "a", "ts": NOON - timedelta(minutes=5), "water_cut": 10.0, "motor_current": 0.0},
        {"well_id": "b", "ts": NOON - timedelta(minutes=6), "water_cut": 20.0},
        {"well_id": "c", "ts": NOON},
    )


def test_one_point_per_present_sensor(readings):
    rows = {(r.well_id, r.well_status, r.field, r.value) for r in to_points(readings).collect()}
    assert rows == {
        ("a", "producing", "water_cut", 90.0),
        ("a", "producing", "sand_rate", 1.0),
        ("a", "unknown", "water_cut", 10.0),
        ("a", "unknown", "motor_current", 0.0),
        ("b", "unknown", "water_cut", 20.0),
    }
    assert to_points(readings).columns == [
        "ts", "ingest_ts", "well_id", "well_status", "measurement", "field", "value"
    ]


def test_breach_has_value_and_threshold(readings):
    rows = breach_points(detect_breaches(readings)).collect()
    got = {(r.well_id, r.measurement, r.anomaly_type, r.severity, r.field, r.value) for r in rows}
    assert got == {
        ("a", "well_anomalies", "water_cut_high", "warning", "value", 90.0),
        ("a", "well_anomalies", "water_cut_high", "warning", "threshold", 85.0),
        ("a", "well_anomalies", "motor_current_low", "critical", "value", 0.0),
        ("a", "well_anomalies", "motor_current_low", "critical", "threshold", 1.0),
    }


def test_panel_range_is_half_open(readings):
    panel = sensor_panel(to_points(readings), "water_cut", NOON)
    assert [(r.well_id, r.value) for r in panel.collect()] == [("a", 10.0)]
    later = sensor_panel(to_points(readings), "water_cut", NOON + timedelta(minutes=2))
    assert sorted(r.value for r in later.collect()) == [90.0]
    wider = sensor_panel(to_points(readings), "water_cut", NOON, timedelta(minutes=30))
    assert sorted(r.value for r in wider.collect()) == [10.0, 20.0]


@pytest.mark.parametrize("sensor", ["wellhead_pressure", "water_cut", "motor_current"])
def test_panel_of_readings_equals_panel_of_points(readings, sensor):
    as_of, width = NOON + timedelta(seconds=1), timedelta(minutes=30)
    keep = ("ts", "well_id")
    stored = sensor_panel(to_points(readings, keep=keep), sensor, as_of, width)
    direct = sensor_panel_of_readings(readings, sensor, as_of, width, keep=keep)
    assert sorted(map(str, stored.collect())) == sorted(map(str, direct.collect()))


def test_days_do_not_change_the_panel(readings):
    """Around midnight, with a day column: the same samples as without it."""
    midnight = datetime(2024, 1, 2, tzinfo=timezone.utc)
    points = to_points(readings.withColumn("ts", F.col("ts") + F.expr("INTERVAL 12 HOURS")))
    dated = points.withColumn("date", F.to_date("ts"))
    for shift in (-1, 0, 1, 6):
        as_of, width = midnight + timedelta(minutes=shift), timedelta(minutes=10)
        plain = sensor_panel(points, "water_cut", as_of, width)
        by_day = sensor_panel(dated, "water_cut", as_of, width).drop("date")
        assert plain.count() > 0
        assert sorted(map(str, plain.collect())) == sorted(map(str, by_day.collect()))
    assert sensor_panel(dated.withColumn("ingest_ts", F.col("ts")), "water_cut", midnight,
                        time_col="ingest_ts").count() == 1


def test_anomaly_panel_default_range(readings):
    breaches = detect_breaches(readings)
    assert {r.anomaly_type for r in anomaly_panel(breaches, NOON).collect()} == {"motor_current_low"}


def test_naive_as_of_is_utc(readings):
    points = to_points(readings)
    naive = sensor_panel(points, "water_cut", NOON.replace(tzinfo=None))
    assert naive.count() == sensor_panel(points, "water_cut", NOON).count() == 1


def breach(spark, value, threshold, severity="critical"):
    schema = "well_id string, field string, value double, threshold double, severity string, type string"
    return spark.createDataFrame([("W-1", "f", value, threshold, severity, "f_high")], schema)


def test_alert_text(spark):
    at = F.to_timestamp(F.lit("2024-01-02 03:04:05.678"))
    [row] = critical_alerts(breach(spark, 12.5, 10.0), alert_ts=at, heading="Heading").collect()
    assert row.subject == "[CRITICAL] Well W-1 - f_high"
    assert row.message == (
        "Heading\n"
        "========================================\n"
        "Well ID:      W-1\n"
        "Anomaly:      f_high\n"
        "Severity:     CRITICAL\n"
        "Value:        12.5\n"
        "Threshold:    10\n"
        "Timestamp:    2024-01-02T03:04:05.678000+00:00\n"
        "========================================\n"
        "Action Required: Investigate immediately."
    )


def test_warnings_make_no_alert(spark):
    assert critical_alerts(breach(spark, 12.5, 10.0, "warning")).count() == 0


@pytest.mark.parametrize(
    "value, text",
    [
        (0.0, "0.0"),
        (95.0, "95.0"),
        (-3.25, "-3.25"),
        (12345678.5, "12345678.5"),
        (10000000.0, "10000000.0"),
        (0.00025, "0.00025"),
        (999999999999999.0, "999999999999999.0"),
    ],
)
def test_numbers_in_plain_notation(spark, value, text):
    [row] = critical_alerts(breach(spark, value, 0.5)).collect()
    assert f"Value:        {text}\n" in row.message
    assert "Threshold:    0.5\n" in row.message


def test_alert_id_is_the_same_when_processed_again(spark):
    source = breach(spark, 12.5, 10.0).selectExpr("*", "'t' topic", "0 partition", "7L offset")
    first, second = (critical_alerts(source).collect()[0].alert_id for _ in range(2))
    assert first == second
    other = source.withColumn("offset", F.lit(8))
    assert critical_alerts(other).collect()[0].alert_id != first
