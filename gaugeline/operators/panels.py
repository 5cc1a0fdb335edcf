"""Recent-range views behind the dashboard panels. Raw samples, no downsampling."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.predicates import recent
from gaugeline.operators.points import READINGS, breach_points, to_points

# Default ranges of the sensor panels and of the anomaly panel.
SENSOR_RANGE = timedelta(minutes=5)
ANOMALY_RANGE = timedelta(minutes=30)


def sensor_panel(
    points: DataFrame,
    field: str,
    as_of: datetime,
    width: timedelta = SENSOR_RANGE,
    measurement: str = READINGS,
    time_col: str = "ts",
) -> DataFrame:
    """Samples of one field in [as_of - width, as_of) from the points table."""
    samples = points.filter((F.col("measurement") == measurement) & (F.col("field") == field))
    return recent(samples, time_col, as_of, width)


def sensor_panel_of_readings(
    readings: DataFrame,
    sensor: str,
    as_of: datetime,
    width: timedelta = SENSOR_RANGE,
    time_col: str = "ts",
    keep: tuple[str, ...] = ("ts", "well_id"),
) -> DataFrame:
    """The same samples straight from wide readings: reads one sensor and the range only."""
    return to_points(recent(readings, time_col, as_of, width), [sensor], keep)


def anomaly_panel(
    breaches: DataFrame, as_of: datetime, width: timedelta = ANOMALY_RANGE, time_col: str = "ts"
) -> DataFrame:
    """Value and threshold of every breach in [as_of - width, as_of)."""
    return breach_points(recent(breaches, time_col, as_of, width))
