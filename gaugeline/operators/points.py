"""Wide readings and breaches as long time-series points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.schema import SENSORS

READINGS = "well_readings"
ANOMALIES = "well_anomalies"


def to_points(
    readings: DataFrame,
    sensors: Sequence[str] = SENSORS,
    keep: Sequence[str] = ("ts", "ingest_ts", "well_id"),
    measurement: str = READINGS,
) -> DataFrame:
    """One row per reading and present sensor: (*keep, well_status, measurement, field, value)."""
    tags = [*keep, "well_status", "measurement"]
    return (
        readings.select(
            *keep,
            F.coalesce("well_status", F.lit("unknown")).alias("well_status"),
            F.lit(measurement).alias("measurement"),
            *[F.col(sensor).cast("double").alias(sensor) for sensor in sensors],
        )
        .unpivot(tags, list(sensors), "field", "value")
        .filter(F.col("value").isNotNull())
    )


def breach_points(
    breaches: DataFrame, keep: Sequence[str] = ("ts", "well_id"), measurement: str = ANOMALIES
) -> DataFrame:
    """Two rows per breach, its value and its threshold, tagged with type and severity."""
    tags = [*keep, "measurement", "anomaly_type", "severity"]
    return breaches.select(
        *keep,
        F.lit(measurement).alias("measurement"),
        F.col("type").alias("anomaly_type"),
        "severity",
        "value",
        "threshold",
    ).unpivot(tags, ["value", "threshold"], "field", "reading").withColumnRenamed("reading", "value")
