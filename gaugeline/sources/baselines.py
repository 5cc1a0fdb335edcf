"""Baseline levels per well and sensor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.schema import BASELINES, SENSORS


def explode_baselines(documents: DataFrame, text: Column) -> DataFrame:
    """JSON documents {well: {sensor: number}} to rows (well_id, sensor, baseline)."""
    wells = F.from_json(text, "map<string, map<string, double>>")
    return documents.select(F.explode(wells).alias("well_id", "sensors")).select(
        "well_id", F.explode("sensors").alias("sensor", "baseline")
    )


def read_baselines(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document per file; a large fleet is spread over many files."""
    return explode_baselines(spark.read.text(path, wholetext=True), F.col("value"))


def default_baselines(spark: SparkSession) -> DataFrame:
    rows = [
        (well, sensor, float(level))
        for well, levels in BASELINES.items()
        for sensor, level in zip(SENSORS, levels, strict=True)
    ]
    return spark.createDataFrame(rows, "well_id string, sensor string, baseline double")
