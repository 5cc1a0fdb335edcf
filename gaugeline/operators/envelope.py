"""Readings that leave the normal envelope around their well's baseline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.joins import broadcast_within
from gaugeline.functions.predicates import above
from gaugeline.schema import SENSORS

# Fixed value: normal readings stay within 5% of the baseline.
TOLERANCE = 0.05


def out_of_envelope(
    readings: DataFrame,
    baselines: DataFrame,
    sensors: Sequence[str] = SENSORS,
    tolerance: float = TOLERANCE,
    keep: Sequence[str] = ("well_id", "ts"),
) -> DataFrame:
    """One row per sensor value further than tolerance * |baseline| from its baseline:
    (*keep, field, value, baseline, deviation).

    ``baselines`` is (well_id, sensor, baseline). It is turned into one row per well, so each
    reading takes part in the join once instead of once per sensor.
    """
    base = {sensor: f"_base_{sensor}" for sensor in sensors}
    per_well = baselines.groupBy("well_id").agg(
        *[
            F.max(F.when(F.col("sensor") == sensor, F.col("baseline"))).alias(name)
            for sensor, name in base.items()
        ]
    )
    joined = readings.join(broadcast_within(per_well), "well_id")
    # Expanding first and testing afterwards keeps the generated loop small: one test per sensor
    # inside the expansion outgrows the JVM's limit for compiled methods.
    triples = [
        column
        for sensor, name in base.items()
        for column in (F.lit(sensor), F.col(sensor).cast("double"), F.col(name))
    ]
    levels = joined.select(*keep, F.stack(F.lit(len(base)), *triples).alias("field", "value", "baseline"))
    away = F.col("value") - F.col("baseline")
    outside = levels.filter(above(F.abs(away), F.lit(tolerance) * F.abs("baseline")))
    return outside.withColumn("deviation", F.try_divide(away, F.col("baseline")))
