"""How many labelled faults the threshold rules catch."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.predicates import breaches_any
from gaugeline.schema import RULES, Rule


def label_coverage(
    readings: DataFrame,
    rules: Iterable[Rule] = RULES,
    label: str = "anomaly_type",
    by: Sequence[str] = (),
) -> DataFrame:
    """Per label (and ``by``): readings, detected, rate. Counts are combined before the shuffle,
    so a hot label costs no more than a rare one."""
    detected = F.count_if(F.coalesce(breaches_any(rules), F.lit(False)))
    return (
        readings.filter(F.col(label).isNotNull())
        .groupBy(*by, label)
        .agg(F.count("*").alias("readings"), detected.alias("detected"))
        .withColumn("rate", F.col("detected") / F.col("readings"))
    )
