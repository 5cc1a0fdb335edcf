"""Threshold detection: one filter, one row per breach, or rules held in a table."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.joins import broadcast_within
from gaugeline.functions.predicates import above, breaches_any
from gaugeline.schema import RULES, SENSORS, Rule


def detect_any(readings: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """Readings that breach at least one rule."""
    return readings.filter(breaches_any(rules))


def detect_breaches(
    readings: DataFrame, rules: Sequence[Rule] = RULES, keep: Sequence[str] = ("well_id", "ts")
) -> DataFrame:
    """One row per reading and breached rule: (*keep, field, value, threshold, severity, type).

    The filter reaches the scan; only breaching readings are expanded, within their task. Rules
    are tested again after the expansion, in code that does not grow with their number.
    """
    columns = ("field", "value", "threshold", "severity", "type", "kind")
    expanded = detect_any(readings, rules).select(
        *keep,
        F.stack(
            F.lit(len(rules)),
            *[
                column
                for rule in rules
                for column in (
                    F.lit(rule.field),
                    F.col(rule.field).cast("double"),
                    F.lit(float(rule.threshold)),
                    F.lit(rule.severity),
                    F.lit(rule.type),
                    F.lit(rule.kind),
                )
            ],
        ).alias(*columns),
    )
    return expanded.filter(_limit_broken()).drop("kind")


def _limit_broken() -> Column:
    value, threshold = F.col("value"), F.col("threshold")
    return ((F.col("kind") == "max") & above(value, threshold)) | (
        (F.col("kind") == "min") & (value < threshold)
    )


def rule_table(spark: SparkSession, rules: Sequence[Rule] = RULES) -> DataFrame:
    rows = [(r.field, r.kind, float(r.threshold), r.severity) for r in rules]
    return spark.createDataFrame(rows, "field string, kind string, threshold double, severity string")


_RULE = ("field", "kind", "threshold", "severity")


def _checked(rules: Iterable, sensors: Sequence[str]) -> None:
    """A rule that cannot be applied must not vanish. A threshold is given as None if it is missing."""
    bad = [r for r in rules if r[1] not in ("max", "min") or r[0] not in sensors or r[2] is None]
    if bad:
        raise ValueError(f"rules of unknown kind or field, or without threshold: {bad[:3]}")


def _loosest(rules: DataFrame, sensors: Sequence[str]) -> list[Rule]:
    """For each field and kind, the limit that is broken if any rule's is. At most two for each sensor."""
    limits = rules.groupBy("field", "kind").agg(
        F.when(F.count_if(F.col("threshold").isNull()) == 0, F.min("threshold")).alias("low"),
        F.max("threshold").alias("high"),
    )
    found = limits.limit(2 * len(sensors) + 1).collect()
    _checked([(r["field"], r["kind"], r["low"]) for r in found], sensors)
    return [Rule(r["field"], r["kind"], r["low"] if r["kind"] == "max" else r["high"], "") for r in found]


def detect_with_rule_table(
    readings: DataFrame,
    rules: DataFrame,
    sensors: Sequence[str] = SENSORS,
    keep: Sequence[str] = ("well_id", "ts"),
) -> DataFrame:
    """detect_breaches with rules read from a table (field, kind, threshold, severity).

    With a ``well_id`` column, rules without one are the default, and a rule of a well replaces the
    default of the same field and kind there. Rules are folded to one row per well, so a reading
    is joined once, and only readings that break the loosest limit of some field are joined: that
    filter reaches the scan. Default rules go into the plan; there are two for each sensor at most that
    differ in field and kind, and any number of the same.
    """
    of_wells = "well_id" in rules.columns
    default = rules.filter("well_id is null") if of_wells else rules
    chosen = [Rule(*row) for row in default.select(*_RULE).collect()]
    _checked(chosen, sensors)
    if not of_wells and chosen:
        return detect_breaches(readings, chosen, keep)
    loosest = _loosest(rules, sensors)
    candidates = detect_any(readings, loosest) if loosest else readings.filter("false")
    numbers = F.array(*map(F.lit, sensors))
    rule = F.struct(
        F.array_position(numbers, F.col("field")).cast("int").alias("sensor_number"),
        "field",
        "kind",
        F.col("threshold").cast("double").alias("threshold"),
        "severity",
    )
    given = [
        F.struct(
            F.lit(sensors.index(r.field) + 1).alias("sensor_number"),
            F.lit(r.field).alias("field"),
            F.lit(r.kind).alias("kind"),
            F.lit(float(r.threshold)).alias("threshold"),
            F.lit(r.severity).alias("severity"),
        )
        for r in chosen
    ]
    kind = "array<struct<sensor_number:int,field:string,kind:string,threshold:double,severity:string>>"
    defaults = F.array(*given).cast(kind)
    rows, applied = candidates, defaults
    if of_wells:
        own = (
            rules.filter("well_id is not null")
            .groupBy("well_id")
            .agg(F.collect_list(rule).cast(kind).alias("own_rules"))
        )
        rows = candidates.join(broadcast_within(own), "well_id", "left")
        own_rules = F.coalesce("own_rules", F.array().cast(kind))
        left = F.filter(
            defaults,
            lambda d: ~F.exists(
                own_rules, lambda o: (o["field"] == d["field"]) & (o["kind"] == d["kind"])
            ),
        )
        applied = F.concat(own_rules, left)
    values = F.array(*[F.col(sensor).cast("double") for sensor in sensors])

    def broken(r: Column) -> Column:
        value = F.get(values, r["sensor_number"] - 1)
        return ((r["kind"] == "max") & above(value, r["threshold"])) | (
            (r["kind"] == "min") & (value < r["threshold"])
        )

    suffix = F.when(F.col("r.kind") == "max", "_high").otherwise("_low")
    return rows.select(
        *keep, values.alias("sensor_values"), F.explode(F.filter(applied, broken)).alias("r")
    ).select(
        *keep,
        "r.field",
        F.get("sensor_values", F.col("r.sensor_number") - 1).alias("value"),
        "r.threshold",
        "r.severity",
        F.concat("r.field", suffix).alias("type"),
    )
