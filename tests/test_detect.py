"""Detector edge rows and properties."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, TimestampType

from gaugeline.functions.predicates import breaches_any
from gaugeline.operators.alerts import critical_alerts, critical_rules
from gaugeline.operators.detect import (
    detect_any,
    detect_breaches,
    detect_with_rule_table,
    rule_table,
)
from gaugeline.schema import BASELINES, READING_SCHEMA, RULES, SENSORS

SCHEMA = StructType([*READING_SCHEMA.fields, StructField("ts", TimestampType())])
NORMAL = dict(zip(SENSORS, map(float, BASELINES["WELL-AB-001"])))


def readings(spark, *rows):
    return spark.createDataFrame(
        [tuple({"well_id": "w", **row}.get(name) for name in SCHEMA.names) for row in rows], SCHEMA
    )


def breached(rule):
    return float(rule.threshold) + (0.5 if rule.kind == "max" else -0.5)


EDGES = {
    "at every limit": ({**NORMAL, **{r.field: float(r.threshold) for r in RULES}}, []),
    "all null": ({}, []),
    "NaN": ({**NORMAL, **{r.field: float("nan") for r in RULES}}, []),
    "just above": ({**NORMAL, "h2s_concentration": 10.0000001}, ["h2s_concentration_high"]),
    "infinite": ({**NORMAL, "h2s_concentration": float("inf")}, ["h2s_concentration_high"]),
    "minus infinite": ({**NORMAL, "motor_current": float("-inf")}, ["motor_current_low"]),
    "stopped": ({**NORMAL, "motor_current": 0.0}, ["motor_current_low"]),
    "two": (
        {**NORMAL, "h2s_concentration": 50.0, "water_cut": 95.0},
        ["h2s_concentration_high", "water_cut_high"],
    ),
    "all": ({**NORMAL, **{r.field: breached(r) for r in RULES}}, [r.type for r in RULES]),
}


@pytest.mark.parametrize("case", EDGES)
def test_edge(spark, case):
    row, expected = EDGES[case]
    df = readings(spark, row)
    breaches = detect_breaches(df)
    assert sorted(r.type for r in breaches.collect()) == sorted(expected)
    assert detect_any(df).count() == bool(expected)
    critical = {r.type for r in RULES if r.severity == "critical"}
    assert critical_alerts(breaches).count() == len(critical & set(expected))


@pytest.mark.parametrize("well", BASELINES)
def test_baselines_breach_nothing(spark, well):
    df = readings(spark, dict(zip(SENSORS, map(float, BASELINES[well]))))
    assert detect_any(df).count() == 0


def test_breach_columns(spark):
    df = readings(spark, {**NORMAL, "wellhead_pressure": 399.0})
    [row] = detect_breaches(df).collect()
    assert row.asDict() == {
        "well_id": "w",
        "ts": None,
        "field": "wellhead_pressure",
        "value": 399.0,
        "threshold": 400.0,
        "severity": "critical",
        "type": "wellhead_pressure_low",
    }


@pytest.fixture(scope="module")
def mixed(spark):
    """Random rows around the limits, with nulls, NaN and infinities."""
    pick = random.Random(7)
    odd = [None, float("nan"), float("inf"), float("-inf")]
    rows = []
    for i in range(400):
        row = {"well_id": f"w{i}"}
        for rule in RULES:
            row[rule.field] = pick.choice([*odd, rule.threshold - 1.0, float(rule.threshold), rule.threshold + 1.0])
        rows.append(row)
    return readings(spark, *rows).cache(), rows


def brute_force(rows):
    found = []
    for row in rows:
        for rule in RULES:
            value = row[rule.field]
            if value is None:
                continue
            if value > rule.threshold if rule.kind == "max" else value < rule.threshold:
                found.append((row["well_id"], rule.type, value))
    return sorted(found, key=str)


def test_breaches_match_brute_force(mixed):
    df, rows = mixed
    got = [(r.well_id, r.type, r.value) for r in detect_breaches(df).collect()]
    assert sorted(got, key=str) == brute_force(rows)


def test_rule_table_gives_the_same(spark, mixed):
    df, rows = mixed
    got = detect_with_rule_table(df, rule_table(spark))
    assert got.columns == detect_breaches(df).columns
    assert sorted([(r.well_id, r.type, r.value) for r in got.collect()], key=str) == brute_force(rows)


def test_filter_and_expansion_agree_within_a_row(mixed):
    df, _ = mixed
    per_row = detect_breaches(df).groupBy("well_id").count()
    both = df.select("well_id", F.coalesce(breaches_any(), F.lit(False)).alias("hit")).join(
        per_row, "well_id", "left"
    )
    assert both.filter(F.col("hit") != F.col("count").isNotNull()).count() == 0


def test_rules_of_one_well(spark):
    df = readings(spark, {"well_id": "a", "water_cut": 50.0}, {"well_id": "b", "water_cut": 50.0})
    rules = spark.createDataFrame(
        [("a", "water_cut", "max", 40.0, "critical"), ("b", "water_cut", "min", 60.0, "warning")],
        "well_id string, field string, kind string, threshold double, severity string",
    )
    got = {(r.well_id, r.type, r.severity) for r in detect_with_rule_table(df, rules).collect()}
    assert got == {("a", "water_cut_high", "critical"), ("b", "water_cut_low", "warning")}


def test_rules_of_a_well_replace_the_default(spark):
    df = readings(
        spark,
        {"well_id": "a", "water_cut": 50.0, "sand_rate": 45.0},
        {"well_id": "b", "water_cut": 90.0},
        {"well_id": None, "water_cut": 90.0},
    )
    rules = spark.createDataFrame(
        [
            (None, "water_cut", "max", 85.0, "warning"),
            (None, "sand_rate", "max", 40.0, "warning"),
            ("a", "water_cut", "max", 40.0, "critical"),
        ],
        "well_id string, field string, kind string, threshold double, severity string",
    )
    got = {(r.well_id, r.type, r.severity) for r in detect_with_rule_table(df, rules).collect()}
    assert got == {
        ("a", "water_cut_high", "critical"),
        ("a", "sand_rate_high", "warning"),
        ("b", "water_cut_high", "warning"),
        (None, "water_cut_high", "warning"),
    }


@pytest.mark.parametrize(
    "rule", [("water_cut", "MAX", 1.0), ("watercut", "max", 1.0), ("water_cut", "max", None), (None, "max", 1.0)]
)
def test_rules_that_cannot_be_applied_are_errors(spark, rule):
    df = readings(spark, {"well_id": "a", "water_cut": 50.0})
    rules = spark.createDataFrame(
        [(*rule, "warning")], "field string, kind string, threshold double, severity string"
    )
    with pytest.raises(ValueError, match="rules"):
        detect_with_rule_table(df, rules)


def test_critical_rules_alone_give_the_same_alerts(mixed):
    df, _ = mixed
    columns = ["well_id", "anomaly_type", "value"]
    every = critical_alerts(detect_breaches(df)).select(columns)
    only = critical_alerts(detect_breaches(df, critical_rules())).select(columns)
    assert sorted(map(str, every.collect())) == sorted(map(str, only.collect()))
