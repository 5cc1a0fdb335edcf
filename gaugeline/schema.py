"""Record layouts, threshold rules and baselines of well telemetry."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql.types import (
    BinaryType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

# The 17 sensor columns, in record order.
SENSORS = (
    "oil_flow_rate",
    "gas_flow_rate",
    "water_flow_rate",
    "wellhead_pressure",
    "bottomhole_pressure",
    "casing_pressure",
    "tubing_pressure",
    "wellhead_temperature",
    "bottomhole_temperature",
    "choke_size",
    "water_cut",
    "gas_oil_ratio",
    "pump_speed",
    "motor_current",
    "vibration_level",
    "sand_rate",
    "h2s_concentration",
)


class Rule(NamedTuple):
    """A strict limit on one field: breached above a max, or below a min."""

    field: str
    kind: str
    threshold: float
    severity: str

    @property
    def type(self) -> str:
        return f"{self.field}_high" if self.kind == "max" else f"{self.field}_low"


# The seven threshold rules.
RULES = (
    Rule("h2s_concentration", "max", 10, "critical"),
    Rule("vibration_level", "max", 8, "critical"),
    Rule("wellhead_pressure", "min", 400, "critical"),
    Rule("water_cut", "max", 85, "warning"),
    Rule("motor_current", "min", 1, "critical"),
    Rule("sand_rate", "max", 40, "warning"),
    Rule("casing_pressure", "max", 500, "critical"),
)

# Normal level of each sensor per well, in the order of SENSORS.
BASELINES = {
    "WELL-AB-001": (250, 500, 80, 850, 3200, 200, 750, 35, 95, 32, 24, 2000, 8, 45, 2.5, 5, 3),
    "WELL-AB-002": (180, 620, 150, 720, 2800, 180, 650, 38, 102, 28, 45, 3400, 10, 52, 3.1, 8, 5),
    "WELL-AB-003": (420, 380, 40, 980, 3600, 220, 880, 32, 88, 40, 9, 900, 6, 38, 1.8, 3, 1),
    "WELL-AB-004": (95, 820, 220, 580, 2200, 160, 500, 42, 110, 24, 70, 8600, 12, 60, 4.2, 12, 8),
    "WELL-AB-005": (310, 450, 110, 790, 3000, 190, 700, 36, 98, 36, 26, 1450, 9, 48, 2.8, 6, 4),
}

# Labels that mark a reading taken during a known fault.
FAULT_LABELS = (
    "pressure_drop",
    "vibration_spike",
    "h2s_leak",
    "pump_failure",
    "water_cut_surge",
    "gas_breakthrough",
    "sand_erosion",
    "casing_integrity_loss",
)

READING_SCHEMA = StructType(
    [
        StructField("well_id", StringType()),
        StructField("timestamp", StringType()),
        StructField("well_status", StringType()),
        *(StructField(sensor, DoubleType()) for sensor in SENSORS),
        StructField("anomaly_type", StringType()),
    ]
)

# What Spark's Kafka source delivers.
MESSAGE_SCHEMA = StructType(
    [
        StructField("key", BinaryType()),
        StructField("value", BinaryType()),
        StructField("topic", StringType()),
        StructField("partition", IntegerType()),
        StructField("offset", LongType()),
        StructField("timestamp", TimestampType()),
        StructField("timestampType", IntegerType()),
    ]
)

# Identity of a message; unique per record.
SOURCE_KEYS = ("topic", "partition", "offset")
