"""The given tables seen as readings, messages and points.

Expressions that appear both here and in the check SQL are written so that Spark and ANSI
databases read them alike (1e2 is a double in both).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeline.functions.once import with_column_once
from gaugeline.schema import BASELINES, FAULT_LABELS, READING_SCHEMA, SENSORS, Rule
from gaugeline.session import file_system
from gaugeline.sources.archive import MAX_FILE_AGE

LINE_SENSORS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_RULES = (
    Rule("l_quantity", "max", 49, "critical"),
    Rule("l_discount", "max", 0.09, "warning"),
    Rule("l_extendedprice", "min", 1000, "critical"),
    Rule("l_tax", "max", 0.07, "warning"),
)

EVENT_TYPES = ("click", "error", "purchase", "signup", "view")

# All columns of a reading from the columns of events and k, the number in props.
WELL_COLUMNS = {
    "well_id": "CASE event_type "
    + " ".join(f"WHEN '{e}' THEN '{w}'" for e, w in zip(EVENT_TYPES, BASELINES, strict=True))
    + " END",
    "timestamp": "concat(replace(CAST(ts AS STRING), ' ', 'T'), '+00:00')",
    "well_status": "CASE WHEN k < 90 THEN 'producing' WHEN k < 95 THEN 'shut-in' END",
    "oil_flow_rate": "value * 2e0",
    "gas_flow_rate": "value + 3e2",
    "water_flow_rate": "k * 3e0",
    "wellhead_pressure": "395e0 + value",
    "bottomhole_pressure": "2e3 + value * 4e0",
    "casing_pressure": "1e2 + k * 405e-2",
    "tubing_pressure": "4e2 + value",
    "wellhead_temperature": "2e1 + k / 1e1",
    "bottomhole_temperature": "8e1 + k / 5e0",
    "choke_size": "k * 1e0",
    "water_cut": "k * 88e-2",
    "gas_oil_ratio": "value * 2e1",
    "pump_speed": "5e0 + k / 2e1",
    "motor_current": "k * 5e-1",
    "vibration_level": "value / 25e0",
    "sand_rate": "k * 41e-2",
    "h2s_concentration": "CASE WHEN k % 7 <> 3 THEN value / 2e1 END",
    "anomaly_type": "CASE k % 20 "
    + " ".join(f"WHEN {i} THEN '{label}'" for i, label in enumerate(FAULT_LABELS))
    + " END",
}
assert list(WELL_COLUMNS) == READING_SCHEMA.names and set(SENSORS) < set(WELL_COLUMNS)

# Damage done to the messages, all of which are still read: every 97th is cut off after four
# characters, or has one number written as text.
DAMAGED = "event_id % 97 = 0"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str, max_files: int = 1000) -> DataFrame:
    """A table as a file stream, whether it is a folder of files or a single file."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files)
    reader = reader.option("maxFileAge", MAX_FILE_AGE)
    fs, hadoop_path = file_system(spark, path)
    if fs.getFileStatus(hadoop_path).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def line_readings(lineitem: DataFrame) -> DataFrame:
    return lineitem.select(
        F.col("l_suppkey").cast("string").alias("well_id"),
        F.col("l_returnflag").alias("well_status"),
        F.col("l_shipdate").alias("ts"),
        *LINE_SENSORS,
    )


def well_readings(events: DataFrame) -> DataFrame:
    """Full readings, with the event's own ts and id."""
    numbered = with_column_once(events, "k", F.get_json_object("props", "$.k").cast("int"))
    return numbered.select(
        "event_id", "ts", *[F.expr(sql).alias(name) for name, sql in WELL_COLUMNS.items()]
    )


def as_messages(rows: DataFrame, value: Column, key: str, topic: str) -> DataFrame:
    """Kafka-shaped rows; the event id is the offset."""
    return rows.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def cut_off(text: Column) -> Column:
    return F.when(F.expr(DAMAGED), F.substring(text, 1, 4)).otherwise(text)


def text_after(text: Column) -> Column:
    """Something after the object: for every 97th message a bracket and more, or another object."""
    more = F.when(F.expr("event_id % 2 = 0"), F.lit("] x")).otherwise(F.concat(F.lit("]"), text))
    return F.when(F.expr(DAMAGED), F.concat(text, more)).otherwise(text)


def number_quoted(field: str) -> Callable[[Column], Column]:
    def damage(text: Column) -> Column:
        quoted = F.regexp_replace(text, rf'("{field}"): ?(-?[0-9][0-9.eE+-]*)', r'$1:"$2"')
        return F.when(F.expr(DAMAGED), quoted).otherwise(text)

    return damage


def numbers_unquoted(text: Column) -> Column:
    """Repair of number_quoted."""
    return F.regexp_replace(text, r':"(-?[0-9][0-9.eE+-]*)"', ":$1")


def _untouched(text: Column) -> Column:
    return text


def event_messages(
    events: DataFrame, damage: Callable[[Column], Column] = _untouched
) -> DataFrame:
    return as_messages(events, damage(F.col("props")), "user_id", "events")


def well_messages(events: DataFrame, damage: Callable[[Column], Column] = _untouched) -> DataFrame:
    text = F.to_json(F.struct(*READING_SCHEMA.names))
    return as_messages(well_readings(events), damage(text), "well_id", "readings")


def extended_messages(events: DataFrame) -> DataFrame:
    """Well messages of which every fifth has two fields more, one of them nested."""
    more = F.expr("event_id % 5 = 0")
    rows = well_readings(events).select(
        "*",
        F.when(more, F.concat(F.lit("v"), (F.col("event_id") % 3).cast("string"))).alias("firmware"),
        F.when(more, F.struct((F.col("event_id") * 5e-1).alias("volts"))).alias("battery"),
    )
    text = F.to_json(F.struct(*READING_SCHEMA.names, "firmware", "battery"))
    return as_messages(rows, text, "well_id", "readings")


EVENT_MESSAGE_SCHEMA = StructType().add("k", "long")
