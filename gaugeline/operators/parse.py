"""Kafka messages to typed readings; whatever cannot be read becomes a dead letter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StringType, StructField, StructType, VariantType

from gaugeline.functions.once import with_column_once
from gaugeline.schema import READING_SCHEMA, SOURCE_KEYS

_CORRUPT = "_corrupt_record"
RAW_ROUTE = "raw"
DEAD_ROUTE = "dead_letter"
#: Fields that a schema does not have, by name.
EXTRA_TYPE = MapType(StringType(), VariantType())


def _from_json(text: Column, schema: StructType) -> Column:
    # Naming the corrupt-record column keeps the optimizer from pruning the JSON schema, which
    # would hide mistyped fields and parse the text once per used column.
    with_corrupt = StructType([*schema.fields, StructField(_CORRUPT, StringType())])
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": _CORRUPT,
        "allowSingleQuotes": "false",
    }
    return F.from_json(text, with_corrupt, options)


def _is_whole(text: Column) -> Column:
    """False when something follows the JSON object, which from_json ignores.

    A flat message has its only brace at its end and passes at once; comparing byte counts is
    cheaper than finding a character. Others are parsed as the first of two elements of an array.
    The second is a digest of the text, which the text cannot hold itself: it is found in its
    place only if the object ends where the text does.
    """
    without_braces = F.octet_length(F.replace(text, F.lit("}"), F.lit("")))
    flat = text.endswith("}") & (without_braces + 1 == F.octet_length(text))
    digest = F.sha2(text.cast("binary"), 256)
    array = F.concat(F.lit("["), text, F.lit(',"'), digest, F.lit('"]'))
    elements = F.from_json(array, "array<string>")
    marked = (F.size(elements) == 2) & (F.get(elements, F.lit(1)) == digest)
    return flat | F.coalesce(marked, F.lit(False))


def _undeclared(text: Column, schema: StructType) -> Column:
    """The fields that the schema does not have, null if there are none. Names alone are read first; values are
    for the messages that have such fields."""
    declared = F.array(*map(F.lit, schema.names))
    more = F.size(F.array_except(F.json_object_keys(text), declared)) > 0
    values = F.from_json(text, EXTRA_TYPE, {"allowSingleQuotes": "false"})
    return F.when(more, F.map_filter(values, lambda name, _: ~F.array_contains(declared, name)))


def route_messages(
    messages: DataFrame,
    schema: StructType = READING_SCHEMA,
    required: str | None = "well_id",
    extra: str | None = None,
) -> DataFrame:
    """Parse every message once. Adds the schema's columns, the source position, ingest_ts, the
    original text of dead letters in ``raw`` with the reason in ``error``, and ``route``. With ``extra``, a column of
    that name holds the fields of good messages that the schema does not have, as variants by name; null
    if there are none."""
    text = F.col("value").cast("string")
    source = messages.select(
        *SOURCE_KEYS, F.col("timestamp").alias("ingest_ts"), text.alias("raw")
    )
    raw = F.col("raw")
    # Everything that reads JSON goes into this one column, so that the filters and columns on
    # top of it are compiled.
    others = [_undeclared(raw, schema).alias("others")] if extra else []
    read = F.struct(_from_json(raw, schema).alias("d"), _is_whole(raw).alias("whole"), *others)
    parsed = with_column_once(source, "read", read)
    d, whole = F.col("read.d"), F.col("read.whole")
    parses = d.isNotNull() & d[_CORRUPT].isNull()
    present = F.lit(True)
    if required:
        present = d[required].isNotNull()
        if isinstance(schema[required].dataType, StringType):
            present = present & (d[required] != "")
    # One test lets good messages through; reasons are worked out for the others only.
    good = F.coalesce(parses & present & F.is_valid_utf8(raw) & whole, F.lit(False))
    error = (
        F.when(good, F.lit(None))
        .when(raw.isNull() | (F.trim(raw) == ""), "empty message")
        .when(~F.is_valid_utf8(raw), "invalid UTF-8")
        .when(~parses, "malformed or mistyped JSON")
        .when(~whole, "text after the JSON object")
        .otherwise(f"missing {required}")
    )
    return parsed.select(
        *[d[name].alias(name) for name in schema.names],
        *([F.when(good, F.col("read.others")).alias(extra)] if extra else []),
        *SOURCE_KEYS,
        "ingest_ts",
        F.when(~good, raw).alias("raw"),
        error.alias("error"),
        F.when(good, RAW_ROUTE).otherwise(DEAD_ROUTE).alias("route"),
    )


def with_event_time(df: DataFrame, text_col: str = "timestamp") -> DataFrame:
    """Add ``ts``, the event time, or null where the text is no timestamp. Text without a zone is
    in UTC, whatever the zone of the session."""
    text = F.trim(text_col)
    zoned = F.substring(text, 11, 64).rlike("[A-SU-Za-z+-]")
    in_utc = F.when(F.length(text) <= 10, F.concat(text, F.lit("T00:00:00Z"))).otherwise(
        F.concat(text, F.lit("Z"))
    )
    return df.withColumn("ts", F.try_to_timestamp(F.when(zoned, text).otherwise(in_utc)))


def good_readings(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == RAW_ROUTE).drop("raw", "error", "route")


def parse_messages(
    messages: DataFrame,
    schema: StructType = READING_SCHEMA,
    required: str | None = "well_id",
    extra: str | None = None,
) -> DataFrame:
    """Typed readings of the messages that can be read, with their source position."""
    readings = good_readings(route_messages(messages, schema, required, extra))
    return with_event_time(readings) if "timestamp" in schema.names else readings


def dead_letters(
    messages: DataFrame, schema: StructType = READING_SCHEMA, required: str | None = "well_id"
) -> DataFrame:
    """The messages that cannot be read, as (raw, error, dead_ts, topic, partition, offset)."""
    return as_dead_letters(route_messages(messages, schema, required))


def as_dead_letters(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("route") == DEAD_ROUTE).select(
        "raw", "error", F.col("ingest_ts").alias("dead_ts"), *SOURCE_KEYS
    )
