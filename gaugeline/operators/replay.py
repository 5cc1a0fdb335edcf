"""Bring repaired dead letters back, each exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gaugeline.functions.joins import broadcast_within
from gaugeline.operators.parse import parse_messages
from gaugeline.operators.retention import LEDGER_DAYS
from gaugeline.schema import READING_SCHEMA, SOURCE_KEYS


def _as_messages(dead: DataFrame, repair: Column | None) -> DataFrame:
    text = F.col("raw") if repair is None else repair
    return dead.select(
        *SOURCE_KEYS, F.col("dead_ts").alias("timestamp"), text.cast("binary").alias("value")
    )


def replay_dead_letters(
    dead: DataFrame,
    landed: DataFrame,
    schema: StructType = READING_SCHEMA,
    repair: Column | None = None,
    required: str | None = "well_id",
    extra: str | None = None,
) -> DataFrame:
    """Readings of the dead letters that parse now and are not in ``landed`` yet.

    ``repair`` is the corrected text, by default the text as it came. Few dead letters face many
    landed rows: the dead keys go to the landed table first, so that table is not shuffled.
    """
    keys = list(SOURCE_KEYS)
    once = dead.dropDuplicates(keys)
    wanted = broadcast_within(dead.select(*keys))
    already = landed.select(*keys).join(wanted, keys, "left_semi")
    new = _as_messages(once.join(already, keys, "left_anti"), repair)
    return parse_messages(new, schema, required, extra)


def replay_stream(
    dead: DataFrame,
    schema: StructType = READING_SCHEMA,
    repair: Column | None = None,
    required: str | None = "well_id",
    remember: str = f"{LEDGER_DAYS} days",
    seen: Column | None = None,
) -> DataFrame:
    """Streaming form: a dead letter delivered again within ``remember`` is dropped.

    The state holds the position of a letter from when it is seen, by default the time of its batch,
    and forgets it once that is over, so its size follows the letters of that time and not all there ever
    were. Letters are kept for less, so one that could come again is remembered. What is compared with the
    watermark is when letters are seen, which never falls back: none is too late, however old it is.
    """
    seen = F.current_timestamp() if seen is None else seen
    once = (
        dead.withColumn("_seen", seen)
        .withWatermark("_seen", remember)
        .dropDuplicatesWithinWatermark(list(SOURCE_KEYS))
    )
    return parse_messages(_as_messages(once, repair), schema, required)
