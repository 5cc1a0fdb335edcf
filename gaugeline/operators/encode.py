"""Records as keyed JSON messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.text import iso_utc

# The default formats stop at milliseconds.
_JSON = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def to_messages(
    readings: DataFrame, key: str = "well_id", columns: Sequence[str] | None = None
) -> DataFrame:
    """(key, value) as UTF-8 bytes. Null columns are left out of the JSON."""
    names = list(columns or readings.columns)
    return readings.select(
        F.encode(F.col(key).cast("string"), "UTF-8").alias("key"),
        F.encode(F.to_json(F.struct(*names), _JSON), "UTF-8").alias("value"),
    )


def dead_letter_messages(dead: DataFrame) -> DataFrame:
    """Dead letters as JSON {reading, error, timestamp}, to publish on a topic of their own."""
    body = F.struct(F.col("raw").alias("reading"), "error", iso_utc(F.col("dead_ts")).alias("timestamp"))
    return dead.select(F.encode(F.to_json(body), "UTF-8").alias("value"))
