"""Text forms of numbers and times used in alerts and messages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_text(value: Column) -> Column:
    """A double in plain decimal notation, with at least one decimal: 95.0, 12345678.5, 0.00025.
    Sizes beyond 1e37 and below 1e-20 keep their exponent."""
    text = value.cast("string")
    size = F.abs(value)
    plain = F.rtrim(text.cast("decimal(38,21)").cast("string"), F.lit("0"))
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    # Java writes an exponent outside 1e-3 to 1e7; a decimal of 38 digits holds what is in between.
    in_scientific = ((size >= 1e-6) & (size < 1e-3)) | ((size >= 1e7) & (size < 1e17))
    whole = F.concat(text.cast("decimal(38,0)").cast("string"), F.lit(".0"))
    tiny = F.rtrim(text.cast("decimal(38,37)").cast("string"), F.lit("0"))
    return (
        F.when(in_scientific, plain)
        .when((size >= 1e17) & (size < 1e37), whole)
        .when((size > 0) & (size < 1e-6) & (size > 1e-20), tiny)
        .otherwise(text)
    )


def limit_text(threshold: Column) -> Column:
    """A threshold as written in the rules: whole limits without decimals."""
    whole = (threshold == F.floor(threshold)) & (F.abs(threshold) < 1e15)
    return F.when(whole, threshold.cast("bigint").cast("string")).otherwise(number_text(threshold))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 text in UTC for a TIMESTAMP of a UTC session or a TIMESTAMP_NTZ holding UTC."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.date_format(ts, "SSSSSS")
    return F.concat(
        seconds, F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros)), F.lit("+00:00")
    )
