"""Threshold and time-range conditions as Columns."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime, timedelta, timezone
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType, TimestampType

from gaugeline.schema import RULES, Rule


def above(value: Column, limit: Column) -> Column:
    """value > limit, false for NaN. Spark sorts NaN above every number, so bound it from above too;
    unlike isnan() this still reaches the Parquet reader."""
    return (value > limit) & (value <= F.lit(float("inf")))


def breaches_rule(rule: Rule) -> Column:
    value = F.col(rule.field)
    limit = F.lit(float(rule.threshold))
    if rule.kind == "max":
        return above(value, limit)
    if rule.kind == "min":
        return value < limit
    raise ValueError(f"rule kind must be 'max' or 'min', not {rule.kind!r}")


def breaches_any(rules: Iterable[Rule] = RULES) -> Column:
    return reduce(or_, [breaches_rule(rule) for rule in rules])


def _in_utc(at: datetime) -> datetime:
    return at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at.astimezone(timezone.utc)


def time_bound(df: DataFrame, time_col: str, at: datetime) -> Column:
    """A literal of the column's own type, so the comparison needs no cast and is pushed to the scan."""
    at = _in_utc(at)
    column_type = df.schema[time_col].dataType
    text = at.replace(tzinfo=None).isoformat(sep=" ")
    if not isinstance(column_type, TimestampNTZType):
        text += "+00:00"
    return F.lit(text).cast(column_type)


def utc_day(time: Column) -> Column:
    """The day of a TIMESTAMP in UTC, in every session zone."""
    return F.date_from_unix_date(F.floor(F.unix_micros(time) / 86_400_000_000).cast("int"))


def day_of(df: DataFrame, time: Column, like: str) -> Column:
    """The UTC day of a time of the same type as column ``like``."""
    if isinstance(df.schema[like].dataType, TimestampType):
        return utc_day(time)
    return F.to_date(time)


def within(df: DataFrame, time_col: str, as_of: datetime, width: timedelta) -> Column:
    """as_of - width <= time < as_of."""
    return (F.col(time_col) >= time_bound(df, time_col, as_of - width)) & (
        F.col(time_col) < time_bound(df, time_col, as_of)
    )


def recent(
    df: DataFrame, time_col: str, as_of: datetime, width: timedelta, day_col: str = "date"
) -> DataFrame:
    """Rows within the range. A table kept in folders by event day is read from those days only."""
    rows = df.filter(within(df, time_col, as_of, width))
    if time_col == "ts" and day_col in df.columns:
        first, last = (F.lit(_in_utc(at).date()) for at in (as_of - width, as_of))
        rows = rows.filter(F.col(day_col).between(first, last))
    return rows
