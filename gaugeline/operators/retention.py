"""Retention: read views without expired rows, and removal of expired days."""

from __future__ import annotations

from collections.abc import Collection
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.predicates import time_bound
from gaugeline.sources.days import GRACE, clear_days, day_folders, newest_files, note_days, read_days

# Days kept.
POINT_DAYS = 7
ARCHIVE_DAYS = {"dev": 7, "other": 90}
DEAD_LETTER_DAYS = 14
# Not fixed: replayed positions are remembered longer than the letters that could return.
LEDGER_DAYS = DEAD_LETTER_DAYS + 7


def retain(df: DataFrame, time_col: str, days: int, as_of: datetime) -> DataFrame:
    """Rows with time >= as_of - days."""
    return df.filter(F.col(time_col) >= time_bound(df, time_col, as_of - timedelta(days=days)))


def first_kept_day(days: int, as_of: datetime) -> date:
    return (as_of - timedelta(days=days)).date()


def expired_partitions(spark: SparkSession, path: str, days: int, as_of: datetime) -> list[str]:
    """date=... folders of a table, at its root or below one partition level, that end before
    as_of - days and have files that still count."""
    return sorted(folder for found in _expired(spark, path, days, as_of).values() for folder in found[1])


def _expired(
    spark: SparkSession, path: str, days: int, as_of: datetime
) -> dict[date, tuple[int, list[str]]]:
    """Newest file and folders of the expired days that have files which still count."""
    first_kept, noted = first_kept_day(days, as_of), read_days(spark, path)
    found = {}
    for day, folders in day_folders(spark, path).items():
        if day < first_kept:
            newest = newest_files(spark, folders)
            if newest is not None and (day not in noted or newest > noted[day].upto):
                found[day] = (newest, folders)
    return found


def drop_expired(
    spark: SparkSession,
    path: str,
    days: int,
    as_of: datetime,
    keep: Collection[date] = (),
    grace: timedelta = GRACE,
) -> list[str]:
    """Take expired days but those in ``keep`` out of a table that batch jobs write, and return their
    folders, for the job's log. Reads that start later leave them out; files are deleted once the grace period
    is over, by this call or a later one."""
    gone = {d: f for d, f in _expired(spark, path, days, as_of).items() if d not in set(keep)}
    if gone:
        note_days(spark, path, {day: newest for day, (newest, _) in gone.items()})
    clear_days(spark, path, grace)
    return sorted(folder for _, folders in gone.values() for folder in folders)
