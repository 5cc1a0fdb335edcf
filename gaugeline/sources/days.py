"""Days of a table whose files no longer count, because they are expired or were rewritten.

Nothing is deleted before readers know of it. First a note is written, and every reader that
starts later leaves the noted files out. Files are deleted after a grace period, in which readers that have
begun can finish. A run that ends between the two is finished by the next.

A note is for a day and holds the modification time of the newest file that no longer counts. A file
that comes for the day later counts, whatever its day. So batches of one table have to be further apart
than the resolution of file times. A noted day may have a `generation`: a folder of rewritten rows that count
instead. The switch from one to the other is the write of one file, so no reader sees both or none.

Notes are JSON in numbered files under `_days` in the table's folder; the highest number counts. One
job at a time may write the notes of a table.
"""

from __future__ import annotations

import json
import time
from collections.abc import Collection, Iterator
from dataclasses import asdict, dataclass, replace
from datetime import date, timedelta
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.session import file_system, read_latest, write_latest

#: How long files stay once they no longer count. Longer than any read of the table takes.
GRACE = timedelta(days=1)
_NOTES = "_days"


@dataclass(frozen=True)
class Day:
    #: Modification time, in milliseconds, of the newest file that no longer counts.
    upto: int
    #: When that was noted, in seconds.
    noted: float
    generation: str | None = None
    #: Whether the files are deleted.
    cleared: bool = False


Days = dict[date, Day]


def read_days(spark: SparkSession, path: str) -> Days:
    text = read_latest(spark, f"{path.rstrip('/')}/{_NOTES}")
    if text is None:
        return {}
    return {date.fromisoformat(day): Day(**noted) for day, noted in json.loads(text).items()}


def write_days(spark: SparkSession, path: str, days: Days) -> None:
    text = json.dumps({day.isoformat(): asdict(noted) for day, noted in sorted(days.items())})
    write_latest(spark, f"{path.rstrip('/')}/{_NOTES}", text)


def note_days(
    spark: SparkSession, path: str, upto: dict[date, int], generations: dict[date, str] | None = None
) -> None:
    """Note that files of these days up to these times no longer count, and what counts instead."""
    days, now = read_days(spark, path), time.time()
    for day, newest in upto.items():
        before = days[day].upto if day in days else newest
        days[day] = Day(max(newest, before), now, (generations or {}).get(day))
    write_days(spark, path, days)


def file_day(folder: str = "") -> Column:
    """The day of a file by its path, null for files in another folder of the table. Made of the file's path alone, so
    that files are left out when they are listed and never opened."""
    place = F.regexp_extract("_metadata.file_path", f"{folder}/date=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", 1)
    return F.when(place != "", place)


def _by_day(values: dict[date, int], folder: str) -> Column:
    entries = [F.lit(x) for day, value in sorted(values.items()) for x in (day.isoformat(), value)]
    return F.try_element_at(F.create_map(*entries).cast("map<string,bigint>"), file_day(folder))


def modified() -> Column:
    return F.unix_millis("_metadata.file_modification_time")


def counting(files: DataFrame, days: Days, folder: str = "") -> DataFrame:
    """Rows of the files that still count. `files` is a table as it was read, which has `_metadata`."""
    if not days:
        return files
    # files newer than all notes, which most are, pass with one comparison
    newest = max(noted.upto for noted in days.values())
    bound = _by_day({day: noted.upto for day, noted in days.items()}, folder)
    return files.filter((modified() > newest) | (modified() > F.coalesce(bound, F.lit(-1))))


def up_to(files: DataFrame, upto: dict[date, int], folder: str = "") -> DataFrame:
    """Rows of the files of these days that are not newer than these times."""
    bound = _by_day(upto, folder)
    return files.filter(modified() <= F.coalesce(bound, F.lit(-1)))


def _walk(fs, path) -> Iterator:
    found = fs.listFiles(path, True)
    while found.hasNext():
        yield found.next()


def day_folders(spark: SparkSession, path: str) -> dict[date, list[str]]:
    """date=... folders of a table by day, at its root or below one partition level. Lists folders
    only; never looks below names that start with an underscore."""
    fs, root = file_system(spark, path)
    if not fs.exists(root):
        return {}
    statuses = []
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if not status.isDirectory() or name.startswith(("_", ".")):
            continue
        if name.startswith("date="):
            statuses.append(status)
        elif "=" in name:
            statuses.extend(
                s for s in fs.listStatus(status.getPath())
                if s.isDirectory() and s.getPath().getName().startswith("date=")
            )
    found: dict[date, list[str]] = {}
    for status in statuses:
        value = unquote(status.getPath().getName().removeprefix("date="))
        try:
            day = date.fromisoformat(value)
        except ValueError:
            continue  # the null partition holds rows without a date: nothing says they are old
        found.setdefault(day, []).append(status.getPath().toString())
    return found


def newest_files(spark: SparkSession, folders: Collection[str]) -> int | None:
    """Modification time of the newest file in some folders, None if they have none."""
    newest = None
    for folder in folders:
        fs, path = file_system(spark, folder)
        for status in _walk(fs, path):
            newest = max(newest or 0, status.getModificationTime())
    return newest


def _remove_empty(fs, path) -> None:
    """Remove folders without files, leaf by leaf. Never removes a file that came in between."""
    for status in fs.listStatus(path):
        if status.isDirectory():
            _remove_empty(fs, status.getPath())
    if not fs.listStatus(path):
        fs.delete(path, False)


def clear_days(
    spark: SparkSession,
    path: str,
    grace: timedelta = GRACE,
    rewritten: str | None = None,
) -> list[str]:
    """Delete the files that no longer count since the grace period, and return their day folders.
    `rewritten` is the folder with the generations of rewritten days."""
    days, folders = read_days(spark, path), day_folders(spark, path)
    due = time.time() - grace.total_seconds()
    done = []
    for day, noted in sorted(days.items()):
        if noted.cleared or noted.noted > due:
            continue
        for folder in folders.get(day, ()):
            fs, hadoop_path = file_system(spark, folder)
            for status in list(_walk(fs, hadoop_path)):
                if status.getModificationTime() <= noted.upto:
                    fs.delete(status.getPath(), False)
            _remove_empty(fs, hadoop_path)
            done.append(folder)
        if rewritten:
            fs, root = file_system(spark, f"{rewritten.rstrip('/')}/date={day.isoformat()}")
            if fs.exists(root):
                for status in fs.listStatus(root):
                    if status.getPath().getName() != f"gen={noted.generation}":
                        fs.delete(status.getPath(), True)
                _remove_empty(fs, root)
        days[day] = replace(noted, cleared=True)
    if done or any(noted.cleared for noted in days.values()):
        write_days(spark, path, days)
    return done
