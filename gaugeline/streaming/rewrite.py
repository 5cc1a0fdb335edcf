"""Rewriting of closed days: compaction, and backfill under other rules.

Streams write many small files. Once a day is closed, its rows are written again: in files of about
`FILE_BYTES`, in an order that lets reads skip most of them, with Bloom filters, and without a sink's log. A
note then makes the new rows count instead of the old files (`gaugeline.sources.days`). Readers see
one or the other, also while this runs and if it stops midway. Files that come for the day later count beside
the rewritten rows, and the next run takes them in.

Streams that read a table go on with the files of its sink: a day is only rewritten once all of them
have read it. A stream that is new starts with the files that still count; rows of rewritten
days come to it by a backfill.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.curves import interleaved
from gaugeline.operators.detect import detect_any, detect_breaches
from gaugeline.schema import Rule
from gaugeline.session import file_system, settings
from gaugeline.sources.archive import read_files
from gaugeline.sources.days import GRACE, clear_days, counting, note_days, read_days, up_to
from gaugeline.streaming import jobs

#: Size of a rewritten file, and of its row groups, which are what reads skip.
FILE_BYTES = 256 << 20
#: Bytes of rows, before Parquet packs them, that a task sorts and writes. Columns that repeat shrink a hundredfold in
#: Parquet, so the size of files does not bound the work of a task.
TASK_BYTES = 256 << 20
ROW_GROUP_BYTES = 16 << 20
#: Days that are still written to, counted back from the day of `as_of`.
OPEN_DAYS = 1
#: The tables that are rewritten.
FOLDERS = ("readings/route=raw", "replayed", "anomalies", "points", "breaches", "alerts")


def point_key(sensors: Sequence[str]) -> Column:
    """A place on a space-filling curve over field, time of day and well. Points near each other in these lie near
    each other, so a field over a short time is in few row groups. Fields count in the order of their names, in
    which Parquet keeps their least and greatest."""
    names = F.array(*map(F.lit, sorted(sensors)))
    field = F.floor(F.array_position(names, F.col("field")) * 1023 / len(sensors))
    # a day has 86,400 seconds: steps of about 84 seconds
    second = F.pmod(F.floor(F.unix_micros("ts") / 1_000_000), F.lit(86_400))
    time = F.coalesce(F.floor(second * 1024 / 86_400), F.lit(0))
    # panels ask for all wells more often than for one: wells divide what three halvings of both others leave
    well = F.pmod(F.xxhash64("well_id"), F.lit(128))
    return interleaved([field, time, well], bits=10)


def _order(table: str, rows: DataFrame) -> list[Column]:
    keys = ("_place", "ts") if table == "points" else ("well_id", "ts")
    return [F.col(c) for c in ("date", *keys) if c in rows.columns]


def bytes_of(rows: DataFrame) -> int:
    """About the bytes of rows in a shuffle: a word for each value and for the place of each string, and what the
    strings hold. Counted, since the size of Parquet files says little about it."""
    kinds = {f.name: f.dataType.typeName() for f in rows.schema.fields}
    texts = [F.octet_length(c) + 8 for c, kind in kinds.items() if kind in ("string", "binary")]
    texts += [F.octet_length(F.col(c).cast("string")) + 8 for c, kind in kinds.items() if kind == "variant"]
    each = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(16 + 8 * len(kinds)))
    return rows.agg(F.coalesce(F.sum(each.cast("bigint")), F.lit(0))).first()[0]


def _write(
    rows: DataFrame,
    pipeline: jobs.Pipeline,
    table: str,
    root: str,
    generation: str,
    files: int,
    row_group_bytes: int,
) -> None:
    """Rows in files of neighbouring rows. Partitions follow ranges of the order, so a well with a third of
    all rows fills many of them, and days without much share one."""
    if table == "points":
        rows = rows.withColumn("_place", point_key(pipeline.sensors))
    order = _order(table, rows)
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order).drop("_place")
    writer = (
        dealt.withColumn("gen", F.lit(generation))
        .write.mode("append")
        .option("parquet.block.size", row_group_bytes)
        .option("parquet.bloom.filter.enabled#well_id", "true")
        .option("parquet.bloom.filter.expected.ndv#well_id", 100_000)
        .partitionBy("date", "gen")
    )
    # Spark's default type for times has no least and greatest value in Parquet
    with settings(rows.sparkSession, spark__sql__parquet__outputTimestampType="TIMESTAMP_MICROS"):
        writer.parquet(root)


def _replace(
    spark: SparkSession,
    pipeline: jobs.Pipeline,
    folder: str,
    rows: DataFrame,
    upto: dict[date, int],
    size: int,
    file_bytes: int,
    row_group_bytes: int,
) -> None:
    """Write rows of some days and let them count instead of the files up to these times."""
    table, root = folder.partition("/")[0], jobs.rewritten_path(pipeline, folder)
    # a new name each time: what a run that stopped has left is never read
    generation = uuid.uuid4().hex
    files = max(1, round(size / file_bytes), -(-bytes_of(rows) // TASK_BYTES))
    _write(rows, pipeline, table, root, generation, files, row_group_bytes)
    made = {}
    for day in upto:
        fs, path = file_system(spark, f"{root}/date={day.isoformat()}/gen={generation}")
        if fs.exists(path):
            made[day] = generation
    note_days(spark, pipeline.path(folder), upto, made)


def compact(
    spark: SparkSession,
    pipeline: jobs.Pipeline,
    as_of: datetime,
    folders: Sequence[str] = FOLDERS,
    consumers: Collection[str] = ("anomalies", "points", "breaches", "alerts"),
    open_days: int = OPEN_DAYS,
    file_bytes: int = FILE_BYTES,
    row_group_bytes: int = ROW_GROUP_BYTES,
    grace: timedelta = GRACE,
) -> list[str]:
    """Rewrite the closed days that have files of the sink which count, and delete what no longer counts
    since the grace period. Returns the days that were rewritten. Run one such job at a time.

    Days with files that a stream in ``consumers`` has not read stay as they are.
    """
    closed = as_of.date() - timedelta(days=open_days)
    done = []
    for folder in folders:
        path, root = pipeline.path(folder), jobs.rewritten_path(pipeline, folder)
        days = read_days(spark, path)
        files = jobs.counted_files(jobs.files_of(spark, pipeline, folder), days)
        files = files.filter(F.col("day") < F.lit(closed))
        found = files.groupBy("day").agg(F.max("modified").alias("upto"), F.sum("size").alias("size")).collect()
        waiting = jobs.unread_days(spark, pipeline, folder, files, consumers) if found else set()
        sizes = {r["day"]: (r["upto"], r["size"]) for r in found if r["day"] not in waiting}
        if sizes:
            upto = {day: newest for day, (newest, _) in sizes.items()}
            rows, again = _rows_of(spark, pipeline, folder, upto)
            size = sum(size for _, size in sizes.values()) + again
            _replace(spark, pipeline, folder, rows, upto, size, file_bytes, row_group_bytes)
            done += [f"{path}/date={day.isoformat()}" for day in sorted(sizes)]
        clear_days(spark, path, grace, root)
    return done


def _rows_of(
    spark: SparkSession, pipeline: jobs.Pipeline, folder: str, upto: dict[date, int]
) -> tuple[DataFrame, int]:
    """Rows of some days that count, without files newer than these times, and the bytes of those that were
    rewritten before."""
    table, _, part = folder.partition("/")
    schema, days = pipeline.schema_of(table), read_days(spark, pipeline.path(folder))
    files = read_files(spark, pipeline.path(table), schema, pipeline.partition_by(table))
    rows = up_to(counting(files, days, part), upto, part).select(*schema.names)
    rows = rows.filter(F.col("date").isin(sorted(upto)))
    before = {day: noted for day, noted in days.items() if day in upto and noted.generation}
    earlier = jobs.read_rewritten(spark, pipeline, folder, before)
    if earlier is None:
        return rows, 0
    size = 0
    for day, noted in before.items():
        fs, path = file_system(
            spark, f"{jobs.rewritten_path(pipeline, folder)}/date={day.isoformat()}/gen={noted.generation}"
        )
        size += fs.getContentSummary(path).getLength()
    return rows.unionByName(earlier.select(*schema.names)), size


def backfill(
    spark: SparkSession,
    pipeline: jobs.Pipeline,
    first: date,
    last: date,
    rules: Sequence[Rule] | None = None,
    consumers: Collection[str] = ("anomalies", "breaches", "alerts"),
    file_bytes: int = FILE_BYTES,
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Detect again over the archived readings of some days, and put the result in place of these days
    of ``anomalies`` and ``breaches``, whole days at a time. It may run again, with the same or with other
    rules: a day has the rows of the last run only. Alerts that were made stay as they are.

    The streams in ``consumers`` have to have passed these days. Files that they write later, for late
    readings, count beside the new rows, and the next backfill replaces them.
    """
    rules = pipeline.rules if rules is None else rules
    raw = jobs.read_raw(spark, pipeline).filter(F.col("date").between(F.lit(first), F.lit(last)))
    keep = ("well_id", "ts", "ingest_ts", "topic", "partition", "offset", "date")
    made = {"anomalies": detect_any(raw, rules), "breaches": detect_breaches(raw, rules, keep)}
    span = [first + timedelta(days=i) for i in range((last - first).days + 1)]
    files = {
        folder: jobs.files_of(spark, pipeline, folder).filter(F.col("day").between(F.lit(first), F.lit(last)))
        for folder in ("readings/route=raw", "replayed", *made)
    }
    for folder, found in files.items():
        counted = jobs.counted_files(found, read_days(spark, pipeline.path(folder)))
        readers = [c for c in consumers if folder == "breaches" or c in made]
        if unread := jobs.unread_days(spark, pipeline, folder, counted, readers):
            raise ValueError(f"{folder} has files of {min(unread)} to {max(unread)} that a stream has to read")
    for table, rows in made.items():
        days = read_days(spark, pipeline.path(table))
        sums = files[table].groupBy("day").agg(F.max("modified").alias("upto"), F.sum("size").alias("size"))
        found = {r["day"]: r for r in sums.collect()}
        upto = {
            day: max(found[day]["upto"] if day in found else 0, days[day].upto if day in days else 0)
            for day in span
        }
        size = sum(r["size"] for r in found.values())
        rows = rows.select(*pipeline.schema_of(table).names)
        _replace(spark, pipeline, table, rows, upto, size, file_bytes, row_group_bytes)
