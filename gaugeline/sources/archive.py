"""Partitioned Parquet tables of readings, anomalies, points, breaches and dead letters."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, IntegerType, StructField, StructType

from gaugeline.functions.predicates import day_of
from gaugeline.session import read_note, write_note
from gaugeline.sources.days import counting, read_days

# One folder per day and well suits fleets whose wells fill a file a day. Larger fleets use the
# bucket layout: a fixed number of folders a day, and wells are found by bucket, then by the
# Parquet statistics and filters on well_id.
WELL_LAYOUT = ("date", "well_id")
BUCKET_LAYOUT = ("date", "well_bucket")
BUCKETS = 16
# File streams forget files this much older than the newest one. The default of a week would skip
# late deliveries without a word.
MAX_FILE_AGE = "36500d"
_BUCKETS_FILE = "_buckets"


def well_bucket(well: Column, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(well), F.lit(buckets)).cast("int")


def with_partitions(
    df: DataFrame, time_col: str = "ts", fallback: str | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """Add ``date`` (event day in UTC, or the day of ``fallback`` where the event time is unknown)
    and ``well_bucket``."""
    event_time = F.col(time_col) if fallback is None else F.coalesce(time_col, fallback)
    day = day_of(df, event_time, time_col)
    return df.withColumns({"date": day, "well_bucket": well_bucket(F.col("well_id"), buckets)})


def clustered(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Bring rows of one folder together before a write, so that files are few. AQE merges small
    partitions and splits hot ones, so a well with a third of all rows fills many tasks."""
    return df.hint("rebalance", *columns)


def fix_buckets(spark: SparkSession, path: str, buckets: int) -> None:
    """Store the number of buckets beside a table when it is first written, and refuse another."""
    note = f"{path.rstrip('/')}/{_BUCKETS_FILE}"
    if read_note(spark, note) is None:
        write_note(spark, note, str(buckets))
    stored = stored_buckets(spark, path)
    if stored != buckets:
        raise ValueError(f"{path} has {stored} buckets, not {buckets}")


def stored_buckets(spark: SparkSession, path: str) -> int:
    stored = read_note(spark, f"{path.rstrip('/')}/{_BUCKETS_FILE}")
    if stored is None:
        raise ValueError(f"no number of buckets is stored with {path}")
    return int(stored)


def archive_schema(schema: StructType) -> StructType:
    """A schema to read a table back with: partition values keep their declared types."""
    extra = [StructField("date", DateType()), StructField("well_bucket", IntegerType())]
    return StructType([*schema.fields, *(f for f in extra if f.name not in schema.names)])


def write_archive(
    df: DataFrame,
    path: str,
    partition_by: Sequence[str] = WELL_LAYOUT,
    mode: str = "append",
    sort_by: Sequence[str] = ("well_id", "ts"),
    buckets: int = BUCKETS,
) -> None:
    """Write a batch. Rows are sorted within each file, so a read of some wells skips the other
    row groups; the sort by folder, which the writer needs anyway, is part of it."""
    order = [*partition_by, *(c for c in sort_by if c in df.columns and c not in partition_by)]
    rows = clustered(df, partition_by).sortWithinPartitions(*order)
    if "well_bucket" in partition_by and mode == "append":
        fix_buckets(df.sparkSession, path, buckets)
    rows.write.mode(mode).partitionBy(*partition_by).parquet(path)
    if "well_bucket" in partition_by and mode != "append":
        fix_buckets(df.sparkSession, path, buckets)


def _partitions_last(schema: StructType, partition_by: Sequence[str]) -> StructType:
    """Spark puts partition columns behind the others once it finds their folders. A stream that
    starts on an empty folder must use that order from the beginning, since its columns are
    matched by position."""
    data = [f for f in schema.fields if f.name not in partition_by]
    return StructType([*data, *(schema[name] for name in partition_by)])


def read_files(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """All rows in the files of a table, with ``_metadata``."""
    return spark.read.schema(_partitions_last(schema, partition_by)).parquet(path)


def read_table(
    spark: SparkSession, path: str, schema: StructType, partition_by: Sequence[str] = ()
) -> DataFrame:
    """A table without the days that retention has taken out."""
    files = read_files(spark, path, schema, partition_by)
    return counting(files, read_days(spark, path)).select(*schema.names)


def stream_files(
    spark: SparkSession,
    path: str,
    schema: StructType,
    partition_by: Sequence[str] = (),
    max_files: int = 1000,
) -> DataFrame:
    """A table as a stream of its files, with ``_metadata``."""
    reader = spark.readStream.schema(_partitions_last(schema, partition_by))
    return (
        reader.option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(path)
    )


def for_wells(df: DataFrame, wells: Sequence[str | int], path: str | None = None) -> DataFrame:
    """Rows of some wells; with the path of a table in the bucket layout, of their folders only."""
    chosen = df.filter(F.col("well_id").isin(list(wells)))
    if path is None:
        return chosen
    buckets = stored_buckets(df.sparkSession, path)
    well_type = df.schema["well_id"].dataType
    folders = [F.col("well_bucket") == well_bucket(F.lit(w).cast(well_type), buckets) for w in wells]
    return chosen.filter(reduce(or_, folders))


def for_days(df: DataFrame, first: date | None = None, last: date | None = None) -> DataFrame:
    if first is not None:
        df = df.filter(F.col("date") >= F.lit(first))
    if last is not None:
        df = df.filter(F.col("date") <= F.lit(last))
    return df
