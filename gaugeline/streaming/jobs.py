"""The streaming pipeline. One query per table, each with its own checkpoint:

    messages -> readings (raw and dead letters) -> anomalies
                                                -> points
                                                -> breaches -> alerts

Messages are read and parsed once. Everything after that reads the ``readings`` table as a file
stream, where the detection filter reaches Parquet, so one more rule costs no more parsing.
"""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Collection, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, datetime, timedelta
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampType,
)

from gaugeline.operators.alerts import critical_alerts
from gaugeline.operators.coverage import label_coverage
from gaugeline.operators.detect import (
    detect_any,
    detect_breaches,
    detect_with_rule_table,
    rule_table,
)
from gaugeline.operators.parse import (
    EXTRA_TYPE,
    RAW_ROUTE,
    as_dead_letters,
    good_readings,
    route_messages,
    with_event_time,
)
from gaugeline.operators.points import to_points
from gaugeline.operators.replay import replay_dead_letters
from gaugeline.functions.predicates import utc_day
from gaugeline.operators.retention import (
    ARCHIVE_DAYS,
    DEAD_LETTER_DAYS,
    LEDGER_DAYS,
    POINT_DAYS,
    first_kept_day,
)
from gaugeline.schema import READING_SCHEMA, RULES, SENSORS, SOURCE_KEYS, Rule
from gaugeline.session import file_system, read_latest, write_latest
from gaugeline.sources.days import (
    GRACE,
    Days,
    clear_days,
    counting,
    note_days,
    read_days,
    write_days,
)
from gaugeline.streaming.batches import BatchTable
from gaugeline.streaming.progress import files_read, files_written
from gaugeline.sources.archive import (
    BUCKET_LAYOUT,
    BUCKETS,
    clustered,
    fix_buckets,
    read_files,
    stream_files,
    with_partitions,
    write_archive,
)

_SOURCE_FIELDS = [
    StructField("topic", StringType()),
    StructField("partition", IntegerType()),
    StructField("offset", LongType()),
]

BREACH_SCHEMA = StructType(
    [
        StructField("well_id", StringType()),
        StructField("ts", TimestampType()),
        StructField("ingest_ts", TimestampType()),
        *_SOURCE_FIELDS,
        StructField("field", StringType()),
        StructField("value", DoubleType()),
        StructField("threshold", DoubleType()),
        StructField("severity", StringType()),
        StructField("type", StringType()),
        StructField("date", DateType()),
    ]
)

POINT_SCHEMA = StructType(
    [
        StructField("ts", TimestampType()),
        StructField("ingest_ts", TimestampType()),
        StructField("well_id", StringType()),
        StructField("well_status", StringType()),
        StructField("measurement", StringType()),
        StructField("field", StringType()),
        StructField("value", DoubleType()),
        StructField("date", DateType()),
    ]
)

ALERT_SCHEMA = StructType(
    [
        StructField("alert_id", StringType()),
        StructField("well_id", StringType()),
        StructField("anomaly_type", StringType()),
        StructField("severity", StringType()),
        StructField("value", DoubleType()),
        StructField("threshold", DoubleType()),
        StructField("alert_ts", TimestampType()),
        StructField("subject", StringType()),
        StructField("message", StringType()),
        StructField("date", DateType()),
    ]
)

COVERAGE_SCHEMA = StructType(
    [
        StructField("well_id", StringType()),
        StructField("anomaly_type", StringType()),
        StructField("readings", LongType()),
        StructField("detected", LongType()),
        StructField("rate", DoubleType()),
    ]
)

# Positions of replayed letters, under the day the letters arrived.
LEDGER_SCHEMA = StructType([*_SOURCE_FIELDS, StructField("date", DateType())])

#: Days kept by default, by folder of the base.
KEPT_DAYS = {
    "readings/route=raw": ARCHIVE_DAYS["other"],
    "replayed": ARCHIVE_DAYS["other"],
    "anomalies": ARCHIVE_DAYS["other"],
    "readings/route=dead_letter": DEAD_LETTER_DAYS,
    "replay_ledger": LEDGER_DAYS,
    "points": POINT_DAYS,
    "breaches": POINT_DAYS,
    "alerts": POINT_DAYS,
}

#: The tables that are filled by streams reading a table.
CONSUMERS = {
    "readings": ("anomalies", "points", "breaches"),
    "replayed": ("anomalies", "points", "breaches"),
    "breaches": ("alerts",),
}


def _as_days(age: str) -> float:
    units = {"d": 1, "h": 1 / 24, "m": 1 / 1440, "min": 1 / 1440, "s": 1 / 86400}
    number = age.strip().rstrip("dhmins ")
    return float(number) * units[age.strip().removeprefix(number).strip()]


@dataclass(frozen=True)
class Pipeline:
    """Where the tables live, how they are laid out and what is checked."""

    base: str
    schema: StructType = READING_SCHEMA
    sensors: Sequence[str] = SENSORS
    rules: Sequence[Rule] = RULES
    layout: Sequence[str] = BUCKET_LAYOUT
    buckets: int = BUCKETS
    trigger: dict = field(default_factory=lambda: {"processingTime": "1 minute"})
    max_files: int = 1000
    kept_days: dict = field(default_factory=lambda: dict(KEPT_DAYS))
    # Files written longer ago leave the sink's log, and so the table. Keeps the log of a
    # long-lived table short; has to exceed the days that drop_old keeps.
    log_retention: str | None = None
    # A column for the fields of messages that the schema does not have, so that none is lost.
    extra: str | None = None

    def __post_init__(self):
        longest = max(self.kept_days.values(), default=0)
        if self.log_retention and _as_days(self.log_retention) <= longest and longest:
            raise ValueError(
                f"log_retention of {self.log_retention} would lose rows that are kept {longest} days"
            )

    def partition_by(self, table: str) -> list[str]:
        return {
            "readings": ["route", *self.layout],
            "replayed": [*self.layout],
            "anomalies": [*self.layout],
            "points": ["measurement", "date"],
            "breaches": ["date"],
            "alerts": ["date"],
            "replay_ledger": ["date"],
        }[table]

    def schema_of(self, table: str) -> StructType:
        return {
            "readings": self.readings_schema,
            "replayed": self.raw_schema,
            "anomalies": self.raw_schema,
            "points": POINT_SCHEMA,
            "breaches": BREACH_SCHEMA,
            "alerts": ALERT_SCHEMA,
            "replay_ledger": LEDGER_SCHEMA,
        }[table]

    def path(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/{table}"

    def checkpoint(self, table: str) -> str:
        return f"{self.base.rstrip('/')}/_checkpoints/{table}"

    @property
    def readings_schema(self) -> StructType:
        extra = [
            *_SOURCE_FIELDS,
            StructField("ingest_ts", TimestampType()),
            StructField("raw", StringType()),
            StructField("error", StringType()),
            StructField("route", StringType()),
            StructField("ts", TimestampType()),
            StructField("date", DateType()),
        ]
        if self.extra:
            extra.insert(0, StructField(self.extra, EXTRA_TYPE))
        if "well_bucket" in self.layout:
            extra.append(StructField("well_bucket", IntegerType()))
        return StructType([*self.schema.fields, *extra])

    @property
    def raw_schema(self) -> StructType:
        dropped = {"raw", "error", "route"}
        return StructType([f for f in self.readings_schema.fields if f.name not in dropped])


def append_to(
    df: DataFrame,
    pipeline: Pipeline,
    table: str,
    partition_by: Sequence[str] | None = None,
    gather: bool = True,
) -> StreamingQuery:
    """Append a stream to a Parquet table, exactly once. ``gather`` shuffles the rows so that each
    folder gets few files; leave it off where the input files already follow the folders."""
    partition_by = partition_by or pipeline.partition_by(table)
    if "well_bucket" in partition_by:
        fix_buckets(df.sparkSession, pipeline.path(table), pipeline.buckets)
    df = clustered(df, partition_by) if gather else df
    writer = (
        df.writeStream.queryName(table)
        .format("parquet")
        .outputMode("append")
        .option("path", pipeline.path(table))
        .option("checkpointLocation", pipeline.checkpoint(table))
        .partitionBy(*partition_by)
        .trigger(**pipeline.trigger)
    )
    if pipeline.log_retention:
        writer = writer.option("retention", pipeline.log_retention)
    return writer.start()


def _placed(readings: DataFrame, pipeline: Pipeline) -> DataFrame:
    placed = with_partitions(readings, fallback="ingest_ts", buckets=pipeline.buckets)
    return placed if "well_bucket" in pipeline.layout else placed.drop("well_bucket")


def start_ingest(messages: DataFrame, pipeline: Pipeline) -> StreamingQuery:
    """Messages to the ``readings`` table. Raw readings and dead letters are folders of one sink,
    so both are written exactly once from one parse. Readings lie under their event day, dead
    letters under the day they arrived."""
    placed = _placed(with_event_time(route_messages(messages, pipeline.schema, extra=pipeline.extra)), pipeline)
    arrival = utc_day(F.col("ingest_ts"))
    day = F.when(F.col("route") == RAW_ROUTE, F.col("date")).otherwise(arrival)
    return append_to(placed.withColumn("date", day), pipeline, "readings")


def table_stream(spark: SparkSession, pipeline: Pipeline, table: str) -> DataFrame:
    """A table of the pipeline as a stream, which may start before the table has rows. It leaves out files that no
    longer count when it starts, and reads every file that comes later, also for a day that
    retention has taken out."""
    fs, path = file_system(spark, pipeline.path(table))
    fs.mkdirs(path)
    schema = pipeline.schema_of(table)
    files = stream_files(
        spark, pipeline.path(table), schema, pipeline.partition_by(table), pipeline.max_files
    )
    for folder in folders_of(table):
        days = read_days(spark, pipeline.path(folder))
        files = counting(files, days, folder.partition("/")[2])
    return files.select(*schema.names)


def folders_of(table: str) -> list[str]:
    """The folders of a table that retention and rewriting treat apart, by their path in the base."""
    return [folder for folder in KEPT_DAYS if folder.partition("/")[0] == table]


def rewritten_path(pipeline: Pipeline, folder: str) -> str:
    """Where rewritten days of a folder lie: plain Parquet without a sink's log."""
    return pipeline.path(f"rewritten/{folder}")


def read(spark: SparkSession, pipeline: Pipeline, table: str) -> DataFrame:
    """A table of the pipeline, empty if nothing was written yet: the files that its stream has written,
    but for days that retention has taken out and for days that were rewritten, of which it reads the
    rewritten rows."""
    schema = pipeline.schema_of(table)
    notes = {folder: read_days(spark, pipeline.path(folder)) for folder in folders_of(table)}
    parts = []
    fs, path = file_system(spark, pipeline.path(table))
    if fs.exists(path):
        files = read_files(spark, pipeline.path(table), schema, pipeline.partition_by(table))
        for folder, days in notes.items():
            files = counting(files, days, folder.partition("/")[2])
        parts.append(files.select(*schema.names))
    for folder, days in notes.items():
        rows = read_rewritten(spark, pipeline, folder, days)
        if rows is not None:
            parts.append(rows.select(*schema.names))
    if not parts:
        return spark.createDataFrame([], schema)
    return reduce(DataFrame.unionByName, parts)


def read_rewritten(
    spark: SparkSession, pipeline: Pipeline, folder: str, days: Days
) -> DataFrame | None:
    root = rewritten_path(pipeline, folder)
    paths = [
        f"{root}/date={day.isoformat()}/gen={noted.generation}"
        for day, noted in days.items()
        if noted.generation is not None
    ]
    if not paths:
        return None
    schema = pipeline.schema_of(folder.partition("/")[0])
    data = [f for f in schema.fields if f.name != "date"]
    stored = StructType([*data, schema["date"], StructField("gen", StringType())])
    return spark.read.schema(stored).option("basePath", root).parquet(*paths)


def raw_stream(spark: SparkSession, pipeline: Pipeline) -> DataFrame:
    """Every raw reading once: those taken in, and dead letters that were replayed."""
    taken_in = good_readings(table_stream(spark, pipeline, "readings"))
    return taken_in.unionByName(table_stream(spark, pipeline, "replayed"))


def start_anomalies(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    flagged = detect_any(raw_stream(spark, pipeline), pipeline.rules)
    return append_to(flagged, pipeline, "anomalies")


def start_points(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    keep = ("ts", "ingest_ts", "well_id", "date")
    points = to_points(raw_stream(spark, pipeline), pipeline.sensors, keep)
    # Readings come in files of one day, so their points do too. Shuffling here would move every
    # reading once per sensor.
    return append_to(points, pipeline, "points", gather=False)


def start_breaches(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    keep = ("well_id", "ts", "ingest_ts", "topic", "partition", "offset", "date")
    breaches = detect_breaches(raw_stream(spark, pipeline), pipeline.rules, keep)
    return append_to(breaches, pipeline, "breaches")


def start_alerts(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    breaches = table_stream(spark, pipeline, "breaches")
    return append_to(critical_alerts(breaches, keep=("date",)), pipeline, "alerts")


def _each_batch(
    rows: DataFrame, pipeline: Pipeline, name: str, work: Callable[[DataFrame, int], None], mode: str = "append"
) -> StreamingQuery:
    return (
        rows.writeStream.queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", pipeline.checkpoint(name))
        .trigger(**pipeline.trigger)
        .foreachBatch(work)
        .start()
    )


def deliveries(pipeline: Pipeline) -> BatchTable:
    """The alerts that were delivered."""
    return BatchTable(pipeline.path("delivered"), ALERT_SCHEMA, ["date"])


def start_delivery(
    spark: SparkSession, pipeline: Pipeline, send: Callable[[DataFrame], None] | None = None
) -> StreamingQuery:
    """Deliver every alert once: to the table of ``deliveries``, and to ``send`` if there is one.

    An alert that was delivered by an earlier batch is left out, by its ``alert_id``, and a batch that
    is repeated once it was committed is passed over. ``send`` gets the rows of a batch as they were written,
    before the commit: if it fails midway, it gets the same rows again, and their receiver can drop
    those it has by ``alert_id``.
    """
    table = deliveries(pipeline)

    def work(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        days = [r["date"] for r in batch.select("date").distinct().collect()]
        # an alert made again has the same day
        sent = table.read(session).filter(F.col("date").isin(days)).select("alert_id", "date")
        new = batch.dropDuplicates(["alert_id"]).join(sent, ["alert_id", "date"], "left_anti")
        table.write(new, number, send)

    return _each_batch(table_stream(spark, pipeline, "alerts"), pipeline, "delivered", work)


def publish_rules(spark: SparkSession, pipeline: Pipeline, rules: DataFrame) -> None:
    """Make a rule table the one that streams use from their next batch on."""
    path = pipeline.path(f"rules/{uuid.uuid4().hex}")
    rules.write.parquet(path)
    write_latest(spark, pipeline.path("rules/_current"), path)


def current_rules(spark: SparkSession, pipeline: Pipeline) -> DataFrame:
    path = read_latest(spark, pipeline.path("rules/_current"))
    return rule_table(spark, pipeline.rules) if path is None else spark.read.parquet(path)


def rule_breaches(pipeline: Pipeline) -> BatchTable:
    """Breaches of the published rules."""
    return BatchTable(pipeline.path("rule_breaches"), BREACH_SCHEMA, ["date"])


def start_rule_breaches(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    """Breaches by the rules that are published when a batch begins. A change needs no restart, and a batch
    goes by one set of rules as a whole."""
    table = rule_breaches(pipeline)
    keep = ("well_id", "ts", "ingest_ts", "topic", "partition", "offset", "date")

    def work(batch: DataFrame, number: int) -> None:
        rules = current_rules(batch.sparkSession, pipeline)
        table.write(detect_with_rule_table(batch, rules, pipeline.sensors, keep), number)

    return _each_batch(raw_stream(spark, pipeline), pipeline, "rule_breaches", work)


def coverage(pipeline: Pipeline) -> BatchTable:
    """Readings and caught faults by label and well, so far."""
    return BatchTable(pipeline.path("coverage"), COVERAGE_SCHEMA, snapshot=True)


def start_coverage(spark: SparkSession, pipeline: Pipeline) -> StreamingQuery:
    """Keep the coverage of labels by the rules up to date. The counts are the stream's state, one row for each label and
    well; a batch hands on those that changed, which replace their rows in the snapshot."""
    table = coverage(pipeline)
    keys = ["well_id", "anomaly_type"]

    def work(batch: DataFrame, number: int) -> None:
        before = table.read(batch.sparkSession)
        same = batch.select(*[F.col(c).alias(f"_{c}") for c in keys])
        changed = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in keys])
        table.write(before.join(same, changed, "left_anti").unionByName(batch), number)

    rows = label_coverage(raw_stream(spark, pipeline), pipeline.rules, by=("well_id",))
    return _each_batch(rows, pipeline, "coverage", work, "update")


def with_trigger(pipeline: Pipeline, **trigger) -> Pipeline:
    return replace(pipeline, trigger=trigger)


def run_once(spark: SparkSession, messages: DataFrame, pipeline: Pipeline) -> None:
    """Work off what is there and stop: a backfill, or a scheduled run. Tables that only need the
    readings run side by side."""
    once = with_trigger(pipeline, availableNow=True)
    start_ingest(messages, once).awaitTermination()
    side_by_side = [start(spark, once) for start in (start_anomalies, start_points, start_breaches)]
    for query in side_by_side:
        query.awaitTermination()
    start_alerts(spark, once).awaitTermination()


def start_all(spark: SparkSession, messages: DataFrame, pipeline: Pipeline) -> list[StreamingQuery]:
    spark.streams.resetTerminated()
    return [
        start_ingest(messages, pipeline),
        start_anomalies(spark, pipeline),
        start_points(spark, pipeline),
        start_breaches(spark, pipeline),
        start_alerts(spark, pipeline),
    ]


def replay(spark: SparkSession, pipeline: Pipeline, repair: Column | None = None) -> None:
    """Bring dead letters that parse now into the raw readings, each once over any number of runs.

    A message was written either as raw or as dead letter, so only earlier replays can hold it. Their
    positions stay in a ledger for longer than the letters, also when retention has removed the
    rows. Run one replay at a time.
    """
    _note_replayed(spark, pipeline)  # in case the last replay stopped before it got here
    keys = list(SOURCE_KEYS)
    fixed = replay_dead_letters(
        read_dead_letters(spark, pipeline),
        read(spark, pipeline, "replay_ledger").select(*keys),
        pipeline.schema,
        repair,
        extra=pipeline.extra,
    )
    placed = _placed(fixed, pipeline)
    write_archive(
        placed, pipeline.path("replayed"), pipeline.layout, buckets=pipeline.buckets
    )
    _note_replayed(spark, pipeline)


def _note_replayed(spark: SparkSession, pipeline: Pipeline) -> None:
    """Bring the ledger up to what has been replayed."""
    keys = list(SOURCE_KEYS)
    replayed = read(spark, pipeline, "replayed").select(
        *keys, utc_day(F.col("ingest_ts")).alias("date")
    )
    new = replayed.join(read(spark, pipeline, "replay_ledger").select(*keys), keys, "left_anti")
    if not new.isEmpty():
        write_archive(new.dropDuplicates(keys), pipeline.path("replay_ledger"), ["date"])


def drop_old(
    spark: SparkSession,
    pipeline: Pipeline,
    as_of: datetime,
    archive_days: int | None = None,
    consumers: Collection[str] = ("anomalies", "points", "breaches", "alerts"),
    grace: timedelta = GRACE,
) -> list[str]:
    """Apply retention to every table; checkpoints are never touched. Returns the days that were
    taken out. Reads that start later leave them out; their files are deleted once the grace period is
    over, by this run or a later one.

    A day stays, with a warning, while it has a file that one of the streams in ``consumers`` has
    not passed yet. Name only the streams that are in use.
    """
    _note_replayed(spark, pipeline)
    days = dict(pipeline.kept_days)
    if archive_days is not None:
        days |= dict.fromkeys(("readings/route=raw", "replayed", "anomalies"), archive_days)
    removed = []
    for folder, kept in days.items():
        path, noted = pipeline.path(folder), read_days(spark, pipeline.path(folder))
        files, first = files_of(spark, pipeline, folder), first_kept_day(kept, as_of)
        noted = _without_past(spark, pipeline, folder, noted, files)
        expired = counted_files(files, noted).filter(F.col("day") < F.lit(first))
        newest = {r["day"]: r["upto"] for r in expired.groupBy("day").agg(F.max("modified").alias("upto")).collect()}
        newest |= {
            day: max(noted[day].upto, newest.get(day, 0))
            for day in noted
            if day < first and noted[day].generation is not None
        }
        waiting = unread_days(spark, pipeline, folder, expired, consumers) if newest else set()
        if waiting:
            warnings.warn(f"{folder}: {len(waiting)} days have files not read yet", stacklevel=2)
        gone = {day: upto for day, upto in newest.items() if day not in waiting}
        if gone:
            note_days(spark, path, gone)
        clear_days(spark, path, grace, rewritten_path(pipeline, folder))
        removed += [f"{path}/date={day.isoformat()}" for day in sorted(gone)]
    return removed


def files_of(spark: SparkSession, pipeline: Pipeline, folder: str) -> DataFrame:
    """(path, size, modified, day) of the files that were written to a folder of a table."""
    table, _, part = folder.partition("/")
    place = F.regexp_extract("path", f"{part}/date=([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/", 1)
    written = files_written(spark, pipeline.path(table)).withColumn("day", F.try_to_date(place))
    return written.filter("day is not null")


def counted_files(files: DataFrame, days: Days) -> DataFrame:
    """The files that still count. Notes of days are as few as days."""
    if not days:
        return files
    rows = [(day, noted.upto) for day, noted in days.items()]
    upto = files.sparkSession.createDataFrame(rows, "day date, upto long")
    kept = files.join(F.broadcast(upto), "day", "left").filter("upto is null or modified > upto")
    return kept.drop("upto")


def _without_past(
    spark: SparkSession, pipeline: Pipeline, folder: str, days: Days, files: DataFrame
) -> Days:
    """Forget the days whose files are deleted and have left the sink's log as well."""
    done = [day for day, noted in days.items() if noted.cleared and noted.generation is None]
    if not done:
        return days
    named = {r["day"] for r in files.select("day").distinct().collect()}
    left = {day: noted for day, noted in days.items() if day not in done or day in named}
    if len(left) < len(days):
        write_days(spark, pipeline.path(folder), left)
    return left


def unread_days(
    spark: SparkSession,
    pipeline: Pipeline,
    folder: str,
    files: DataFrame,
    consumers: Collection[str],
) -> set[date]:
    """Days of ``files`` that a stream has still to read."""
    table, _, part = folder.partition("/")
    streams = [c for c in CONSUMERS.get(table, ()) if c in consumers]
    if part == "route=dead_letter":
        return set()
    days: set[date] = set()
    for stream in streams:
        unread = files.join(files_read(spark, pipeline.checkpoint(stream)), "path", "left_anti")
        days |= {row["day"] for row in unread.select("day").distinct().collect()}
    return days


def await_any(spark: SparkSession) -> None:
    """Wait on every query: the first that fails ends the job with its error."""
    try:
        spark.streams.awaitAnyTermination()
    finally:
        for query in spark.streams.active:
            query.stop()


def read_raw(spark: SparkSession, pipeline: Pipeline) -> DataFrame:
    taken_in = good_readings(read(spark, pipeline, "readings"))
    return taken_in.unionByName(read(spark, pipeline, "replayed"))


def read_dead_letters(spark: SparkSession, pipeline: Pipeline) -> DataFrame:
    return as_dead_letters(read(spark, pipeline, "readings"))
