"""Encoding, replay, archive layouts and retention."""

import os
import time
from datetime import datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.joins import broadcast_within
from gaugeline.operators.encode import dead_letter_messages, to_messages
from gaugeline.operators.parse import parse_messages
from gaugeline.operators.replay import replay_dead_letters, replay_stream
from gaugeline.operators.retention import drop_expired, expired_partitions, retain
from gaugeline.plans.tables import table, well_readings
from gaugeline.schema import MESSAGE_SCHEMA, READING_SCHEMA, SOURCE_KEYS
from gaugeline.session import scratch_path
from gaugeline.sources.archive import (
    BUCKET_LAYOUT,
    WELL_LAYOUT,
    archive_schema,
    for_days,
    for_wells,
    read_table,
    with_partitions,
    write_archive,
)
from gaugeline.sources.days import note_days, read_days
from gaugeline.sources.kafka import publish, read_message_files, read_messages

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


def test_readings_survive_encoding(spark, sf_dir):
    readings = well_readings(table(spark, sf_dir, "events")).select(*READING_SCHEMA.names)
    sent = to_messages(readings).selectExpr(
        "*", "'t' topic", "0 partition", "0L offset", "current_timestamp() timestamp"
    )
    back = parse_messages(sent).select(*READING_SCHEMA.names)
    assert back.exceptAll(readings).count() == 0 and readings.exceptAll(back).count() == 0


def test_absent_values_stay_out_of_the_message(spark):
    rows = spark.createDataFrame([("w", None, 1.5)], "well_id string, anomaly_type string, water_cut double")
    [row] = to_messages(rows).collect()
    assert (bytes(row.key), bytes(row.value)) == (b"w", b'{"well_id":"w","water_cut":1.5}')


DEAD = "raw string, error string, dead_ts timestamp, topic string, partition int, offset long"


def dead(spark, *rows):
    return spark.createDataFrame([(raw, "e", AS_OF, "t", 0, offset) for raw, offset in rows], DEAD)


def test_dead_letter_body(spark):
    [row] = dead_letter_messages(dead(spark, ('{"a', 3))).collect()
    assert row.value.decode() == (
        '{"reading":"{\\"a","error":"e","timestamp":"2024-01-31T00:00:00+00:00"}'
    )


def test_replay_is_exactly_once(spark):
    letters = dead(spark, ('{"well_id":"a"}', 1), ('{"well_id":"a"}', 1), ('{"well_id":"b"}', 2), ("{", 3))
    none = spark.createDataFrame([], "topic string, partition int, offset long")
    first = replay_dead_letters(letters, none)
    assert sorted(r.offset for r in first.collect()) == [1, 2]
    landed = first.select(*SOURCE_KEYS)
    assert replay_dead_letters(letters, landed).count() == 0
    part = landed.filter("offset = 1")
    assert [r.offset for r in replay_dead_letters(letters, part).collect()] == [2]


def test_replay_with_repair(spark):
    letters = dead(spark, ('{"well_id":"a","water_cut":"12.5"}', 1))
    none = spark.createDataFrame([], "topic string, partition int, offset long")
    assert replay_dead_letters(letters, none).count() == 0
    repair = F.regexp_replace("raw", '"(-?[0-9.]+)"', "$1")
    [row] = replay_dead_letters(letters, none, repair=repair).collect()
    assert row.water_cut == 12.5


def test_streaming_replay_drops_repeats(spark, tmp_path):
    source, out = str(tmp_path / "dead"), str(tmp_path / "out")
    letters = dead(spark, *[('{"well_id":"a"}', i % 10) for i in range(40)])
    letters.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(DEAD).option("maxFilesPerTrigger", 1).parquet(source)
    query = (
        replay_stream(stream)
        .writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == list(range(10))


def test_streaming_replay_waits_for_late_letters(spark, tmp_path):
    """A letter hours, or weeks, older than those of an earlier batch still comes back."""
    source, out = str(tmp_path / "dead"), str(tmp_path / "out")
    rows = dead(spark, *[('{"well_id":"a"}', i) for i in range(4)])
    for offset, hours in ((3, 0), (1, 3), (0, 24 * 30), (2, 1)):
        late = rows.filter(F.col("offset") == offset).withColumn(
            "dead_ts", F.col("dead_ts") - F.expr(f"interval {hours} hours")
        )
        late.coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(DEAD).parquet(source)
        replay_stream(stream).writeStream.format("parquet").option("path", out).option(
            "checkpointLocation", str(tmp_path / "cp")
        ).trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == [0, 1, 2, 3]


def test_files_with_old_times_are_read(spark, tmp_path):
    source = str(tmp_path / "in")
    seen = []
    for value, age in ((0, 0), (1, 10), (2, 400)):
        before = set((tmp_path / "in").glob("*.parquet")) if (tmp_path / "in").exists() else set()
        rows = [(b"k", b"{}", "t", 0, value, AS_OF, 0)]
        spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(source)
        for file in set((tmp_path / "in").glob("*.parquet")) - before:
            at = time.time() - age * 86400
            os.utime(file, (at, at))
        read_message_files(spark, source).writeStream.format("parquet").option(
            "path", str(tmp_path / "out")
        ).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start().awaitTermination()
        seen.append(spark.read.parquet(str(tmp_path / "out")).count())
    assert seen == [1, 2, 3]


def test_the_number_of_buckets_is_that_of_the_table(spark, fleet):
    path = scratch_path(spark, "archive")
    placed = with_partitions(fleet, buckets=4)
    write_archive(placed, path, BUCKET_LAYOUT, buckets=4)
    back = read_table(spark, path, archive_schema(fleet.schema), BUCKET_LAYOUT)
    for well in ("001", "w2", "w7"):
        assert for_wells(back, [well], path).count() == fleet.filter(F.col("well_id") == well).count() > 0
    with pytest.raises(ValueError, match="4 buckets"):
        write_archive(with_partitions(fleet, buckets=16), path, BUCKET_LAYOUT, buckets=16)


@pytest.fixture(scope="module")
def fleet(spark):
    """30 days; one well has a third of all rows, and ids that look like numbers."""
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "001").otherwise(F.concat(F.lit("w"), F.col("id") % 20)).alias("well_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 30 * 86400).alias("ts"),
        F.col("id"),
    )


@pytest.mark.parametrize("layout, buckets", [(WELL_LAYOUT, None), (BUCKET_LAYOUT, 4)])
def test_archive_roundtrip_and_pruning(spark, fleet, layout, buckets):
    path = scratch_path(spark, "archive")
    placed = with_partitions(fleet, buckets=buckets or 4).select(*fleet.columns, *layout[:1], *(
        ["well_bucket"] if buckets else []))
    write_archive(placed, path, layout, buckets=buckets or 16)
    schema = archive_schema(fleet.schema) if buckets else placed.schema
    back = read_table(spark, path, schema)
    assert back.select(*fleet.columns).exceptAll(fleet).count() == 0
    assert back.count() == fleet.count()
    some = for_days(for_wells(back, ["001", "w2"], path if buckets else None), AS_OF.date() - timedelta(days=3))
    want = fleet.filter("well_id in ('001', 'w2') and ts >= timestamp '2024-01-28'")
    assert want.count() > 0
    assert some.select(*fleet.columns).exceptAll(want).count() == 0 and some.count() == want.count()
    plan = some._jdf.queryExecution().executedPlan().toString()
    filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert "date#" in filters and ("well_bucket#" if buckets else "well_id#") in filters


def test_null_event_time_falls_back(spark):
    rows = spark.createDataFrame(
        [("w", None, AS_OF)], "well_id string, ts timestamp, ingest_ts timestamp"
    )
    assert with_partitions(rows, fallback="ingest_ts").first().date == AS_OF.date()


@pytest.mark.parametrize("days", [7, 14, 90])
def test_retention_keeps_the_bound(spark, days):
    bound = AS_OF - timedelta(days=days)
    rows = [(bound,), (bound - timedelta(microseconds=1),), (AS_OF,), (None,)]
    kept = retain(spark.createDataFrame(rows, "ts timestamp"), "ts", days, AS_OF)
    assert kept.count() == 2


def test_expired_partitions_are_dropped(spark, fleet):
    path = scratch_path(spark, "archive")
    placed = with_partitions(fleet.withColumn("route", F.lit("raw")), buckets=2)
    write_archive(placed, path, ["route", *BUCKET_LAYOUT])
    write_archive(placed, f"{path}/_checkpoints/raw", ["date"])
    write_archive(placed.withColumn("date", F.lit(None).cast("date")), path, ["route", *BUCKET_LAYOUT])
    expired = expired_partitions(spark, path, 7, AS_OF)
    assert len(expired) == 23 and not any("_checkpoints" in p for p in expired)
    before = read_table(spark, path, placed.schema)
    assert drop_expired(spark, path, 7, AS_OF) == expired
    after = read_table(spark, path, placed.schema)
    dated = after.filter("date is not null")
    assert dated.agg(F.min("date")).first()[0] == (AS_OF - timedelta(days=7)).date()
    assert dated.count() == 700 and after.count() == 3700
    # begun before the drop, read after it: the files stay for the grace period
    assert before.agg(F.sum("id")).first()[0] == 2 * fleet.agg(F.sum("id")).first()[0]
    assert expired_partitions(spark, path, 7, AS_OF) == []
    assert expired_partitions(spark, f"{path}/_checkpoints/raw", 400, AS_OF) == []
    assert expired_partitions(spark, path + "-none", 7, AS_OF) == []
    # a row that comes late for a removed day counts, until it is dropped as well
    late = placed.filter("date = '2024-01-03'").limit(1)
    write_archive(late, path, ["route", *BUCKET_LAYOUT])
    assert read_table(spark, path, placed.schema).count() == 3701
    # the next run, after the grace period, deletes what was noted and leaves the late row
    drop_expired(spark, path, 7, AS_OF, keep=[late.first()["date"]], grace=timedelta(0))
    assert len(list(Path(path).glob("route=raw/date=2024-01-0*/**/*.parquet"))) == 1
    assert read_table(spark, path, placed.schema).agg(F.count("id")).first()[0] == 3701
    assert len(drop_expired(spark, path, 7, AS_OF, grace=timedelta(0))) == 1
    assert not list(Path(path).glob("route=raw/date=2024-01-03"))
    assert read_table(spark, path, placed.schema).agg(F.count("id")).first()[0] == 3700


def test_notes_are_whole(spark, tmp_path):
    folder = str(tmp_path / "t")
    upto = {AS_OF.date() - timedelta(days=i): i for i in range(3)}
    for _ in range(6):
        note_days(spark, folder, upto)
    assert {day: noted.upto for day, noted in read_days(spark, folder).items()} == upto
    assert len(list((tmp_path / "t/_days").glob("[0-9]*"))) <= 4
    # a writer that stopped before it gave the note its number leaves the last one
    (tmp_path / "t/_days/_half").write_text("{")
    assert len(read_days(spark, folder)) == 3


def test_broadcast_needs_the_bound(spark):
    small = spark.range(10)
    hinted = spark.range(5).join(broadcast_within(small, max_rows=10), "id")
    plain = spark.range(5).join(broadcast_within(small, max_rows=9), "id")
    assert "strategy=broadcast" in hinted._jdf.queryExecution().analyzed().toString()
    assert "strategy=broadcast" not in plain._jdf.queryExecution().analyzed().toString()


def test_kafka_needs_its_package(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_messages(spark, "broker:9092", "readings", min_partitions=8, max_offsets=1000)
    with pytest.raises(Exception, match="(?i)kafka"):
        publish(spark.createDataFrame([(b"k", b"v")], "key binary, value binary"), "broker:9092", "readings")
