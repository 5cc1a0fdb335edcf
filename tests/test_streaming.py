"""Streams against batch, restarts, supervision, replay and retention of the pipeline tables."""

import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.__main__ import arguments, main
from gaugeline.operators.alerts import critical_alerts
from gaugeline.operators.detect import detect_any, detect_breaches
from gaugeline.operators.panels import sensor_panel
from gaugeline.operators.parse import dead_letters, parse_messages
from gaugeline.operators.points import to_points
from gaugeline.plans.queries import QUERIES
from gaugeline.plans.tables import cut_off, table, well_messages
from gaugeline.schema import MESSAGE_SCHEMA, READING_SCHEMA
from gaugeline.session import settings
from gaugeline.sources.archive import BUCKET_LAYOUT, WELL_LAYOUT, write_archive
from gaugeline.sources.kafka import read_message_files
from gaugeline.streaming import jobs


def same(got, want, columns):
    got, want = got.select(*columns), want.select(*columns)
    assert want.count() > 0
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


@pytest.fixture(scope="module")
def messages(spark, sf_dir, tmp_path_factory):
    """Two deliveries of messages, one in ten cut off."""
    events = table(spark, sf_dir, "events")
    rows = well_messages(events, cut_off)
    cut = F.when(F.col("offset") % 10 == 0, F.substring(F.col("value").cast("string"), 1, 9))
    rows = rows.withColumn("value", F.coalesce(cut, F.col("value").cast("string")).cast("binary"))
    folder = str(tmp_path_factory.mktemp("messages"))
    rows.filter("offset < 600").repartition(3).write.mode("append").parquet(folder)

    def deliver_rest():
        rows.filter("offset >= 600").repartition(3).write.mode("append").parquet(folder)
        return rows

    return folder, rows.filter("offset < 600"), deliver_rest


def check(spark, pipeline, batch):
    good = parse_messages(batch)
    position = ["topic", "partition", "offset"]
    same(jobs.read_raw(spark, pipeline), good, [*READING_SCHEMA.names, *position, "ts", "ingest_ts"])
    same(jobs.read_dead_letters(spark, pipeline), dead_letters(batch), ["raw", "error", "dead_ts", *position])
    same(jobs.read(spark, pipeline, "anomalies"), detect_any(good), [*READING_SCHEMA.names, *position])
    points = ["ts", "ingest_ts", "well_id", "well_status", "measurement", "field", "value"]
    same(jobs.read(spark, pipeline, "points"), to_points(good), points)
    keep = ("well_id", "ts", "ingest_ts", *position)
    breaches = detect_breaches(good, keep=keep)
    same(jobs.read(spark, pipeline, "breaches"), breaches, breaches.columns)
    alerts = critical_alerts(breaches)
    columns = [c for c in alerts.columns if c not in ("alert_ts", "message")]
    same(jobs.read(spark, pipeline, "alerts"), alerts, columns)
    ids = jobs.read(spark, pipeline, "alerts").select("alert_id")
    assert ids.distinct().count() == ids.count()


@pytest.fixture(scope="module")
def filled(spark, messages, tmp_path_factory):
    """A pipeline run over the first delivery, again over nothing new, then over the rest."""
    folder, first, deliver_rest = messages
    pipeline = jobs.Pipeline(str(tmp_path_factory.mktemp("tables")), layout=BUCKET_LAYOUT, buckets=2)
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    check(spark, pipeline, first)
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    check(spark, pipeline, first)
    everything = deliver_rest()
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    return pipeline, everything


def test_stream_equals_batch_over_restarts(spark, filled):
    pipeline, everything = filled
    check(spark, pipeline, everything)


def test_replayed_letters_reach_every_table_once(spark, filled, messages):
    pipeline, everything = filled
    before = jobs.read_raw(spark, pipeline).count()
    letters = jobs.read_dead_letters(spark, pipeline).count()
    assert letters > 0
    repair = F.lit('{"well_id":"WELL-AB-001","h2s_concentration":50}')
    jobs.replay(spark, pipeline)
    assert jobs.read_raw(spark, pipeline).count() == before
    for _ in range(2):
        jobs.replay(spark, pipeline, repair)
        raw = jobs.read_raw(spark, pipeline)
        assert raw.count() == before + letters
        assert raw.select("topic", "partition", "offset").distinct().count() == before + letters
    jobs.run_once(spark, read_message_files(spark, messages[0]), pipeline)
    replayed = F.col("value") == 50
    breaches = jobs.read(spark, pipeline, "breaches").filter(replayed & (F.col("field") == "h2s_concentration"))
    assert breaches.count() == letters
    assert jobs.read(spark, pipeline, "alerts").filter(replayed).count() == letters


def test_retention_leaves_streams_running(spark, messages, tmp_path):
    folder, _, _ = messages
    pipeline = jobs.Pipeline(str(tmp_path), layout=BUCKET_LAYOUT, buckets=1)
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    points = jobs.read(spark, pipeline, "points").count()
    as_of = datetime(2024, 1, 31, tzinfo=timezone.utc)
    removed = jobs.drop_old(spark, pipeline, as_of, archive_days=7)
    assert removed and not any("_checkpoints" in folder for folder in removed)
    kept = jobs.read(spark, pipeline, "points")
    assert 0 < kept.count() < points
    assert str(kept.agg(F.min("date")).first()[0]) == "2024-01-24"
    dead = jobs.read_dead_letters(spark, pipeline).agg(F.min("dead_ts")).first()[0]
    assert str(dead.date()) >= "2024-01-17"
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    assert jobs.read(spark, pipeline, "points").count() == kept.count()


def test_a_batch_that_fails_midway_is_written_once(spark, sf_dir, tmp_path):
    rows = well_messages(table(spark, sf_dir, "events"), cut_off)
    source, spare = tmp_path / "in", tmp_path / "spare"
    rows.filter("offset % 4 < 3").repartition(6).write.parquet(str(source))
    rows.filter("offset % 4 = 3").coalesce(1).write.parquet(str(spare))
    [good] = spare.glob("*.parquet")
    (source / "part-unreadable.parquet").write_bytes(b"not parquet")
    pipeline = jobs.Pipeline(
        str(tmp_path / "t"), layout=BUCKET_LAYOUT, buckets=1, trigger={"availableNow": True}
    )
    # Without the shuffle of the ingest job, tasks with readable files write before one fails.
    messages = read_message_files(spark, str(source)).withColumn("p", F.lit(1))
    for attempt in range(2):
        with pytest.raises(Exception, match="(?i)parquet"):
            jobs.append_to(messages, pipeline, "copy", ["p"], gather=False).awaitTermination()
        with pytest.raises(Exception, match="(?i)parquet"):
            jobs.start_ingest(read_message_files(spark, str(source)), pipeline).awaitTermination()
    (source / "part-unreadable.parquet").write_bytes(good.read_bytes())
    jobs.append_to(messages, pipeline, "copy", ["p"], gather=False).awaitTermination()
    jobs.run_once(spark, read_message_files(spark, str(source)), pipeline)
    same(spark.read.parquet(pipeline.path("copy")), rows, ["offset", "value"])
    check(spark, pipeline, rows)
    spark.streams.resetTerminated()


def test_tables_not_written_yet_are_empty(spark, tmp_path):
    pipeline = jobs.Pipeline(str(tmp_path / "none"))
    assert jobs.read_raw(spark, pipeline).count() == 0
    assert jobs.read_dead_letters(spark, pipeline).count() == 0
    assert jobs.read(spark, pipeline, "alerts").columns == jobs.ALERT_SCHEMA.names
    jobs.replay(spark, pipeline)
    assert jobs.drop_old(spark, pipeline, datetime(2024, 1, 31)) == []
    assert jobs.read_raw(spark, pipeline).count() == 0


def test_dead_letters_lie_under_their_arrival(spark, tmp_path):
    at = datetime(2024, 1, 5, tzinfo=timezone.utc)
    good, bad = '"water_cut":1}', '"water_cut":"1"}'
    texts = ['{"well_id":"w","timestamp":"2024-01-02T00:00:00+00:00",' + end for end in (good, bad)]
    rows = [(b"w", t.encode(), "t", 0, i, at, 0) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, MESSAGE_SCHEMA).write.parquet(str(tmp_path / "in"))
    pipeline = jobs.Pipeline(str(tmp_path / "t"), trigger={"availableNow": True})
    jobs.start_ingest(read_message_files(spark, str(tmp_path / "in")), pipeline).awaitTermination()
    got = {(r.route, str(r.date)) for r in jobs.read(spark, pipeline, "readings").collect()}
    assert got == {("raw", "2024-01-02"), ("dead_letter", "2024-01-05")}


def test_old_files_leave_the_log(spark, tmp_path):
    source, rows = str(tmp_path / "in"), spark.range(1).withColumn("p", F.lit(1))
    spark.conf.set("spark.sql.streaming.fileSink.log.compactInterval", "2")
    try:
        for retention, expected in ((None, 4), ("1s", 1)):
            name = f"t{expected}"
            pipeline = jobs.Pipeline(
                str(tmp_path), trigger={"availableNow": True}, kept_days={}, log_retention=retention
            )
            for _ in range(4):
                rows.write.mode("append").parquet(f"{source}{expected}")
                time.sleep(1.5)
                stream = spark.readStream.schema(rows.schema).parquet(f"{source}{expected}")
                jobs.append_to(stream, pipeline, name, ["p"]).awaitTermination()
            assert spark.read.parquet(pipeline.path(name)).count() == expected
    finally:
        spark.conf.unset("spark.sql.streaming.fileSink.log.compactInterval")


def test_any_failed_query_ends_the_job(spark, messages, tmp_path):
    folder, _, _ = messages
    spark.streams.resetTerminated()
    pipeline = jobs.Pipeline(str(tmp_path / "t"), trigger={"processingTime": "1 second"})
    jobs.start_ingest(read_message_files(spark, folder), pipeline)
    broken = read_message_files(spark, folder).select(F.raise_error(F.lit("broken")).alias("x"), F.lit(1).alias("p"))
    jobs.append_to(broken, pipeline, "broken", ["p"])
    with pytest.raises(Exception, match="broken"):
        jobs.await_any(spark)
    assert not spark.streams.active
    spark.streams.resetTerminated()


@pytest.mark.parametrize("layout", [BUCKET_LAYOUT, WELL_LAYOUT])
def test_all_queries_run_together(spark, messages, tmp_path, layout):
    """Started at once on empty tables, every query still finds its columns."""
    folder, _, _ = messages
    pipeline = jobs.Pipeline(str(tmp_path), layout=layout, buckets=1, trigger={"processingTime": "0 seconds"})
    queries = jobs.start_all(spark, read_message_files(spark, folder), pipeline)
    try:
        for query in queries:  # in the order of the data
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()
    check(spark, pipeline, spark.read.parquet(folder))


def test_command_line(spark, messages, tmp_path, capsys):
    base = str(tmp_path)
    args = ["--base", base, "--layout", "bucket", "--buckets", "1"]
    main(["stream", *args, "--files", messages[0], "--trigger", "once"])
    main(["replay", *args])
    main(["compact", *args, "--as-of", "2024-01-31"])
    main(["backfill", *args, "--first", "2024-01-25", "--last", "2024-01-28"])
    main(["retain", *args, "--archive-days", "7", "--as-of", "2024-01-31"])
    printed = capsys.readouterr().out
    assert "removed" in printed and "rewritten" in printed
    with pytest.raises(SystemExit):
        arguments(["stream", "--base", base, "--broker", "b:9092"])


def test_a_hot_well_is_split_over_tasks(spark, tmp_path):
    """A third of all rows in one well must not end in one file."""
    rows = spark.range(300_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), F.col("id") % 50)).alias("well_id"),
        F.sha2(F.col("id").cast("string"), 512).alias("payload"),
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        path = str(tmp_path / "t")
        write_archive(rows.repartition(8), path, ["well_id"])
    finally:
        for key in settings:
            spark.conf.unset(key)
    names = spark.read.parquet(path).select("well_id", F.input_file_name().alias("file")).distinct()
    files = names.groupBy("well_id").agg(F.count("*").alias("files"))
    counts = {r.well_id: r.files for r in files.collect()}
    assert counts["hot"] >= 4
    assert sum(counts.values()) < 8 * 51


def test_retention_waits_for_the_streams(spark, messages, tmp_path):
    folder, _, _ = messages
    pipeline = jobs.Pipeline(
        str(tmp_path), layout=BUCKET_LAYOUT, buckets=1, trigger={"availableNow": True}
    )
    jobs.start_ingest(read_message_files(spark, folder), pipeline).awaitTermination()
    as_of = datetime(2024, 1, 31, tzinfo=timezone.utc)
    with pytest.warns(UserWarning, match="not read yet"):
        removed = jobs.drop_old(spark, pipeline, as_of, archive_days=7)
    assert not any("route=raw" in folder for folder in removed)
    want = detect_breaches(jobs.read_raw(spark, pipeline)).count()
    jobs.start_breaches(spark, pipeline).awaitTermination()
    assert jobs.read(spark, pipeline, "breaches").count() == want
    # breaches has passed all days; anomalies and points have not begun, and are not in use
    removed = jobs.drop_old(spark, pipeline, as_of, archive_days=7, consumers=["breaches"])
    assert any("route=raw" in folder for folder in removed)
    assert jobs.read_raw(spark, pipeline).agg(F.min("date")).first()[0].isoformat() == "2024-01-24"
    # a stream that starts now reads what is left
    jobs.start_points(spark, pipeline).awaitTermination()
    left = to_points(jobs.read_raw(spark, pipeline)).count()
    assert jobs.read(spark, pipeline, "points").count() == left > 0


def test_a_missing_file_is_an_error(spark, messages, tmp_path):
    folder, _, _ = messages
    pipeline = jobs.Pipeline(
        str(tmp_path), layout=BUCKET_LAYOUT, buckets=1, trigger={"availableNow": True}
    )
    jobs.start_ingest(read_message_files(spark, folder), pipeline).awaitTermination()
    file = next((tmp_path / "readings").glob("route=raw/date=2024-01-3*/*/*.parquet"))
    kept = file.read_bytes()
    file.unlink()
    with pytest.raises(Exception, match="(?i)not exist|FILE_NOT_EXIST|FAILED_READ_FILE"):
        jobs.read_raw(spark, pipeline).agg(F.sum("water_cut")).collect()
    file.write_bytes(kept)


def test_replay_remembers_beyond_retention(spark, messages, tmp_path):
    folder, _, _ = messages
    pipeline = jobs.Pipeline(
        str(tmp_path), layout=BUCKET_LAYOUT, buckets=1, trigger={"availableNow": True}
    )
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    repair = F.lit('{"well_id":"WELL-AB-001","h2s_concentration":50,"timestamp":"2024-01-18T00:00:00"}')
    jobs.replay(spark, pipeline, repair)
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    letters = jobs.read_dead_letters(spark, pipeline).count()
    as_of = datetime(2024, 1, 31, tzinfo=timezone.utc)
    jobs.drop_old(spark, pipeline, as_of, archive_days=7, grace=timedelta(0))
    assert jobs.read(spark, pipeline, "replayed").count() == 0
    assert 0 < jobs.read_dead_letters(spark, pipeline).count() < letters
    jobs.replay(spark, pipeline, repair)
    assert jobs.read(spark, pipeline, "replayed").count() == 0
    assert not list((tmp_path / "replayed").glob("date=2024-01-18/**/*.parquet"))
    jobs.run_once(spark, read_message_files(spark, folder), pipeline)
    ids = jobs.read(spark, pipeline, "alerts").select("alert_id")
    assert ids.count() == ids.distinct().count() > 0


def test_log_retention_has_to_exceed_what_is_kept(tmp_path):
    for age in ("89d", "90d", "12h"):
        with pytest.raises(ValueError, match="log_retention"):
            jobs.Pipeline(str(tmp_path), log_retention=age)
    assert jobs.Pipeline(str(tmp_path), log_retention="100d").log_retention == "100d"


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/Los_Angeles"])
def test_stored_panels_do_not_depend_on_the_session_zone(spark, tmp_path, zone):
    at = datetime(2024, 1, 5, 23, 30, tzinfo=timezone.utc)
    text = '{"well_id":"w","timestamp":"2024-01-05T23:30:00","water_cut":1}'
    spark.createDataFrame([(b"w", text.encode(), "t", 0, 0, at, 0)], MESSAGE_SCHEMA).write.parquet(
        str(tmp_path / "in")
    )
    pipeline = jobs.Pipeline(str(tmp_path / "t"), trigger={"availableNow": True})
    jobs.run_once(spark, read_message_files(spark, str(tmp_path / "in")), pipeline)
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        as_of = datetime(2024, 1, 5, 23, 32, tzinfo=timezone.utc)
        panel = sensor_panel(jobs.read(spark, pipeline, "points"), "water_cut", as_of)
        assert panel.count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_a_hot_well_of_a_stream_is_split_over_tasks(spark, tmp_path):
    rows = spark.range(300_000).select(
        F.lit("hot").alias("well_id"), F.sha2(F.col("id").cast("string"), 512).alias("payload")
    )
    rows.repartition(8).write.parquet(str(tmp_path / "in"))
    values = {
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2m",
        "spark.sql.adaptive.streaming.stateless.enabled": "true",
    }
    with settings(spark, **{k.replace(".", "__"): v for k, v in values.items()}):
        pipeline = jobs.Pipeline(str(tmp_path), trigger={"availableNow": True})
        stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
        jobs.append_to(stream, pipeline, "t", ["well_id"]).awaitTermination()
    assert len(list((tmp_path / "t").glob("well_id=hot/*.parquet"))) >= 4


def test_batches_of_the_replay_follow_the_letters(spark, tmp_path, monkeypatch):
    """Many files of events, few dead letters: few batches, in which every letter comes back once."""
    events = spark.read.parquet("/root/testdata/sf0.01/events.parquet")
    events.repartition(12).write.parquet(str(tmp_path / "events.parquet"))
    paths = (str(tmp_path / f"shared/{i}") for i in range(100))
    monkeypatch.setattr("gaugeline.plans.queries.scratch_path", lambda _, name: f"{next(paths)}/{name}")
    rows = QUERIES["stream_replay"](spark, str(tmp_path)).select("offset").collect()
    assert sorted(r.offset for r in rows) == sorted(r.event_id for r in events.filter("event_id % 97 = 0").collect())
    commits = list((tmp_path / "shared").glob("*/stream/_checkpoints/replayed/commits/[0-9]*"))
    assert 2 <= len(commits) <= 6


def test_points_are_not_sorted_by_folder(spark, monkeypatch):
    """Tasks that write points keep files open for their folders while the stream runs."""
    seen, start = [], jobs.start_points

    def watched(session, pipeline):
        query = start(session, pipeline)
        seen.append(int(session.conf.get("spark.sql.maxConcurrentOutputFileWriters")))
        return query

    monkeypatch.setattr(jobs, "start_points", watched)
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    assert QUERIES["pipeline_panel"](spark, "/root/testdata/sf0.01").count() > 0
    assert seen and min(seen) > 31  # days of the events in January
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before
