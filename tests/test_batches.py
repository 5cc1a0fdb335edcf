"""Tables filled batch by batch: delivery, changing rules, coverage; and the listener."""

import threading
import time
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.joins import BROADCAST_ROWS
from gaugeline.operators.coverage import label_coverage
from gaugeline.operators.detect import detect_breaches, detect_with_rule_table, rule_table
from gaugeline.operators.parse import parse_messages, route_messages
from gaugeline.operators.replay import replay_stream
from gaugeline.plans.tables import cut_off, extended_messages, table, well_messages
from gaugeline.schema import MESSAGE_SCHEMA, READING_SCHEMA
from gaugeline.session import settings
from gaugeline.sources.kafka import read_message_files
from gaugeline.streaming import jobs
from gaugeline.streaming.batches import BatchTable
from gaugeline.streaming.supervise import ProgressLog, health, read_progress

AT = datetime(2024, 1, 31, tzinfo=timezone.utc)
ONCE = {"availableNow": True}


@pytest.fixture
def fed(spark, sf_dir, tmp_path):
    """A pipeline with readings, and a function that takes in more events."""
    pipeline = jobs.Pipeline(str(tmp_path / "t"), buckets=1, trigger=ONCE, max_files=2)

    def feed(condition):
        rows = well_messages(table(spark, sf_dir, "events").filter(condition), cut_off)
        rows.repartition(2).write.mode("append").parquet(str(tmp_path / "in"))
        jobs.start_ingest(read_message_files(spark, str(tmp_path / "in")), pipeline).awaitTermination()

    feed("event_id % 3 < 2")
    return pipeline, feed


def test_batches_count_once_and_whole(spark, tmp_path):
    made = BatchTable(str(tmp_path / "t"), spark.range(0).withColumn("p", F.lit(1)).schema, ["p"])
    rows = spark.range(10).withColumn("p", F.col("id").cast("int") % 2)
    assert made.read(spark).count() == 0

    def fail(_):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        made.write(rows, 0, fail)
    assert made.read(spark).count() == 0  # written, not committed
    made.write(rows.filter("id < 4"), 0)  # repeated, with other files
    assert made.read(spark).count() == 4
    made.write(rows, 0, fail)  # repeated after it was committed
    made.write(rows, 1)
    assert made.read(spark).count() == 14 and made.committed(spark) == 1
    plan = made.read(spark)._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "batch" in plan.split("PartitionFilters")[1].split("]")[0]


def test_snapshots_keep_the_last_batch(spark, tmp_path):
    made = BatchTable(str(tmp_path / "t"), spark.range(0).schema, snapshot=True)
    for number in range(5):
        made.write(spark.range(number + 1), number)
    assert made.read(spark).count() == 5
    assert len(list((tmp_path / "t").glob("batch=*"))) == 2


@pytest.mark.parametrize("stop", ["before the commit", "after the commit"])
def test_a_batch_repeated_after_a_failure_delivers_nothing_twice(spark, fed, monkeypatch, stop):
    pipeline, feed = fed
    jobs.start_breaches(spark, pipeline).awaitTermination()
    jobs.start_alerts(spark, pipeline).awaitTermination()
    received = []

    def send(rows):
        received.extend(r.alert_id for r in rows.collect())

    plain = BatchTable.write
    failed = []

    def write(self, rows, number, before_commit=None):
        if stop == "before the commit" and not failed:
            failed.append(number)
            rows.write.mode("overwrite").parquet(self._folder(number))
            raise RuntimeError("stopped")
        plain(self, rows, number, before_commit)
        if not failed:
            failed.append(number)
            raise RuntimeError("stopped")

    with monkeypatch.context() as patched:
        patched.setattr(BatchTable, "write", write)
        with pytest.raises(Exception, match="stopped"):
            jobs.start_delivery(spark, pipeline, send).awaitTermination()
    spark.streams.resetTerminated()
    jobs.start_delivery(spark, pipeline, send).awaitTermination()
    feed("event_id % 3 = 2")
    jobs.start_breaches(spark, pipeline).awaitTermination()
    jobs.start_alerts(spark, pipeline).awaitTermination()
    jobs.start_delivery(spark, pipeline, send).awaitTermination()
    made = sorted(r.alert_id for r in jobs.read(spark, pipeline, "alerts").collect())
    assert sorted(received) == made and len(set(made)) == len(made) > 0
    assert sorted(r.alert_id for r in jobs.deliveries(pipeline).read(spark).collect()) == made


def test_an_alert_made_again_is_not_delivered_again(spark, fed):
    pipeline, _ = fed
    jobs.start_breaches(spark, pipeline).awaitTermination()
    jobs.start_alerts(spark, pipeline).awaitTermination()
    jobs.start_delivery(spark, pipeline).awaitTermination()
    before = jobs.deliveries(pipeline).read(spark).count()
    # the stream of alerts begins again and makes all of them once more
    again = jobs.critical_alerts(jobs.table_stream(spark, pipeline, "breaches"), keep=("date",))
    query = again.writeStream.format("parquet").option("path", pipeline.path("alerts")).partitionBy("date")
    query = query.option("checkpointLocation", pipeline.checkpoint("alerts-again")).trigger(**ONCE).start()
    query.awaitTermination()
    jobs.start_delivery(spark, pipeline).awaitTermination()
    assert jobs.read(spark, pipeline, "alerts").count() >= before
    assert jobs.deliveries(pipeline).read(spark).count() == before > 0


def test_rules_change_between_batches(spark, fed):
    pipeline, feed = fed
    raw = jobs.read_raw(spark, pipeline)
    keep = ("offset", "well_id", "ts")
    want = detect_breaches(raw, pipeline.rules, keep)
    jobs.start_rule_breaches(spark, pipeline).awaitTermination()  # none published: those of the pipeline
    got = jobs.rule_breaches(pipeline).read(spark)
    assert got.select(*want.columns).exceptAll(want).count() == 0 and got.count() == want.count() > 0
    own = spark.createDataFrame(
        [("water_cut", "max", 10.0, "info", "WELL-AB-001"), ("pump_speed", "min", 6.0, "warning", None)],
        "field string, kind string, threshold double, severity string, well_id string",
    )
    jobs.publish_rules(spark, pipeline, own)
    feed("event_id % 3 = 2")
    jobs.start_rule_breaches(spark, pipeline).awaitTermination()
    new = jobs.read_raw(spark, pipeline).join(raw.select("offset"), "offset", "left_anti")
    more = detect_with_rule_table(new, own, keep=keep)
    everything = want.unionAll(more)
    got = jobs.rule_breaches(pipeline).read(spark).select(*want.columns)
    assert more.count() > 0 and got.count() == everything.count()
    assert got.exceptAll(everything).count() == 0


def test_coverage_is_kept_up_to_date(spark, fed):
    pipeline, feed = fed
    for condition in (None, "event_id % 3 = 2", "event_id < 0"):
        if condition:
            feed(condition)
        jobs.start_coverage(spark, pipeline).awaitTermination()
        want = label_coverage(jobs.read_raw(spark, pipeline), by=("well_id",))
        got = jobs.coverage(pipeline).read(spark)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
        assert got.count() > 0


def test_only_breaking_readings_meet_the_rules(spark, sf_dir):
    """The loosest limits are a filter of the scan, below the join with the rules of wells."""
    readings = parse_messages(well_messages(table(spark, sf_dir, "events")))
    rules = rule_table(spark).withColumn("well_id", F.lit(None).cast("string")).unionByName(
        spark.createDataFrame([("water_cut", "max", 10.0, "info", "WELL-AB-001")], "field string, kind string, threshold double, severity string, well_id string")
    )
    tree = detect_with_rule_table(readings, rules)._jdf.queryExecution().optimizedPlan().toString()
    below = tree[tree.index("Join LeftOuter"):]
    assert "water_cut" in below and "> 10.0" in below and BROADCAST_ROWS > 0
    for bad in ([("water_cut", "most", 1.0, "info")], [("depth", "max", 1.0, "info")], [("water_cut", "max", None, "info")]):
        table_of = spark.createDataFrame(bad, "field string, kind string, threshold double, severity string")
        for rules in (table_of, table_of.withColumn("well_id", F.lit("w"))):
            with pytest.raises(ValueError, match="rules of unknown"):
                detect_with_rule_table(readings, rules)
    none = rule_table(spark, [])
    assert detect_with_rule_table(readings, none).count() == 0


def test_replay_state_does_not_grow_with_time(spark, tmp_path):
    """Letters of forty days, each sent twice: the state holds those of a few days at any time."""
    kind = "raw string, error string, dead_ts timestamp, topic string, partition int, offset long, seen timestamp"
    for day in range(40):
        at = AT + timedelta(days=day)
        rows = [('{"well_id":"a"}', "e", AT, "t", 0, 10 * day + i, at) for i in range(10)]
        rows += [(*row[:6], at) for row in rows]
        frame = spark.createDataFrame(rows, kind).coalesce(1)
        frame.write.mode("append").parquet(str(tmp_path / "in"))
        time.sleep(0.02)
    stream = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    fixed = replay_stream(stream, remember="3 days", seen=F.col("seen"))
    with settings(spark, spark__sql__shuffle__partitions="2", spark__sql__streaming__numRecentProgressUpdates="200"):
        query = fixed.writeStream.format("parquet").option("path", str(tmp_path / "out")).option(
            "checkpointLocation", str(tmp_path / "cp")).trigger(**ONCE).start()
        query.awaitTermination()
    sizes = [p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators]
    assert len(sizes) >= 40 and max(sizes) <= 90 and max(sizes[-10:]) <= max(sizes[5:15])
    offsets = [r.offset for r in spark.read.parquet(str(tmp_path / "out")).collect()]
    assert sorted(offsets) == list(range(400))


def test_fields_outside_the_schema(spark, tmp_path):
    texts = [
        '{"well_id":"w","water_cut":1.5,"new":{"a":[1,2]},"z":7,"s":"x"}',
        '{"well_id":"w","water_cut":2}',
        '{"well_id":"w","z":null}',
        '{"z":1}',
        '{"well_id":"w","z":1',
        '{"well_id":"w","water_cut":"no","z":1}',
    ]
    rows = [(b"w", t.encode(), "t", 0, i, AT, 0) for i, t in enumerate(texts)]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    plain = route_messages(messages)
    routed = route_messages(messages, extra="others")
    assert sorted(map(str, routed.drop("others").collect())) == sorted(map(str, plain.collect()))
    got = {
        r.offset: r
        for r in routed.selectExpr(
            "offset", "array_sort(map_keys(others)) names", "variant_get(others['new'], '$.a[1]', 'int') a",
            "others['z']::string z", "others['s']::string s", "route",
        ).collect()
    }
    assert got[0].names == ["new", "s", "z"] and (got[0].a, got[0].z, got[0].s) == (2, "7", "x")
    assert got[1].names is None and got[2].names == ["z"] and got[2].z is None
    assert all(got[i].names is None and got[i].route == "dead_letter" for i in (3, 4, 5))
    messages.write.parquet(str(tmp_path / "in"))
    pipeline = jobs.Pipeline(str(tmp_path / "t"), buckets=1, trigger=ONCE, extra="others")
    jobs.run_once(spark, read_message_files(spark, str(tmp_path / "in")), pipeline)
    jobs.replay(spark, pipeline, F.regexp_replace("raw", '"no"', "3"))
    stored = jobs.read_raw(spark, pipeline).selectExpr("offset", "others['z']::string z").collect()
    assert sorted(map(tuple, stored)) == [(0, "7"), (1, None), (2, None), (5, "1")]


def test_declared_columns_do_not_change(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    want = parse_messages(well_messages(events)).select("offset", *READING_SCHEMA.names)
    got = parse_messages(extended_messages(events), extra="others").select(*want.columns)
    assert got.exceptAll(want).count() == 0 and got.count() == want.count() > 0


def test_progress_of_a_stalled_and_a_failed_query(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("id long").parquet(str(tmp_path / "in"))
    path, release = str(tmp_path / "progress"), threading.Event()
    log = ProgressLog(spark, path, events=1)
    assert read_progress(spark, path).count() == 0

    def start(name, work, **trigger):
        return stream.writeStream.queryName(name).foreachBatch(work).option(
            "checkpointLocation", str(tmp_path / name)).trigger(**trigger).start()

    def broken(batch, number):
        raise RuntimeError("broken sink")

    spark.streams.addListener(log)
    try:
        start("fine", lambda batch, number: batch.count(), availableNow=True).awaitTermination()
        running = start("running", lambda batch, number: batch.count(), processingTime="0 seconds")
        hanging = start("hanging", lambda batch, number: release.wait(60), processingTime="0 seconds")
        with pytest.raises(Exception, match="broken sink"):
            start("failing", broken, availableNow=True).awaitTermination()
        deadline = time.time() + 40
        while time.time() < deadline:  # until an idle report has come of the running one
            log.close()
            found = {r.name: r for r in health(read_progress(spark, path), datetime.now(timezone.utc), timedelta(seconds=12)).collect()}
            if found.get("hanging") and found["hanging"].status == "stalled" and len(found) == 4:
                break
            time.sleep(1)
        assert {name: row.status for name, row in found.items()} == {
            "fine": "stopped", "running": "running", "hanging": "stalled", "failing": "failed",
        }
        assert "broken sink" in found["failing"].error
        assert found["fine"].rows == 10 and found["running"].rows == 10 and found["hanging"].rows == 0
    finally:
        release.set()
        running.stop()
        hanging.stop()
        spark.streams.removeListener(log)
        spark.streams.resetTerminated()


def test_a_query_that_falls_behind(spark):
    kind = "event string, at timestamp, name string, batch long, rows long, behind long, state_rows long, error string"
    rows = [
        ("progress", AT, "a", 1, 5, 900, None, None),
        ("progress", AT, "b", 1, 5, 10, 3, None),
        ("ended", AT - timedelta(minutes=9), "c", None, None, None, None, None),
        ("progress", AT - timedelta(minutes=9), "d", 1, 1, None, None, None),
        ("progress", AT + timedelta(minutes=9), "b", 2, 5, 5000, None, None),
    ]
    found = health(spark.createDataFrame(rows, kind), AT, most_behind=100).collect()
    assert {r.name: r.status for r in found} == {"a": "behind", "b": "running", "c": "stopped", "d": "stalled"}
