"""Every operator as a query over the given tables: name -> function(spark, sf_dir)."""

from __future__ import annotations

import warnings
from collections.abc import Callable
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeline.functions.predicates import utc_day
from gaugeline.operators.alerts import critical_alerts, critical_rules
from gaugeline.operators.coverage import label_coverage
from gaugeline.operators.detect import (
    detect_any,
    detect_breaches,
    detect_with_rule_table,
    rule_table,
)
from gaugeline.operators.encode import dead_letter_messages, to_messages
from gaugeline.operators.envelope import out_of_envelope
from gaugeline.operators.panels import anomaly_panel, sensor_panel, sensor_panel_of_readings
from gaugeline.operators.parse import (
    RAW_ROUTE,
    as_dead_letters,
    dead_letters,
    parse_messages,
    route_messages,
)
from gaugeline.operators.points import breach_points, to_points
from gaugeline.operators.replay import replay_dead_letters, replay_stream
from gaugeline.operators.retention import (
    ARCHIVE_DAYS,
    DEAD_LETTER_DAYS,
    POINT_DAYS,
    drop_expired,
    retain,
)
from gaugeline.plans.tables import (
    EVENT_MESSAGE_SCHEMA,
    LINE_RULES,
    LINE_SENSORS,
    cut_off,
    event_messages,
    extended_messages,
    line_readings,
    number_quoted,
    numbers_unquoted,
    table,
    table_stream,
    text_after,
    well_messages,
    well_readings,
)
from gaugeline.schema import RULES, SENSORS, Rule
from gaugeline.session import in_utc, scratch_path, with_open_files, with_rocksdb
from gaugeline.sources.archive import (
    BUCKET_LAYOUT,
    MAX_FILE_AGE,
    archive_schema,
    for_wells,
    read_table,
    with_partitions,
    write_archive,
)
from gaugeline.sources.baselines import default_baselines, explode_baselines
from gaugeline.sources.kafka import read_message_files
from gaugeline.streaming import jobs, rewrite

EVENTS_END = datetime(2024, 1, 31, tzinfo=timezone.utc)
LINES_END = datetime(2001, 11, 5, tzinfo=timezone.utc)
ONCE = {"availableNow": True}
WELLS = ["5", "17", "42"]
#: Events that are delivered after the others.
LATE = "event_id % 13 = 5"
NO_GRACE = timedelta(0)
NEW_RULES = (
    Rule("h2s_concentration", "max", 4, "critical"),
    Rule("water_cut", "max", 85, "info"),
    Rule("pump_speed", "min", 6, "warning"),
)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_readings(table(spark, sf_dir, "lineitem"))


def _wells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return well_readings(table(spark, sf_dir, "events"))


def _line_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_breaches(_lines(spark, sf_dir), LINE_RULES)


def _well_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect_breaches(_wells(spark, sf_dir), keep=("event_id", "well_id", "ts"))


# Messages


def parse_events(spark, sf_dir):
    parsed = parse_messages(event_messages(table(spark, sf_dir, "events")), EVENT_MESSAGE_SCHEMA, "k")
    return parsed.select("topic", "partition", "offset", "k")


def parse_well_messages(spark, sf_dir):
    parsed = parse_messages(well_messages(table(spark, sf_dir, "events"), cut_off))
    return parsed.select(
        "offset", F.col("ts").cast("timestamp_ntz").alias("ts"), "well_id", "well_status", *SENSORS, "anomaly_type"
    )


def parse_extra_fields(spark, sf_dir):
    """Fields that the schema does not have, beside those that it has."""
    parsed = parse_messages(extended_messages(table(spark, sf_dir, "events")), extra="others")
    return parsed.select(
        "offset",
        "well_id",
        "well_status",
        *SENSORS,
        "anomaly_type",
        F.coalesce(F.size(F.map_keys("others")), F.lit(0)).alias("n_others"),
        F.expr("others['firmware']::string").alias("firmware"),
        F.expr("variant_get(others['battery'], '$.volts', 'double')").alias("volts"),
    )


def dead_letter(spark, sf_dir):
    messages = event_messages(table(spark, sf_dir, "events"), cut_off)
    dead = dead_letters(messages, EVENT_MESSAGE_SCHEMA, "k")
    return dead.withColumn("dead_ts", F.col("dead_ts").cast("timestamp_ntz"))


def parse_trailing(spark, sf_dir):
    """Messages with text after the object, brackets among it, are dead letters."""
    messages = event_messages(table(spark, sf_dir, "events"), text_after)
    dead = dead_letters(messages, EVENT_MESSAGE_SCHEMA, "k")
    return dead.select("raw", "error", "offset")


def dead_letter_body(spark, sf_dir):
    """Dead letters as they are published."""
    sent = dead_letter_messages(dead_letter_rows(spark, sf_dir)).select(
        F.decode("value", "UTF-8").alias("body")
    )
    fields = [F.get_json_object("body", f"$.{name}").alias(name) for name in ("reading", "error", "timestamp")]
    return sent.select(*fields)


def dead_letter_rows(spark, sf_dir):
    messages = event_messages(table(spark, sf_dir, "events"), cut_off)
    return dead_letters(messages, EVENT_MESSAGE_SCHEMA, "k")


def replay(spark, sf_dir):
    messages = event_messages(table(spark, sf_dir, "events"), number_quoted("k"))
    # Routing is written once, as the streaming job does, so messages are not parsed per use.
    path = scratch_path(spark, "routed")
    routed = route_messages(messages, EVENT_MESSAGE_SCHEMA, "k")
    routed.write.partitionBy("route").parquet(path)
    landed = read_table(spark, path, routed.schema)
    raw, dead = landed.filter(F.col("route") == RAW_ROUTE), as_dead_letters(landed)
    repair = numbers_unquoted(F.col("raw"))
    fixed = replay_dead_letters(dead, raw, EVENT_MESSAGE_SCHEMA, repair, required="k")
    return raw.select("offset", "k").unionByName(fixed.select("offset", "k"))


def encode_roundtrip(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    sent = to_messages(events, key="user_id").select(
        "value",
        F.lit("events").alias("topic"),
        F.lit(0).alias("partition"),
        F.lit(0).cast("bigint").alias("offset"),
        F.current_timestamp().alias("timestamp"),
    )
    parsed = parse_messages(sent, events.schema, "event_id")
    return parsed.select(*events.columns)


def encode_messages(spark, sf_dir):
    sent = to_messages(table(spark, sf_dir, "events"), key="user_id")
    text = F.decode("value", "UTF-8")
    fields = [F.get_json_object(text, f"$.{name}").alias(name) for name in ("event_id", "event_type", "props")]
    return sent.select(F.decode("key", "UTF-8").alias("message_key"), *fields)


# Detection


def detect_any_lines(spark, sf_dir):
    return detect_any(_lines(spark, sf_dir), LINE_RULES)


def detect_any_wells(spark, sf_dir):
    return detect_any(_wells(spark, sf_dir)).select("event_id", "well_id", *SENSORS)


def detect_rule_table(spark, sf_dir):
    return detect_with_rule_table(_lines(spark, sf_dir), rule_table(spark, LINE_RULES), LINE_SENSORS)


def detect_rule_table_wells(spark, sf_dir):
    keep = ("event_id", "well_id", "ts")
    return detect_with_rule_table(_wells(spark, sf_dir), rule_table(spark), keep=keep)


def detect_rule_table_overrides(spark, sf_dir):
    """Default rules, and other limits for some wells."""
    defaults = rule_table(spark).withColumn("well_id", F.lit(None).cast("string"))
    own = spark.createDataFrame(
        [
            ("h2s_concentration", "max", 4.0, "critical", "WELL-AB-001"),
            ("water_cut", "max", 60.0, "info", "WELL-AB-001"),
            ("pump_speed", "min", 6.0, "warning", "WELL-AB-003"),
        ],
        defaults.select("field", "kind", "threshold", "severity", "well_id").schema,
    )
    keep = ("event_id", "well_id", "ts")
    rules = defaults.unionByName(own)
    return detect_with_rule_table(_wells(spark, sf_dir), rules, keep=keep)


def alerts_lines(spark, sf_dir):
    breaches = detect_breaches(_lines(spark, sf_dir), critical_rules(LINE_RULES))
    alerts = critical_alerts(breaches, alert_ts=F.col("ts"))
    return alerts.drop("alert_ts")


def alerts_wells(spark, sf_dir):
    keep = ("event_id", "well_id", "ts")
    breaches = detect_breaches(_wells(spark, sf_dir), critical_rules(), keep)
    alerts = critical_alerts(breaches, alert_ts=F.col("ts"), keep=("event_id",))
    return alerts.drop("alert_ts")


def baseline_envelope(spark, sf_dir):
    lineitem, part = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    readings = lineitem.select(
        F.col("l_partkey").alias("well_id"),
        F.col("l_shipdate").alias("ts"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("unit_price"),
    )
    baselines = part.select(
        F.col("p_partkey").alias("well_id"),
        F.lit("unit_price").alias("sensor"),
        F.col("p_retailprice").alias("baseline"),
    )
    return out_of_envelope(readings, baselines, ["unit_price"], tolerance=1.0)


def baseline_envelope_wells(spark, sf_dir):
    keep = ("event_id", "well_id", "ts")
    return out_of_envelope(
        _wells(spark, sf_dir), default_baselines(spark), tolerance=0.5, keep=keep
    )


def baseline_documents(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    levels = F.create_map(
        F.lit("size"), F.col("p_size").cast("double"), F.lit("price"), F.col("p_retailprice")
    )
    document = F.to_json(F.create_map(F.col("p_partkey").cast("string"), levels))
    return explode_baselines(part, document)


def coverage_lines(spark, sf_dir):
    return label_coverage(_lines(spark, sf_dir), LINE_RULES, label="well_status")


def coverage_wells(spark, sf_dir):
    return label_coverage(_wells(spark, sf_dir), by=("well_id",))


# Points and panels


def points_lines(spark, sf_dir):
    return to_points(_lines(spark, sf_dir), LINE_SENSORS, keep=("ts", "well_id"))


def points_wells(spark, sf_dir):
    return to_points(_wells(spark, sf_dir), keep=("event_id", "ts", "well_id"))


def breach_points_wells(spark, sf_dir):
    return breach_points(_well_breaches(spark, sf_dir), keep=("event_id", "ts", "well_id"))


def panel_field(spark, sf_dir):
    points = table(spark, sf_dir, "events").select(
        "ts",
        F.col("user_id").alias("well_id"),
        F.lit("events").alias("measurement"),
        F.col("event_type").alias("field"),
        "value",
    )
    return sensor_panel(points, "view", EVENTS_END, timedelta(hours=48), measurement="events")


def _sensor_panel_of(sensor: str):
    def panel(spark, sf_dir):
        return sensor_panel_of_readings(
            _wells(spark, sf_dir), sensor, EVENTS_END, timedelta(hours=24), keep=("event_id", "ts", "well_id")
        )

    return panel


def panel_anomalies(spark, sf_dir):
    return anomaly_panel(_line_breaches(spark, sf_dir), LINES_END, timedelta(days=365))


def panel_anomalies_wells(spark, sf_dir):
    return anomaly_panel(_well_breaches(spark, sf_dir), EVENTS_END, timedelta(hours=48))


# Tables

_WRITTEN: dict[tuple, object] = {}


def _written_once(spark: SparkSession, sf_dir: str, write: Callable):
    """What ``write`` made for the same session and source, or that it makes now. Only for tables
    that no query changes."""
    key = (spark.sparkContext.applicationId, sf_dir, write.__name__)
    if key not in _WRITTEN:
        _WRITTEN[key] = write(spark, sf_dir)
    return _WRITTEN[key]


def _event_archive(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    events = table(spark, sf_dir, "events").withColumn("well_id", F.col("user_id").cast("string"))
    placed = with_partitions(events)
    path = scratch_path(spark, "archive")
    write_archive(placed, path, BUCKET_LAYOUT)
    return read_table(spark, path, archive_schema(events.schema)), path


def archive_pruned_read(spark, sf_dir):
    archive, path = _written_once(spark, sf_dir, _event_archive)
    return for_wells(archive, WELLS, path).select("event_id", "well_id", "ts", "event_type", "value")


def retention_partitions(spark, sf_dir):
    archive, path = _event_archive(spark, sf_dir)
    drop_expired(spark, path, POINT_DAYS, EVENTS_END)
    return read_table(spark, path, archive.schema).select("event_id", "ts", "value")


def retention(spark, sf_dir):
    return retain(table(spark, sf_dir, "events"), "ts", POINT_DAYS, EVENTS_END)


def retention_archive(spark, sf_dir):
    return retain(_lines(spark, sf_dir), "ts", ARCHIVE_DAYS["other"], LINES_END)


def retention_dead_letters(spark, sf_dir):
    return retain(dead_letter(spark, sf_dir), "dead_ts", DEAD_LETTER_DAYS, EVENTS_END)


# Streams, run to the end of the table


def _finish(*queries) -> None:
    for query in queries:
        query.awaitTermination()


def stream_archive(spark, sf_dir):
    source = table_stream(spark, sf_dir, "events").withColumn("well_id", F.col("user_id").cast("string"))
    pipeline = jobs.Pipeline(scratch_path(spark, "stream"), trigger=ONCE)
    _finish(jobs.append_to(with_partitions(source), pipeline, "raw", BUCKET_LAYOUT))
    archive = read_table(spark, pipeline.path("raw"), archive_schema(source.schema))
    return archive.select("event_id", "ts", "well_id", "event_type", "value", "props")


def stream_anomalies(spark, sf_dir):
    flagged = detect_any(line_readings(table_stream(spark, sf_dir, "lineitem")), LINE_RULES)
    placed = flagged.withColumn("year", F.year("ts"))
    pipeline = jobs.Pipeline(scratch_path(spark, "stream"), trigger=ONCE)
    _finish(jobs.append_to(placed, pipeline, "anomalies", ["year"]))
    return read_table(spark, pipeline.path("anomalies"), placed.schema).drop("year")


def stream_replay(spark, sf_dir):
    """Dead letters that come in any order, and twice, come back once. The files of the stream are
    cut by event id, and times jump by up to a month from one to the next."""
    damaged = well_messages(table(spark, sf_dir, "events"), number_quoted("water_cut"))
    # letters are few: parsed once and gathered, so that files, and with them batches, follow the letters
    # and not the files of the table
    once, source = scratch_path(spark, "letters"), scratch_path(spark, "letters")
    dead_letters(damaged).hint("rebalance").write.parquet(once)
    letters = spark.read.parquet(once)
    for low, high in (("1/3", "1"), ("0", "1/3")):  # newest first, then those long before
        day = F.dayofmonth("dead_ts") / 31.0
        for _ in range(2):
            letters.filter((day > F.expr(low)) & (day <= F.expr(high))).write.mode("append").parquet(source)
    stream = (
        spark.readStream.schema(letters.schema)
        .option("maxFilesPerTrigger", 1)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(source)
    )
    fixed = replay_stream(stream, repair=numbers_unquoted(F.col("raw")))
    pipeline = jobs.Pipeline(scratch_path(spark, "stream"), trigger=ONCE)
    dated = fixed.withColumn("date", utc_day(F.col("ts")))
    with with_rocksdb(spark):
        _finish(jobs.append_to(dated, pipeline, "replayed", ["date"], gather=False))
    replayed = read_table(spark, pipeline.path("replayed"), fixed.schema)
    return replayed.select("offset", "well_id", *SENSORS)


def _shared(spark: SparkSession, sf_dir: str) -> jobs.Pipeline:
    """The ingested messages, for queries that only add tables of their own. A table that another
    query has filled already is not filled again: its stream finds nothing new."""
    return _written_once(spark, sf_dir, _ingested)


def _ingested(spark: SparkSession, sf_dir: str, damage=cut_off) -> jobs.Pipeline:
    """Well messages, some of them damaged, taken in by the streaming job."""
    pipeline = jobs.Pipeline(
        scratch_path(spark, "pipeline"), layout=BUCKET_LAYOUT, buckets=4, trigger=ONCE
    )
    messages = well_messages(table_stream(spark, sf_dir, "events"), damage)
    _finish(jobs.start_ingest(messages, pipeline))
    return pipeline


def pipeline_raw(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    return jobs.read_raw(spark, pipeline).select("offset", "well_id", "well_status", *SENSORS, "anomaly_type")


def pipeline_dead_letters(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    dead = jobs.read_dead_letters(spark, pipeline)
    return dead.withColumn("dead_ts", F.col("dead_ts").cast("timestamp_ntz"))


def pipeline_replay(spark, sf_dir):
    pipeline = _ingested(spark, sf_dir, number_quoted("water_cut"))
    jobs.replay(spark, pipeline, numbers_unquoted(F.col("raw")))
    raw = jobs.read_raw(spark, pipeline).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return raw.select("offset", "ts", "well_id", "well_status", *SENSORS, "anomaly_type")


def pipeline_replay_after_retention(spark, sf_dir):
    """Replayed rows after replay, retention and another replay: the letters of removed days are
    still there, and do not come in again."""
    pipeline = _ingested(spark, sf_dir, number_quoted("water_cut"))
    repair = numbers_unquoted(F.col("raw"))
    jobs.replay(spark, pipeline, repair)
    jobs.drop_old(spark, pipeline, EVENTS_END, POINT_DAYS, consumers=())
    jobs.replay(spark, pipeline, repair)
    rows = jobs.read(spark, pipeline, "replayed")
    return rows.select("offset", "well_id", *SENSORS)


def pipeline_anomalies(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    _finish(jobs.start_anomalies(spark, pipeline))
    return jobs.read(spark, pipeline, "anomalies").select("offset", "well_id", *SENSORS)


def _fill_points(spark: SparkSession, pipeline: jobs.Pipeline) -> None:
    with with_open_files(spark):
        _finish(jobs.start_points(spark, pipeline))


def pipeline_points(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    _fill_points(spark, pipeline)
    points = jobs.read(spark, pipeline, "points")
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("ts", "ingest_ts")]
    return points.select(*times, "well_id", "well_status", "measurement", "field", "value")


def pipeline_panel(spark, sf_dir):
    """A panel over the stored points: reads the folders of its days only."""
    pipeline = _shared(spark, sf_dir)
    _fill_points(spark, pipeline)
    points = jobs.read(spark, pipeline, "points")
    recent = sensor_panel(points, "wellhead_pressure", EVENTS_END, timedelta(hours=24))
    return recent.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "well_id", "well_status", "value")


def pipeline_anomaly_panel(spark, sf_dir):
    """The anomaly panel over the stored breaches: reads the folders of its days only."""
    pipeline = _shared(spark, sf_dir)
    _finish(jobs.start_breaches(spark, pipeline))
    breaches = jobs.read(spark, pipeline, "breaches")
    panel = anomaly_panel(breaches, EVENTS_END, timedelta(hours=48))
    return panel.withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def pipeline_breaches(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    _finish(jobs.start_breaches(spark, pipeline))
    breaches = jobs.read(spark, pipeline, "breaches")
    return breaches.select("offset", "well_id", "field", "value", "threshold", "severity", "type")


def pipeline_alerts(spark, sf_dir):
    pipeline = _shared(spark, sf_dir)
    _finish(jobs.start_breaches(spark, pipeline))
    _finish(jobs.start_alerts(spark, pipeline))
    alerts = jobs.read(spark, pipeline, "alerts")
    return alerts.select(
        "alert_id",
        "well_id",
        "anomaly_type",
        "severity",
        "value",
        "threshold",
        "subject",
        # the line with the time of the alert is its own
        F.regexp_replace("message", "Timestamp: .*", "Timestamp:").alias("message"),
    )


def _delivered(spark: SparkSession, sf_dir: str) -> tuple[jobs.Pipeline, Callable]:
    """An empty pipeline, and a function that delivers the messages of some events to it and takes them in."""
    pipeline = jobs.Pipeline(
        scratch_path(spark, "pipeline"), layout=BUCKET_LAYOUT, buckets=4, trigger=ONCE
    )
    source = scratch_path(spark, "delivered")

    def deliver(condition: str) -> None:
        events = table(spark, sf_dir, "events").filter(condition)
        well_messages(events, cut_off).write.mode("append").parquet(source)
        _finish(jobs.start_ingest(read_message_files(spark, source), pipeline))

    return pipeline, deliver


def pipeline_late_retention(spark, sf_dir):
    """Readings that arrive after retention has taken their days out: they count, and wait for a stream that has
    not read them."""
    pipeline, deliver = _delivered(spark, sf_dir)
    deliver(f"NOT ({LATE})")
    jobs.drop_old(spark, pipeline, EVENTS_END, POINT_DAYS, consumers=(), grace=NO_GRACE)
    deliver(LATE)
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")  # that days wait
        jobs.drop_old(spark, pipeline, EVENTS_END, POINT_DAYS, consumers=("breaches",), grace=NO_GRACE)
    return jobs.read_raw(spark, pipeline).select("offset", "well_id", *SENSORS)


def pipeline_alerts_late(spark, sf_dir):
    """Alerts of critical breaches that come after retention has taken their days out."""
    pipeline, deliver = _delivered(spark, sf_dir)
    for condition in (f"NOT ({LATE})", LATE):
        deliver(condition)
        _finish(jobs.start_breaches(spark, pipeline))
        _finish(jobs.start_alerts(spark, pipeline))
        if condition != LATE:
            used = ("breaches", "alerts")
            jobs.drop_old(spark, pipeline, EVENTS_END, POINT_DAYS, consumers=used, grace=NO_GRACE)
    alerts = jobs.read(spark, pipeline, "alerts")
    return alerts.select("alert_id", "well_id", "anomaly_type", "value", "threshold", "subject")


def archive_compacted_read(spark, sf_dir):
    """Readings of some wells from closed days that were rewritten, twice where readings came late, and from open days."""
    pipeline, deliver = _delivered(spark, sf_dir)
    for condition in (f"NOT ({LATE})", LATE):
        deliver(condition)
        rewrite.compact(spark, pipeline, EVENTS_END, consumers=(), grace=NO_GRACE)
    rows = for_wells(jobs.read_raw(spark, pipeline), ["WELL-AB-001", "WELL-AB-004"])
    return rows.select("offset", "well_id", "well_status", *SENSORS, "anomaly_type")


def _compacted_points(spark: SparkSession, sf_dir: str) -> jobs.Pipeline:
    pipeline = _ingested(spark, sf_dir)
    _fill_points(spark, pipeline)
    later = EVENTS_END + timedelta(days=2)
    rewrite.compact(spark, pipeline, later, ["points"], consumers=(), grace=NO_GRACE)
    return pipeline


def pipeline_panel_compacted(spark, sf_dir):
    """A panel over stored points that were rewritten in the order of a space-filling curve."""
    points = jobs.read(spark, _written_once(spark, sf_dir, _compacted_points), "points")
    recent = sensor_panel(points, "wellhead_pressure", EVENTS_END, timedelta(hours=24))
    return recent.select(F.col("ts").cast("timestamp_ntz").alias("ts"), "well_id", "well_status", "value")


def backfill_new_rules(spark, sf_dir):
    """Breaches after the rules have changed and were applied again, twice, to all days."""
    pipeline = _ingested(spark, sf_dir)
    _finish(jobs.start_anomalies(spark, pipeline))
    _finish(jobs.start_breaches(spark, pipeline))
    days = (EVENTS_END - timedelta(days=40)).date(), EVENTS_END.date()
    for rules in (NEW_RULES[:1], NEW_RULES):
        rewrite.backfill(spark, pipeline, *days, rules, consumers=("anomalies", "breaches"))
    breaches = jobs.read(spark, pipeline, "breaches")
    return breaches.select("offset", "well_id", "field", "value", "threshold", "severity", "type")


def pipeline_delivered(spark, sf_dir):
    """Alerts as they are delivered, once each, over two runs."""
    pipeline, deliver = _delivered(spark, sf_dir)
    for condition in (f"NOT ({LATE})", LATE):
        deliver(condition)
        for start in (jobs.start_breaches, jobs.start_alerts, jobs.start_delivery):
            _finish(start(spark, pipeline))
    sent = jobs.deliveries(pipeline).read(spark)
    return sent.select("alert_id", "well_id", "anomaly_type", "value", "threshold", "subject")


def stream_rule_change(spark, sf_dir):
    """Breaches by rules that are replaced between two batches."""
    pipeline, deliver = _delivered(spark, sf_dir)
    for condition, rules in ((f"NOT ({LATE})", RULES), (LATE, NEW_RULES)):
        deliver(condition)
        jobs.publish_rules(spark, pipeline, rule_table(spark, rules))
        _finish(jobs.start_rule_breaches(spark, pipeline))
    breaches = jobs.rule_breaches(pipeline).read(spark)
    return breaches.select("offset", "well_id", "field", "value", "threshold", "severity", "type")


def stream_label_coverage(spark, sf_dir):
    """Coverage of labels by well, kept up to date by a stream over two runs."""
    pipeline, deliver = _delivered(spark, sf_dir)
    with with_rocksdb(spark):
        for condition in (f"NOT ({LATE})", LATE):
            deliver(condition)
            _finish(jobs.start_coverage(spark, pipeline))
    return jobs.coverage(pipeline).read(spark)


_QUERIES = {
    "parse_extra_fields": parse_extra_fields,
    "parse_messages": parse_events,
    "parse_well_messages": parse_well_messages,
    "dead_letter": dead_letter,
    "dead_letter_trailing": parse_trailing,
    "dead_letter_body": dead_letter_body,
    "replay_dead_letters": replay,
    "encode_roundtrip": encode_roundtrip,
    "encode_messages": encode_messages,
    "detect_any": detect_any_lines,
    "detect_any_wells": detect_any_wells,
    "detect_breaches": _line_breaches,
    "detect_breaches_wells": _well_breaches,
    "detect_rule_table": detect_rule_table,
    "detect_rule_table_wells": detect_rule_table_wells,
    "detect_rule_table_overrides": detect_rule_table_overrides,
    "critical_alerts": alerts_lines,
    "critical_alerts_wells": alerts_wells,
    "baseline_envelope": baseline_envelope,
    "baseline_envelope_wells": baseline_envelope_wells,
    "baseline_documents": baseline_documents,
    "label_coverage": coverage_lines,
    "label_coverage_wells": coverage_wells,
    "points_long": points_lines,
    "points_long_wells": points_wells,
    "breach_points": breach_points_wells,
    "panel_field": panel_field,
    "panel_wellhead_pressure": _sensor_panel_of("wellhead_pressure"),
    "panel_water_cut": _sensor_panel_of("water_cut"),
    "panel_oil_flow_rate": _sensor_panel_of("oil_flow_rate"),
    "panel_h2s_concentration": _sensor_panel_of("h2s_concentration"),
    "panel_vibration_level": _sensor_panel_of("vibration_level"),
    "panel_anomalies": panel_anomalies,
    "panel_anomalies_wells": panel_anomalies_wells,
    "archive_pruned_read": archive_pruned_read,
    "retention": retention,
    "retention_archive": retention_archive,
    "retention_dead_letters": retention_dead_letters,
    "retention_partitions": retention_partitions,
    "stream_archive": stream_archive,
    "stream_anomalies": stream_anomalies,
    "stream_replay": stream_replay,
    "pipeline_raw": pipeline_raw,
    "pipeline_dead_letters": pipeline_dead_letters,
    "pipeline_replay": pipeline_replay,
    "pipeline_replay_after_retention": pipeline_replay_after_retention,
    "pipeline_anomalies": pipeline_anomalies,
    "pipeline_points": pipeline_points,
    "pipeline_panel": pipeline_panel,
    "pipeline_anomaly_panel": pipeline_anomaly_panel,
    "pipeline_breaches": pipeline_breaches,
    "pipeline_alerts": pipeline_alerts,
    "pipeline_late_retention": pipeline_late_retention,
    "pipeline_alerts_late": pipeline_alerts_late,
    "archive_compacted_read": archive_compacted_read,
    "pipeline_panel_compacted": pipeline_panel_compacted,
    "backfill_new_rules": backfill_new_rules,
    "pipeline_delivered": pipeline_delivered,
    "stream_rule_change": stream_rule_change,
    "stream_label_coverage": stream_label_coverage,
}


def _in_utc(query: Callable[[SparkSession, str], DataFrame]):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        with in_utc(spark):
            return query(spark, sf_dir)

    return run


QUERIES = {name: _in_utc(query) for name, query in _QUERIES.items()}
