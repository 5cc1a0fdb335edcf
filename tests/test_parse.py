"""Edge messages, each with the route it must take."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.functions.predicates import utc_day
from gaugeline.operators.detect import detect_any
from gaugeline.operators.parse import (
    dead_letters,
    parse_messages,
    route_messages,
    with_event_time,
)
from gaugeline.schema import MESSAGE_SCHEMA, READING_SCHEMA

NOW = datetime(2024, 1, 1, 12, tzinfo=timezone.utc)


def messages(spark, *texts):
    rows = [
        (b"k", t if t is None or isinstance(t, bytes) else t.encode(), "readings", 0, i, NOW, 0)
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows, MESSAGE_SCHEMA)


RAW = {
    "whole number in a sensor": ('{"well_id":"w","motor_current":0}', {"motor_current": 0.0}),
    "extra key": ('{"well_id":"w","extra":1}', {"well_id": "w"}),
    "nested extra key": ('{"well_id":"w","extra":{"a":[1,{"b":2}]},"water_cut":3.5}', {"water_cut": 3.5}),
    "brace in a text": ('{"well_id":"w}","water_cut":3.5}', {"well_id": "w}"}),
    "trailing space": ('{"well_id":"w","water_cut":3.5} \n', {"water_cut": 3.5}),
    "numeric id": ('{"well_id":7}', {"well_id": "7"}),
    "null sensor": ('{"well_id":"w","h2s_concentration":null}', {"h2s_concentration": None}),
    "absent sensor": ('{"well_id":"w"}', {"h2s_concentration": None}),
    "large number": ('{"well_id":"w","h2s_concentration":1e40}', {"h2s_concentration": 1e40}),
    "close to a limit": ('{"well_id":"w","h2s_concentration":10.0000001}', {"h2s_concentration": 10.0000001}),
    "unicode": ('{"well_id":"wéll"}', {"well_id": "wéll"}),
}


@pytest.mark.parametrize("case", RAW)
def test_good_message(spark, case):
    text, expected = RAW[case]
    [row] = parse_messages(messages(spark, text)).collect()
    assert {name: row[name] for name in expected} == expected
    assert (row.topic, row.partition, row.offset) == ("readings", 0, 0)
    assert dead_letters(messages(spark, text)).count() == 0


def test_nan_is_raw_but_no_breach(spark):
    parsed = parse_messages(messages(spark, '{"well_id":"w","h2s_concentration":NaN}'))
    assert parsed.filter(F.isnan("h2s_concentration")).count() == 1
    assert detect_any(parsed).count() == 0


MALFORMED = "malformed or mistyped JSON"
DEAD = {
    "truncated": ('{"well_id":"bad', MALFORMED),
    "numeric text": ('{"well_id":"w","h2s_concentration":"12.5"}', MALFORMED),
    "word": ('{"well_id":"w","h2s_concentration":"abc"}', MALFORMED),
    "boolean": ('{"well_id":"w","h2s_concentration":true}', MALFORMED),
    "array": ("[1,2]", MALFORMED),
    "bracket after": ('{"well_id":"x"}]', "text after the JSON object"),
    "bracket and text after": ('{"well_id":"x"}] garbage', "text after the JSON object"),
    "bracket and object after": (
        '{"well_id":"x","h2s_concentration":1}]{"well_id":"y"}',
        "text after the JSON object",
    ),
    "second element after": ('{"well_id":"x"},"abc"', "text after the JSON object"),
    "text": ('"str"', MALFORMED),
    "null literal": ("null", MALFORMED),
    "single quotes": ("{'well_id':'w'}", MALFORMED),
    "two objects": ('{"well_id":"w"}{"well_id":"v"}', "text after the JSON object"),
    "words after": ('{"well_id":"w"} more', "text after the JSON object"),
    "null value": (None, "empty message"),
    "empty": ("", "empty message"),
    "blank": ("   ", "empty message"),
    "no id": ('{"water_cut":1}', "missing well_id"),
    "null id": ('{"well_id":null}', "missing well_id"),
    "empty id": ('{"well_id":""}', "missing well_id"),
    "bytes that are no text": (b'{"well_id":"\xff\xfe"}', "invalid UTF-8"),
}


@pytest.mark.parametrize("case", DEAD)
def test_dead_letter(spark, case):
    text, error = DEAD[case]
    source = messages(spark, text)
    assert parse_messages(source).count() == 0
    [row] = dead_letters(source).collect()
    assert row.error == error
    assert row.dead_ts is not None and row.offset == 0
    if isinstance(text, str) or text is None:
        assert row.raw == text


def test_every_message_takes_one_route(spark):
    texts = [text for text, _ in list(RAW.values()) + list(DEAD.values())]
    source = messages(spark, *texts)
    routed = route_messages(source)
    assert routed.count() == len(texts)
    assert parse_messages(source).count() == len(RAW)
    assert dead_letters(source).count() == len(DEAD)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-02T03:04:05.678901+00:00", "2024-01-02 03:04:05.678901"),
        ("2024-01-02T03:04:05+00:00", "2024-01-02 03:04:05"),
        ("2024-01-02T05:04:05+02:00", "2024-01-02 03:04:05"),
        ("yesterday", None),
    ],
)
def test_event_time(spark, text, expected):
    parsed = parse_messages(messages(spark, '{"well_id":"w","timestamp":"%s"}' % text))
    [row] = parsed.select("timestamp", F.col("ts").cast("string").alias("ts")).collect()
    assert (row.timestamp, row.ts) == (text, expected)


def test_messages_are_parsed_once(spark):
    source = messages(spark, '{"well_id":"w"}')
    for df in (parse_messages(source), dead_letters(source)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("from_json(StructField") == 1


def test_columns(spark):
    parsed = parse_messages(messages(spark, '{"well_id":"w"}'))
    assert parsed.columns == [*READING_SCHEMA.names, "topic", "partition", "offset", "ingest_ts", "ts"]


@pytest.mark.parametrize("zone", ["UTC", "Asia/Tokyo", "America/Los_Angeles"])
def test_times_without_a_zone_are_utc_in_every_session(spark, zone):
    texts = ["2024-01-05T23:30:00", "2024-01-05 23:30:00+00:00", "2024-01-06T01:30:00+02:00", "2024-01-05"]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in texts], "timestamp string")
        rows = with_event_time(frame).select(F.unix_seconds("ts").alias("s"), utc_day(F.col("ts")).alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [r.s for r in rows] == [1704497400] * 3 + [1704412800]
    assert {str(r.d) for r in rows} == {"2024-01-05"}
