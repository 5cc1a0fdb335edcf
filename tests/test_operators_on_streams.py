"""Every row-by-row operator gives the same on a stream as on a table."""

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gaugeline.operators.alerts import critical_alerts
from gaugeline.operators.coverage import label_coverage
from gaugeline.operators.detect import detect_any, detect_breaches, detect_with_rule_table, rule_table
from gaugeline.operators.encode import dead_letter_messages, to_messages
from gaugeline.operators.envelope import out_of_envelope
from gaugeline.operators.panels import anomaly_panel, sensor_panel_of_readings
from gaugeline.operators.parse import dead_letters, parse_messages
from gaugeline.operators.points import breach_points, to_points
from gaugeline.operators.retention import retain
from gaugeline.plans.tables import cut_off, table, table_stream, well_messages, well_readings
from gaugeline.sources.baselines import default_baselines

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)
DAYS = timedelta(days=10)

OPERATORS = {
    "parse_messages": lambda s, e: parse_messages(well_messages(e, cut_off)),
    "dead_letters": lambda s, e: dead_letters(well_messages(e, cut_off)),
    "dead_letter_messages": lambda s, e: dead_letter_messages(dead_letters(well_messages(e, cut_off))),
    "detect_any": lambda s, e: detect_any(well_readings(e)),
    "detect_breaches": lambda s, e: detect_breaches(well_readings(e)),
    "detect_with_rule_table": lambda s, e: detect_with_rule_table(well_readings(e), rule_table(s)),
    "critical_alerts": lambda s, e: critical_alerts(detect_breaches(well_readings(e)), F.col("ts")),
    "to_points": lambda s, e: to_points(well_readings(e), keep=("ts", "well_id")),
    "breach_points": lambda s, e: breach_points(detect_breaches(well_readings(e))),
    "out_of_envelope": lambda s, e: out_of_envelope(well_readings(e), default_baselines(s), tolerance=0.5),
    "sensor_panel": lambda s, e: sensor_panel_of_readings(well_readings(e), "water_cut", AS_OF, DAYS),
    "anomaly_panel": lambda s, e: anomaly_panel(detect_breaches(well_readings(e)), AS_OF, DAYS),
    "to_messages": lambda s, e: to_messages(well_readings(e)),
    "retain": lambda s, e: retain(well_readings(e), "ts", 7, AS_OF),
}


def drained(spark, df, mode="append"):
    query = df.writeStream.format("memory").queryName("drained").outputMode(mode)
    query.trigger(availableNow=True).start().awaitTermination()
    return spark.table("drained")


@pytest.mark.parametrize("name", OPERATORS)
def test_stream_equals_table(spark, sf_dir, name):
    operator = OPERATORS[name]
    want = operator(spark, table(spark, sf_dir, "events"))
    got = drained(spark, operator(spark, table_stream(spark, sf_dir, "events")))
    assert got.columns == want.columns and want.count() > 0
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_coverage_of_a_stream(spark, sf_dir):
    want = label_coverage(well_readings(table(spark, sf_dir, "events")))
    stream = label_coverage(well_readings(table_stream(spark, sf_dir, "events")))
    got = drained(spark, stream, "complete")
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
