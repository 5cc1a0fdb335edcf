"""Plans that must hold at scale: pushed filters, pruned columns, no needless shuffles."""

from datetime import datetime, timezone

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from gaugeline.operators.coverage import label_coverage
from gaugeline.operators.detect import detect_any, detect_breaches, detect_with_rule_table, rule_table
from gaugeline.operators.envelope import out_of_envelope
from gaugeline.operators.panels import sensor_panel, sensor_panel_of_readings
from gaugeline.operators.points import to_points
from gaugeline.plans.queries import QUERIES
from gaugeline.plans.tables import table, well_readings
from gaugeline.schema import SENSORS
from gaugeline.session import scratch_path
from gaugeline.sources.archive import BUCKET_LAYOUT, with_partitions, write_archive
from gaugeline.sources.baselines import default_baselines

AS_OF = datetime(2024, 1, 31, tzinfo=timezone.utc)


def plan(df):
    return df._jdf.queryExecution().explainString(
        df._sc._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


@pytest.fixture(scope="module")
def stored(spark, sf_dir):
    path = scratch_path(spark, "readings")
    well_readings(table(spark, sf_dir, "events")).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("detect", [detect_any, detect_breaches])
def test_detection_reaches_the_scan(stored, detect):
    text = plan(detect(stored))
    assert "GreaterThan(h2s_concentration,10.0),LessThanOrEqual(h2s_concentration,Infinity)" in text
    assert "LessThan(motor_current,1.0)" in text
    assert "Exchange" not in text


def test_breaches_read_only_what_they_use(stored):
    schema = plan(detect_breaches(stored)).split("ReadSchema: ")[1].split("\n")[0]
    assert "h2s_concentration" in schema and "oil_flow_rate" not in schema


def test_breaches_and_points_stay_in_generated_code(stored):
    for df in (detect_breaches(stored), to_points(stored, keep=("ts", "well_id"))):
        tree = df._jdf.queryExecution().executedPlan().toString()
        assert tree.count("*(1)") >= 3 and "Exchange" not in tree


def own_rules(spark):
    rows = [("water_cut", "max", 60.0, "info", well) for well in ("WELL-AB-001", "WELL-AB-002")]
    return spark.createDataFrame(
        rows, "field string, kind string, threshold double, severity string, well_id string"
    )


def test_rules_and_baselines_are_broadcast(spark, stored):
    own = own_rules(spark)
    for df in (
        detect_with_rule_table(stored, own),
        out_of_envelope(stored, default_baselines(spark)),
    ):
        text = plan(df)
        assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    assert "Join" not in plan(detect_with_rule_table(stored, rule_table(spark)))


def test_each_reading_joins_its_rules_once(spark, stored):
    own = own_rules(spark)
    tree = detect_with_rule_table(stored, own)._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Generate explode") == 1
    assert tree.index("Generate explode") < tree.index("BroadcastHashJoin")


def test_each_reading_joins_its_baselines_once(spark, stored):
    tree = out_of_envelope(stored, default_baselines(spark))._jdf.queryExecution().executedPlan().toString()
    assert tree.index("Generate stack(17") < tree.index("BroadcastHashJoin")


def test_coverage_combines_before_the_shuffle(stored):
    tree = label_coverage(stored)._jdf.queryExecution().executedPlan().toString()
    assert tree.count("Exchange") == 1
    assert tree.index("partial_count") > tree.index("Exchange")


def test_panel_of_readings_reads_one_sensor_of_the_range(stored):
    text = plan(sensor_panel_of_readings(stored, "water_cut", AS_OF))
    schema = text.split("ReadSchema: ")[1].split("\n")[0]
    assert [s for s in SENSORS if s in schema] == ["water_cut"]
    assert "GreaterThanOrEqual(ts,2024-01-30T23:55)" in text and "LessThan(ts,2024-01-31T00:00)" in text


def test_panel_of_points_is_pushed_down(spark, stored):
    path = scratch_path(spark, "points")
    points = to_points(stored, keep=("ts", "well_id")).withColumn("date", F.to_date("ts"))
    points.coalesce(1).write.partitionBy("measurement", "date").parquet(path)
    text = plan(sensor_panel(spark.read.parquet(path), "water_cut", AS_OF))
    pruned = text.split("PartitionFilters: ")[1].split("\n")[0]
    assert "measurement" in pruned and "2024-01-30" in pruned and "2024-01-31" in pruned
    pushed = text.split("PushedFilters: ")[1].split("\n")[0]
    assert "EqualTo(field,water_cut)" in pushed and "GreaterThanOrEqual(ts" in pushed


def test_archive_files_are_sorted(spark, sf_dir):
    """Wells are in order within each written file."""
    path = scratch_path(spark, "archive")
    rows = table(spark, sf_dir, "events").withColumn("well_id", F.col("user_id").cast("string"))
    write_archive(with_partitions(rows, buckets=2), path, BUCKET_LAYOUT)
    back = spark.read.parquet(path).select(
        F.input_file_name().alias("file"), "well_id", "ts", F.monotonically_increasing_id().alias("n")
    )
    order = Window.partitionBy("file").orderBy("n")
    before = F.lag(F.struct("well_id", "ts")).over(order)
    assert back.withColumn("before", before).filter(F.struct("well_id", "ts") < F.col("before")).count() == 0


NO_SHUFFLE = [
    "parse_messages", "parse_well_messages", "dead_letter", "encode_roundtrip", "encode_messages",
    "detect_any", "detect_any_wells", "detect_breaches", "detect_breaches_wells", "detect_rule_table",
    "critical_alerts", "points_long", "points_long_wells", "breach_points", "panel_field",
    "panel_water_cut", "panel_anomalies", "panel_anomalies_wells", "retention", "retention_archive",
    "retention_dead_letters", "baseline_documents",
]


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_row_by_row_queries_do_not_shuffle(spark, sf_dir, name):
    tree = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in tree.replace("BroadcastExchange", "")
    assert "CartesianProduct" not in tree and "NestedLoop" not in tree and "Python" not in tree
