"""Alert feed: one alert per critical breach."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeline.functions.text import iso_utc, limit_text, number_text
from gaugeline.schema import RULES, SOURCE_KEYS, Rule

CRITICAL = "critical"


def critical_rules(rules: Iterable[Rule] = RULES) -> list[Rule]:
    """Rules worth an alert. Detecting with these alone skips readings that only warn at the scan."""
    return [rule for rule in rules if rule.severity == CRITICAL]


def critical_alerts(
    breaches: DataFrame,
    alert_ts: Column | None = None,
    heading: str = "Production Alert",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(*keep, well_id, anomaly_type, severity, value, threshold, alert_ts, subject, message).

    ``alert_ts`` is when the alert is made, now by default. Breaches that carry their source
    position get an ``alert_id`` that stays the same when a message is processed again.
    """
    severity = F.upper("severity")
    created = F.current_timestamp() if alert_ts is None else alert_ts
    rule_line = F.repeat(F.lit("="), F.lit(40))
    # Subject and message format.
    subject = F.format_string("[%s] Well %s - %s", severity, F.col("well_id"), F.col("type"))
    message = F.concat_ws(
        "\n",
        F.lit(heading),
        rule_line,
        F.concat(F.lit("Well ID:      "), "well_id"),
        F.concat(F.lit("Anomaly:      "), "type"),
        F.concat(F.lit("Severity:     "), severity),
        F.concat(F.lit("Value:        "), number_text(F.col("value"))),
        F.concat(F.lit("Threshold:    "), limit_text(F.col("threshold"))),
        F.concat(F.lit("Timestamp:    "), iso_utc(created)),
        rule_line,
        F.lit("Action Required: Investigate immediately."),
    )
    identity = []
    if set(SOURCE_KEYS) <= set(breaches.columns):
        identity = [F.sha2(F.concat_ws("|", *SOURCE_KEYS, "type"), 256).alias("alert_id")]
    return breaches.filter(F.col("severity") == CRITICAL).select(
        *keep,
        *identity,
        "well_id",
        F.col("type").alias("anomaly_type"),
        "severity",
        "value",
        "threshold",
        created.alias("alert_ts"),
        subject.alias("subject"),
        message.alias("message"),
    )
