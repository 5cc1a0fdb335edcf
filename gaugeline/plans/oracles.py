"""The same results in SQL, over the given tables."""

from __future__ import annotations

from typing import NamedTuple

from gaugeline.plans.tables import DAMAGED, LINE_SENSORS, WELL_COLUMNS
from gaugeline.schema import SENSORS


class _Rule(NamedTuple):
    """A rule as SQL text, written down again here so that the check does not share its values."""

    field: str
    condition: str
    threshold: str
    severity: str
    type: str


RULES = (
    _Rule("h2s_concentration", "h2s_concentration > 10", "10.0", "critical", "h2s_concentration_high"),
    _Rule("vibration_level", "vibration_level > 8", "8.0", "critical", "vibration_level_high"),
    _Rule("wellhead_pressure", "wellhead_pressure < 400", "400.0", "critical", "wellhead_pressure_low"),
    _Rule("water_cut", "water_cut > 85", "85.0", "warning", "water_cut_high"),
    _Rule("motor_current", "motor_current < 1", "1.0", "critical", "motor_current_low"),
    _Rule("sand_rate", "sand_rate > 40", "40.0", "warning", "sand_rate_high"),
    _Rule("casing_pressure", "casing_pressure > 500", "500.0", "critical", "casing_pressure_high"),
)
LINE_RULES = (
    _Rule("l_quantity", "l_quantity > 49", "49.0", "critical", "l_quantity_high"),
    _Rule("l_discount", "l_discount > CAST(0.09 AS DOUBLE)", "0.09", "warning", "l_discount_high"),
    _Rule("l_extendedprice", "l_extendedprice < 1000", "1000.0", "critical", "l_extendedprice_low"),
    _Rule("l_tax", "l_tax > CAST(0.07 AS DOUBLE)", "0.07", "warning", "l_tax_high"),
)
OVERRIDES = (
    ("WELL-AB-001", _Rule("h2s_concentration", "h2s_concentration > 4", "4.0", "critical", "h2s_concentration_high")),
    ("WELL-AB-001", _Rule("water_cut", "water_cut > 60", "60.0", "info", "water_cut_high")),
    ("WELL-AB-003", _Rule("pump_speed", "pump_speed < 6", "6.0", "warning", "pump_speed_low")),
)

# Normal levels in the order of the sensors, written down again for the same reason.
_BASE_ROWS = """
    ('WELL-AB-001', 250, 500, 80, 850, 3200, 200, 750, 35, 95, 32, 24, 2000, 8, 45, 2.5, 5, 3),
    ('WELL-AB-002', 180, 620, 150, 720, 2800, 180, 650, 38, 102, 28, 45, 3400, 10, 52, 3.1, 8, 5),
    ('WELL-AB-003', 420, 380, 40, 980, 3600, 220, 880, 32, 88, 40, 9, 900, 6, 38, 1.8, 3, 1),
    ('WELL-AB-004', 95, 820, 220, 580, 2200, 160, 500, 42, 110, 24, 70, 8600, 12, 60, 4.2, 12, 8),
    ('WELL-AB-005', 310, 450, 110, 790, 3000, 190, 700, 36, 98, 36, 26, 1450, 9, 48, 2.8, 6, 4)
"""

_WELL_LIST = ", ".join(f"{sql} AS {name}" for name, sql in WELL_COLUMNS.items() if name != "timestamp")
_WELLS = (
    "numbered AS (SELECT *, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events), "
    f"wells AS (SELECT event_id, ts, {_WELL_LIST} FROM numbered)"
)
_LINES = (
    "lines AS (SELECT CAST(l_suppkey AS VARCHAR) AS well_id, l_returnflag AS well_status, "
    f"l_shipdate AS ts, {', '.join(LINE_SENSORS)} FROM lineitem)"
)
_SENSOR_LIST = ", ".join(SENSORS)


def _any(rules) -> str:
    return "(" + " OR ".join(rule.condition for rule in rules) + ")"


def _breaches(source: str, rules, keep: str, where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}, '{r.field}' AS field, {r.field} AS \"value\", "
        f"CAST({r.threshold} AS DOUBLE) AS threshold, '{r.severity}' AS severity, "
        f"'{r.type}' AS type FROM {source} WHERE {r.condition} AND {where}"
        for r in rules
    )


def _points(source: str, sensors, keep: str, where: str = "TRUE") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}, coalesce(well_status, 'unknown') AS well_status, "
        f"'well_readings' AS measurement, '{s}' AS field, {s} AS \"value\" "
        f"FROM {source} WHERE {s} IS NOT NULL AND {where}"
        for s in sensors
    )


def _two_fields(breaches: str, keep: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}, 'well_anomalies' AS measurement, type AS anomaly_type, severity, "
        f"'{f}' AS field, \"{f}\" AS \"value\" FROM ({breaches})"
        for f in ("value", "threshold")
    )


_SUBJECT = "'[' || upper(severity) || '] Well ' || well_id || ' - ' || type"
# Limits are whole in all critical rules.
_MESSAGE = (
    "'Production Alert' || chr(10) || repeat('=', 40) || chr(10) || "
    "'Well ID:      ' || well_id || chr(10) || "
    "'Anomaly:      ' || type || chr(10) || "
    "'Severity:     ' || upper(severity) || chr(10) || "
    "'Value:        ' || CAST(\"value\" AS VARCHAR) || chr(10) || "
    "'Threshold:    ' || CAST(CAST(threshold AS BIGINT) AS VARCHAR) || chr(10) || "
    "'Timestamp:    ' || replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00' || "
    "chr(10) || "
    "repeat('=', 40) || chr(10) || 'Action Required: Investigate immediately.'"
)


# Where the time is not known
_MESSAGE_OF_ALERT = _MESSAGE.replace(
    "replace(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f'), '.000000', '') || '+00:00'", "''"
)


def _alerts(breaches: str, keep: str = "") -> str:
    return (
        f"SELECT {keep} well_id, type AS anomaly_type, severity, \"value\", threshold, "
        f"{_SUBJECT} AS subject, {_MESSAGE} AS message FROM ({breaches}) WHERE severity = 'critical'"
    )


def _coverage(source: str, rules, label: str, by: str = "") -> str:
    hit = f"count(*) FILTER (WHERE coalesce({_any(rules)}, FALSE))"
    return (
        f"SELECT {by} {label}, count(*) AS readings, {hit} AS detected, "
        f"CAST({hit} AS DOUBLE) / count(*) AS rate FROM {source} WHERE {label} IS NOT NULL "
        f"GROUP BY {by} {label}"
    )


def _envelope_wells() -> str:
    names = ", ".join(f"raw_{s}" for s in SENSORS)
    doubles = ", ".join(f"CAST(raw_{s} AS DOUBLE) AS base_{s}" for s in SENSORS)
    return (
        f"WITH {_WELLS}, levels(well_id, {names}) AS (VALUES {_BASE_ROWS}), "
        f"base AS (SELECT well_id, {doubles} FROM levels) "
    ) + " UNION ALL ".join(
        f"SELECT event_id, w.well_id, ts, '{s}' AS field, {s} AS \"value\", base_{s} AS baseline, "
        f"({s} - base_{s}) / base_{s} AS deviation FROM wells w JOIN base b ON w.well_id = b.well_id "
        f"WHERE abs({s} - base_{s}) > CAST(0.5 AS DOUBLE) * abs(base_{s})"
        for s in SENSORS
    )


def _with_overrides(keep: str) -> str:
    own = [
        _breaches("wells", [rule], keep, f"well_id = '{well}'") for well, rule in OVERRIDES
    ]
    rest = []
    for rule in RULES:
        wells = [well for well, other in OVERRIDES if other.type == rule.type]
        where = " AND ".join(f"coalesce(well_id, '') <> '{well}'" for well in wells) or "TRUE"
        rest.append(_breaches("wells", [rule], keep, where))
    return " UNION ALL ".join(own + rest)


def _panel(sensor: str) -> str:
    recent = "ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'"
    return f"WITH {_WELLS} " + _points("wells", [sensor], "event_id, ts, well_id", recent)


_MESSAGE_TEXT = f"CASE WHEN {DAMAGED} THEN substr(props, 1, 4) ELSE props END"
_DEAD = (
    f"SELECT {_MESSAGE_TEXT} AS raw, 'malformed or mistyped JSON' AS error, ts AS dead_ts, "
    "'events' AS topic, CAST(0 AS INTEGER) AS \"partition\", event_id AS \"offset\" "
    f"FROM events WHERE NOT json_valid({_MESSAGE_TEXT})"
)
_WHOLE = f"NOT ({DAMAGED})"
_LINE_BREACHES = _breaches("lines", LINE_RULES, "well_id, ts")
_WELL_BREACHES = _breaches("wells", RULES, "event_id, well_id, ts")

_LATE = "event_id % 13 = 5"
_LATE_OR_KEPT = f"{_WHOLE} AND ({_LATE} OR ts >= TIMESTAMP '2024-01-24')"
NEW_RULES = (
    _Rule("h2s_concentration", "h2s_concentration > 4", "4.0", "critical", "h2s_concentration_high"),
    _Rule("water_cut", "water_cut > 85", "85.0", "info", "water_cut_high"),
    _Rule("pump_speed", "pump_speed < 6", "6.0", "warning", "pump_speed_low"),
)

_PIPELINE_BREACHES = _breaches("wells", RULES, 'event_id AS "offset", well_id', _WHOLE)

ORACLES = {
    "parse_messages": (
        "SELECT 'events' AS topic, CAST(0 AS INTEGER) AS \"partition\", event_id AS \"offset\", "
        "CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
    ),
    "parse_well_messages": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", ts, well_id, well_status, {_SENSOR_LIST}, "
        f"anomaly_type FROM wells WHERE {_WHOLE}"
    ),
    "dead_letter": _DEAD,
    "dead_letter_trailing": (
        "SELECT props || CASE WHEN event_id % 2 = 0 THEN '] x' ELSE ']' || props END AS raw, "
        f"'text after the JSON object' AS error, event_id AS \"offset\" FROM events WHERE {DAMAGED}"
    ),
    "dead_letter_body": (
        "SELECT raw AS reading, error, replace(strftime(dead_ts, '%Y-%m-%dT%H:%M:%S.%f'), "
        f"'.000000', '') || '+00:00' AS \"timestamp\" FROM ({_DEAD})"
    ),
    "replay_dead_letters": (
        "SELECT event_id AS \"offset\", CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events"
    ),
    "encode_roundtrip": "SELECT event_id, ts, user_id, event_type, \"value\", props FROM events",
    "encode_messages": (
        "SELECT CAST(user_id AS VARCHAR) AS message_key, CAST(event_id AS VARCHAR) AS event_id, "
        "event_type, props FROM events"
    ),
    "detect_any": f"WITH {_LINES} SELECT * FROM lines WHERE {_any(LINE_RULES)}",
    "detect_any_wells": (
        f"WITH {_WELLS} SELECT event_id, well_id, {_SENSOR_LIST} FROM wells WHERE {_any(RULES)}"
    ),
    "detect_breaches": f"WITH {_LINES} {_LINE_BREACHES}",
    "detect_breaches_wells": f"WITH {_WELLS} {_WELL_BREACHES}",
    "detect_rule_table": f"WITH {_LINES} {_LINE_BREACHES}",
    "detect_rule_table_wells": f"WITH {_WELLS} {_WELL_BREACHES}",
    "critical_alerts": f"WITH {_LINES} {_alerts(_LINE_BREACHES)}",
    "critical_alerts_wells": f"WITH {_WELLS} {_alerts(_WELL_BREACHES, 'event_id,')}",
    "detect_rule_table_overrides": f"WITH {_WELLS} {_with_overrides('event_id, well_id, ts')}",
    "baseline_envelope": (
        "WITH r AS (SELECT l_partkey AS well_id, l_shipdate AS ts, "
        "l_extendedprice / l_quantity AS unit_price FROM lineitem) "
        "SELECT r.well_id, r.ts, 'unit_price' AS field, unit_price AS \"value\", "
        "p_retailprice AS baseline, (unit_price - p_retailprice) / nullif(p_retailprice, 0) AS deviation "
        "FROM r JOIN part ON p_partkey = r.well_id "
        "WHERE abs(unit_price - p_retailprice) > 1.0 * abs(p_retailprice)"
    ),
    "baseline_envelope_wells": _envelope_wells(),
    "baseline_documents": (
        "SELECT CAST(p_partkey AS VARCHAR) AS well_id, 'size' AS sensor, "
        "CAST(p_size AS DOUBLE) AS baseline FROM part UNION ALL "
        "SELECT CAST(p_partkey AS VARCHAR), 'price', p_retailprice FROM part"
    ),
    "label_coverage": f"WITH {_LINES} {_coverage('lines', LINE_RULES, 'well_status')}",
    "label_coverage_wells": f"WITH {_WELLS} {_coverage('wells', RULES, 'anomaly_type', 'well_id,')}",
    "points_long": f"WITH {_LINES} {_points('lines', LINE_SENSORS, 'ts, well_id')}",
    "points_long_wells": f"WITH {_WELLS} {_points('wells', SENSORS, 'event_id, ts, well_id')}",
    "breach_points": f"WITH {_WELLS} {_two_fields(_WELL_BREACHES, 'event_id, ts, well_id')}",
    "panel_field": (
        "SELECT ts, user_id AS well_id, 'events' AS measurement, event_type AS field, \"value\" "
        "FROM events WHERE event_type = 'view' "
        "AND ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-31'"
    ),
    "panel_wellhead_pressure": _panel("wellhead_pressure"),
    "panel_water_cut": _panel("water_cut"),
    "panel_oil_flow_rate": _panel("oil_flow_rate"),
    "panel_h2s_concentration": _panel("h2s_concentration"),
    "panel_vibration_level": _panel("vibration_level"),
    "panel_anomalies": f"WITH {_LINES} "
    + _two_fields(
        _breaches(
            "lines",
            LINE_RULES,
            "well_id, ts",
            "ts >= TIMESTAMP '2000-11-05' AND ts < TIMESTAMP '2001-11-05'",
        ),
        "ts, well_id",
    ),
    "panel_anomalies_wells": f"WITH {_WELLS} "
    + _two_fields(
        _breaches(
            "wells",
            RULES,
            "well_id, ts",
            "ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-31'",
        ),
        "ts, well_id",
    ),
    "archive_pruned_read": (
        "SELECT event_id, CAST(user_id AS VARCHAR) AS well_id, ts, event_type, \"value\" "
        "FROM events WHERE user_id IN (5, 17, 42)"
    ),
    "retention": "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-24'",
    "retention_archive": f"WITH {_LINES} SELECT * FROM lines WHERE ts >= TIMESTAMP '2001-08-07'",
    "retention_dead_letters": f"SELECT * FROM ({_DEAD}) WHERE dead_ts >= TIMESTAMP '2024-01-17'",
    "retention_partitions": (
        "SELECT event_id, ts, \"value\" FROM events WHERE ts >= TIMESTAMP '2024-01-24'"
    ),
    "stream_archive": (
        "SELECT event_id, ts, CAST(user_id AS VARCHAR) AS well_id, event_type, \"value\", props FROM events"
    ),
    "stream_anomalies": f"WITH {_LINES} SELECT * FROM lines WHERE {_any(LINE_RULES)}",
    "pipeline_raw": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, well_status, {_SENSOR_LIST}, "
        f"anomaly_type FROM wells WHERE {_WHOLE}"
    ),
    "pipeline_dead_letters": (
        "SELECT '{\"we' AS raw, 'malformed or mistyped JSON' AS error, ts AS dead_ts, 'readings' AS topic, "
        f"CAST(0 AS INTEGER) AS \"partition\", event_id AS \"offset\" FROM events WHERE {DAMAGED}"
    ),
    "pipeline_replay": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", ts, well_id, well_status, {_SENSOR_LIST}, "
        "anomaly_type FROM wells"
    ),
    "pipeline_replay_after_retention": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, {_SENSOR_LIST} FROM wells "
        f"WHERE {DAMAGED} AND ts >= TIMESTAMP '2024-01-24'"
    ),
    "stream_replay": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, {_SENSOR_LIST} FROM wells WHERE {DAMAGED}"
    ),
    "pipeline_anomalies": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, {_SENSOR_LIST} FROM wells "
        f"WHERE {_any(RULES)} AND {_WHOLE}"
    ),
    "pipeline_points": (
        f"WITH {_WELLS} {_points('wells', SENSORS, 'ts, ts AS ingest_ts, well_id', _WHOLE)}"
    ),
    "pipeline_anomaly_panel": f"WITH {_WELLS} "
    + _two_fields(
        _breaches(
            "wells",
            RULES,
            "well_id, ts",
            f"{_WHOLE} AND ts >= TIMESTAMP '2024-01-29' AND ts < TIMESTAMP '2024-01-31'",
        ),
        "ts, well_id",
    ),
    "pipeline_panel": (
        f"WITH {_WELLS} SELECT ts, well_id, coalesce(well_status, 'unknown') AS well_status, "
        "wellhead_pressure AS \"value\" FROM wells "
        f"WHERE {_WHOLE} AND ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'"
    ),
    "pipeline_breaches": f"WITH {_WELLS} {_PIPELINE_BREACHES}",
    "pipeline_alerts": (
        f"WITH {_WELLS} SELECT sha256('readings|0|' || \"offset\" || '|' || type) AS alert_id, well_id, "
        f"type AS anomaly_type, severity, \"value\", threshold, {_SUBJECT} AS subject, "
        f"regexp_replace({_MESSAGE_OF_ALERT}, 'Timestamp: [^\n]*', 'Timestamp:') AS message "
        f"FROM ({_PIPELINE_BREACHES}) WHERE severity = 'critical'"
    ),
    "pipeline_late_retention": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, {_SENSOR_LIST} FROM wells WHERE {_LATE_OR_KEPT}"
    ),
    "pipeline_alerts_late": (
        f"WITH {_WELLS} SELECT sha256('readings|0|' || \"offset\" || '|' || type) AS alert_id, well_id, "
        f"type AS anomaly_type, \"value\", threshold, {_SUBJECT} AS subject FROM ("
        + _breaches("wells", RULES, 'event_id AS "offset", well_id', _LATE_OR_KEPT)
        + ") WHERE severity = 'critical'"
    ),
    "archive_compacted_read": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, well_status, {_SENSOR_LIST}, anomaly_type "
        f"FROM wells WHERE {_WHOLE} AND well_id IN ('WELL-AB-001', 'WELL-AB-004')"
    ),
    "pipeline_panel_compacted": (
        f"WITH {_WELLS} SELECT ts, well_id, coalesce(well_status, 'unknown') AS well_status, "
        "wellhead_pressure AS \"value\" FROM wells "
        f"WHERE {_WHOLE} AND ts >= TIMESTAMP '2024-01-30' AND ts < TIMESTAMP '2024-01-31'"
    ),
    "backfill_new_rules": (
        f"WITH {_WELLS} " + _breaches("wells", NEW_RULES, 'event_id AS "offset", well_id', _WHOLE)
    ),
    "parse_extra_fields": (
        f"WITH {_WELLS} SELECT event_id AS \"offset\", well_id, well_status, {_SENSOR_LIST}, anomaly_type, "
        "CAST(CASE WHEN event_id % 5 = 0 THEN 2 ELSE 0 END AS INTEGER) AS n_others, "
        "CASE WHEN event_id % 5 = 0 THEN 'v' || (event_id % 3) END AS firmware, "
        "CASE WHEN event_id % 5 = 0 THEN event_id * 5e-1 END AS volts FROM wells"
    ),
    "pipeline_delivered": (
        f"WITH {_WELLS} SELECT sha256('readings|0|' || \"offset\" || '|' || type) AS alert_id, well_id, "
        f"type AS anomaly_type, \"value\", threshold, {_SUBJECT} AS subject "
        f"FROM ({_PIPELINE_BREACHES}) WHERE severity = 'critical'"
    ),
    "stream_rule_change": (
        f"WITH {_WELLS} "
        + _breaches("wells", RULES, 'event_id AS "offset", well_id', f"{_WHOLE} AND NOT ({_LATE})")
        + " UNION ALL "
        + _breaches("wells", NEW_RULES, 'event_id AS "offset", well_id', f"{_WHOLE} AND {_LATE}")
    ),
    "stream_label_coverage": (
        f"WITH {_WELLS}, whole AS (SELECT * FROM wells WHERE {_WHOLE}) "
        + _coverage("whole", RULES, "anomaly_type", "well_id,")
    ),
}
