"""DuckDB SQL of the queries of plans.telemetry."""

from __future__ import annotations

_U = "right(regexp_replace(lower(event_id), '[^0-9a-f]', '', 'g'), 32)"
_ID = f"(CASE WHEN trim(coalesce(event_id, '')) = '' THEN NULL ELSE concat_ws('-', substr({_U}, 1, 8), substr({_U}, 9, 4), substr({_U}, 13, 4), substr({_U}, 17, 4), substr({_U}, 21, 12)) END)"
_TS = "(CAST(\"timestamp\" AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%S.%fZ')".format
_NAN = "({0} IS NULL OR isnan({0}) OR isinf({0}))".format
_NUM = ("flow_rate", "water_cut", "motor_temperature", "motor_current", "vibration")
_OPT = ("intake_pressure", "discharge_pressure", "tubing_pressure", "casing_pressure", "intake_temperature", "pump_frequency")
_TEXT = ("event_id", '"timestamp"', "esp_id", "source", "run_id", "status")


def _case(reason: bool) -> str:
    pick = lambda rule, why: why if reason else f"'{rule}'"
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    w = [("schema_version IS DISTINCT FROM 1", pick("SCHEMA_VERSION_UNSUPPORTED", "'schema_version ' || coalesce(schema_version::VARCHAR, 'None') || ' is not supported (expected 1)'"))]
    w += [(f"coalesce({c}, '') = ''", pick("MISSING_FIELD", quote(f"required field '{c.strip(chr(34))}' is missing"))) for c in _TEXT]
    w += [
        ("esp_id NOT IN (SELECT esp_id FROM pump_metadata WHERE esp_id IS NOT NULL)", pick("UNKNOWN_ESP_ID", "'esp_id ''' || esp_id || ''' is not a registered pump'")),
        ("source NOT IN ('historical', 'realtime')", pick("INVALID_SOURCE", "'source ''' || source || ''' must be one of [''historical'', ''realtime'']'")),
        ("status NOT IN ('RUNNING', 'SHUTDOWN', 'UNKNOWN')", pick("INVALID_STATUS", "'status ''' || status || ''' must be one of [''RUNNING'', ''SHUTDOWN'', ''UNKNOWN'']'")),
        ("try_cast(\"timestamp\" AS TIMESTAMPTZ) IS NULL", pick("INVALID_TIMESTAMP", "'timestamp is not a UTC ISO-8601 value'")),
    ]
    w += [(_NAN(c), pick("NON_FINITE_NUMBER", quote(f"field '{c}' must be a finite number"))) for c in _NUM]
    w.append(("water_cut NOT BETWEEN 0 AND 1", pick("OUT_OF_RANGE", "'water_cut must be within 0..1'")))
    w += [(f"{c} < 0", pick("OUT_OF_RANGE", f"'{c} must be >= 0'")) for c in ("flow_rate", "motor_current", "vibration")]
    w += [(f"{c} IS NOT NULL AND {_NAN(c)}", pick("NON_FINITE_NUMBER", quote(f"optional field '{c}' must be a finite number or null"))) for c in _OPT]
    return "CASE " + " ".join(f"WHEN {a} THEN {b}" for a, b in w) + " ELSE " + ("'valid'" if reason else "'OK'") + " END"


_V = f"v AS (SELECT *, {_ID} AS id, {_TS} AS ts, {_case(False)} AS rule_id, {_case(True)} AS reason FROM telemetry)"
_SCOPE = "CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-02'"
#: A payload is compared as text; numbers as their bits would be, by their shortest form.
_PAY = "concat_ws('|', " + ", ".join(
    f"coalesce(({c})::VARCHAR, '~')" for c in ("schema_version", "id", "ts", "esp_id", "source", "run_id", "status", "scenario", *_NUM, *_OPT)
) + ")"
_D = f"""{_V},
e AS (SELECT *, {_PAY} AS payload FROM v WHERE rule_id = 'OK' AND {_SCOPE}),
k AS (SELECT *, count(*) OVER (PARTITION BY id) AS n, min(payload) OVER (PARTITION BY id) <> max(payload) OVER (PARTITION BY id) AS conflict,
  row_number() OVER (PARTITION BY id ORDER BY source_uri, ingested_at NULLS FIRST) AS rn FROM e),
d AS (SELECT * EXCLUDE (payload), CASE WHEN conflict THEN 'CONFLICT' WHEN rn = 1 THEN 'SILVER' ELSE 'DUPLICATE' END AS disposition FROM k
  UNION ALL BY NAME SELECT *, CASE WHEN rule_id <> 'OK' THEN 'INVALID' ELSE 'OUT_OF_SCOPE' END AS disposition FROM v WHERE NOT (rule_id = 'OK' AND coalesce({_SCOPE}, false))),
dim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY esp_id ORDER BY metadata_version DESC) AS k FROM pump_metadata) WHERE k = 1),
s AS (SELECT d.* EXCLUDE (event_id, "timestamp"), d.id AS event_id, {_ISO('d.ts')} AS "timestamp", CAST(d.ts AS DATE) AS event_date, m.metadata_version, m.field, m.min_flow_rate, m.max_motor_temperature, m.baseline_liquid_rate_m3_day
  FROM d LEFT JOIN dim AS m ON m.esp_id = d.esp_id WHERE disposition = 'SILVER')"""
_R = "round({} + 1e-9, 6)".format
_GOLD = f"""g AS (SELECT event_date, esp_id, field, metadata_version, count(*)::BIGINT AS sample_count, avg(flow_rate) AS flow, avg(flow_rate * (1 - water_cut)) AS oil, avg(motor_temperature) AS temp,
  max(vibration) AS peak_vibration_mm_s, coalesce(sum(CASE WHEN flow_rate < min_flow_rate OR motor_temperature > max_motor_temperature THEN 1 ELSE 0 END), 0)::BIGINT AS warning_samples,
  baseline_liquid_rate_m3_day AS base FROM s GROUP BY event_date, esp_id, field, metadata_version, baseline_liquid_rate_m3_day),
q AS (SELECT *, greatest(0.0, coalesce((base - flow) / nullif(base, 0), 0.0)) AS deficit FROM g)"""
_RT = f"""rt AS (SELECT *, epoch_us(ingested_at) AS arrived FROM v WHERE rule_id = 'OK' AND source = 'realtime' AND ingested_at IS NOT NULL)"""
_L = f"""{_V}, {_RT},
l AS (SELECT * REPLACE (coalesce(scenario, 'unknown') AS scenario) FROM (SELECT *, row_number() OVER (PARTITION BY esp_id ORDER BY ts DESC, ingested_at, id DESC) AS k FROM rt) WHERE k = 1)"""
_HOLD = {
    "SHUTDOWN": "status = 'SHUTDOWN'", "LOW_FLOW_OVERHEAT": "flow_rate < 60 AND motor_temperature > 120", "HIGH_VIBRATION_CURRENT": "vibration > 12 AND motor_current > 75",
    "HIGH_TUBING_LOW_FLOW": "coalesce(tubing_pressure, 0) > 900 AND flow_rate < 60", "GAS_SLUG_SIMULATION": "coalesce(scenario, '') = 'gas_slug'",
}
_SEV = "CASE WHEN status = 'SHUTDOWN' OR (flow_rate < 60 AND motor_temperature > 120) OR (vibration > 12 AND motor_current > 75) THEN 'critical' WHEN flow_rate < 60 THEN 'warning' {} ELSE 'normal' END"
_SHOWN, _HOSTED = _SEV.format("WHEN scenario = 'low_flow' THEN 'warning'"), _SEV.format("")
_BY_RULE = " UNION ALL ".join(f"SELECT esp_id, ts, event_id, '{r}' AS rule_id, ({c}) AS hit FROM s WHERE source = 'realtime'" for r, c in _HOLD.items())
_ALERT = f"""{_D}, b AS ({_BY_RULE}),
w AS (SELECT *, coalesce(lag(hit) OVER (PARTITION BY esp_id, rule_id ORDER BY ts, event_id), false) AS was FROM b),
f AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY esp_id, rule_id ORDER BY ts, event_id) AS rn FROM w WHERE hit OR was),
z AS (SELECT esp_id, rule_id, rn, ts, event_id, 'trigger' AS kind, ts + INTERVAL 300 SECOND AS until, event_id AS episode FROM f WHERE rn = 1
  UNION ALL SELECT f.esp_id, f.rule_id, f.rn, f.ts, f.event_id, CASE WHEN NOT f.hit THEN 'recovery' WHEN NOT f.was OR f.ts >= z.until THEN 'trigger' ELSE 'suppressed' END,
  CASE WHEN f.hit AND (NOT f.was OR f.ts >= z.until) THEN f.ts + INTERVAL 300 SECOND ELSE z.until END, CASE WHEN f.hit AND NOT f.was THEN f.event_id ELSE z.episode END
  FROM z JOIN f ON f.esp_id = z.esp_id AND f.rule_id = z.rule_id AND f.rn = z.rn + 1)"""
_ALERT = "WITH RECURSIVE " + _ALERT


def _uuid5(namespace: str, name: str) -> str:
    h = f"sha1(unhex('{namespace.replace('-', '')}') || encode({name}))"
    return f"(SELECT concat_ws('-', substr(h, 1, 8), substr(h, 9, 4), '5' || substr(h, 14, 3), substr('89ab89ab89ab89ab', instr('0123456789abcdef', substr(h, 17, 1)), 1) || substr(h, 18, 3), substr(h, 21, 12)) FROM (SELECT {h} AS h))"


_EVENTS, _ALERTS = "2f1b1a54-8f9a-4a9a-9b9e-6e8a2f6a9b30", "7c3a9f1e-2b6d-4b8b-9b0a-0f7f2a6a5b40"
_LABEL = "CASE rule_id WHEN 'SHUTDOWN' THEN 'pump shutdown' WHEN 'LOW_FLOW_OVERHEAT' THEN 'low flow + motor overheating' WHEN 'HIGH_VIBRATION_CURRENT' THEN 'high vibration + elevated current' WHEN 'HIGH_TUBING_LOW_FLOW' THEN 'high tubing pressure + low flow' ELSE 'gas-slug simulation' END"
_TREND = f"""{_D}, t AS (SELECT esp_id, event_id, flow_rate, count(*) OVER w AS points, sum(flow_rate) OVER w AS total, min(flow_rate) OVER w AS low, max(flow_rate) OVER w AS high
  FROM s WHERE source = 'realtime' AND flow_rate IS NOT NULL WINDOW w AS (PARTITION BY esp_id ORDER BY ts, event_id ROWS 23 PRECEDING))"""
_LANES = ", ".join(f"coalesce(sum(('0x' || substr(h, {8 * i + 1}, 8))::BIGINT), 0)::VARCHAR" for i in range(8))

SQL = {
    "daily_kpi": f"WITH {_D} SELECT esp_id, event_date::VARCHAR AS event_date, count(*)::BIGINT AS samples, {_R('avg(flow_rate)')} AS avg_liquid_rate_m3_day, {_R('avg(flow_rate * (1 - water_cut))')} AS avg_oil_rate_m3_day, {_R('avg(motor_temperature)')} AS avg_motor_temperature_c, max(vibration) AS peak_vibration_mm_s FROM s GROUP BY esp_id, event_date",
    "quality_checks": f"WITH {_D} SELECT count(*)::BIGINT AS rows_seen, count(DISTINCT event_id)::BIGINT AS distinct_event_ids, count(DISTINCT esp_id)::BIGINT AS pumps, count(*) FILTER (ts IS NULL)::BIGINT AS invalid_timestamps, count(*) FILTER (water_cut IS NULL OR water_cut NOT BETWEEN 0 AND 1)::BIGINT AS invalid_water_cut, count(*) FILTER (flow_rate IS NULL OR flow_rate < 0)::BIGINT AS invalid_flow, count(*) FILTER (metadata_version IS NULL)::BIGINT AS missing_metadata, count(DISTINCT source_kind)::BIGINT AS source_kinds FROM s",
    "contract_verdicts": f'WITH {_V} SELECT source_uri, event_id, "timestamp", rule_id, reason FROM v',
    "rejections_by_rule": f"WITH {_V} SELECT source_kind, rule_id, count(*)::BIGINT AS n FROM v WHERE rule_id <> 'OK' GROUP BY 1, 2",
    "union_sources": "SELECT source_kind, count(*)::BIGINT AS n, (count(scenario) FILTER (source_kind = 'realtime_json'))::BIGINT AS n_scenario FROM telemetry WHERE source_kind IN ('historical_csv', 'realtime_json') GROUP BY 1",
    "window_lookback": f"WITH {_V} SELECT {_SCOPE} AS in_scope, count(*)::BIGINT AS n FROM v WHERE rule_id = 'OK' GROUP BY 1",
    "identity_profile": f"WITH {_D} SELECT id AS event_id, count(*)::BIGINT AS n, bool_or(conflict) AS conflict FROM k GROUP BY id HAVING count(*) > 1",
    "silver_canonical": f'WITH {_D} SELECT event_id, "timestamp", esp_id, source, status, flow_rate, source_uri, field, metadata_version FROM s',
    "identity_conflicts": f"WITH {_D} SELECT source_uri, id AS event_id, 'DUPLICATE_EVENT_ID_CONFLICT' AS rule_id FROM d WHERE disposition = 'CONFLICT'",
    "quarantine_events": f"WITH {_D} SELECT source_uri, id AS event_id, rule_id, reason FROM d WHERE disposition = 'INVALID' UNION ALL SELECT source_uri, id, 'DUPLICATE_EVENT_ID_CONFLICT', 'same event_id has different normalized payloads' FROM d WHERE disposition = 'CONFLICT'",
    "row_accounting": f"WITH {_D} SELECT count(*)::BIGINT AS input_rows, " + ", ".join(f"count(*) FILTER (disposition = '{x}')::BIGINT AS {x.lower()}_rows" for x in ("INVALID", "OUT_OF_SCOPE", "CONFLICT", "DUPLICATE", "SILVER")) + " FROM d",
    "dataset_digest": f"WITH {_D}, h AS (SELECT sha256(concat_ws('|', event_id, \"timestamp\", esp_id, source_uri)) AS h FROM s) SELECT count(*)::BIGINT AS n, sha256(count(*)::VARCHAR || '|' || concat_ws(':', {_LANES})) AS digest FROM h",
    "dim_enriched": f"WITH {_D} SELECT esp_id, field, metadata_version, count(*)::BIGINT AS n FROM s GROUP BY 1, 2, 3",
    "missing_metadata": "SELECT esp_id, count(*)::BIGINT AS n FROM telemetry WHERE esp_id IS NULL OR esp_id NOT IN (SELECT esp_id FROM pump_metadata WHERE esp_id IS NOT NULL) GROUP BY 1",
    "gold_daily": f"WITH {_D}, {_GOLD} SELECT event_date::VARCHAR AS event_date, esp_id, field, metadata_version, sample_count, {_R('flow')} AS avg_liquid_rate_m3_day, {_R('oil')} AS avg_oil_rate_m3_day, {_R('temp')} AS avg_motor_temperature_c, peak_vibration_mm_s, warning_samples, {_R('sample_count / 24.0::DOUBLE')} AS sample_coverage, warning_samples * 60 AS warning_duration_minutes, greatest(0, 24 - sample_count) * 60 AS missing_data_minutes, {_R('deficit')} AS relative_flow_deficit FROM q",
    "kpi_top250": f"WITH {_D}, {_GOLD} SELECT event_date::VARCHAR AS event_date, esp_id, sample_count AS samples, peak_vibration_mm_s, {_R('deficit')} AS relative_flow_deficit FROM q ORDER BY q.event_date DESC, esp_id LIMIT 250",
    "source_kind_counts": f"WITH {_D} SELECT source_kind, count(*)::BIGINT AS n FROM s GROUP BY 1",
    "latest_state": f'WITH {_L} SELECT esp_id, {_ISO("ts")} AS "timestamp", status, scenario, flow_rate, motor_temperature FROM l',
    "state_outcomes": f"""WITH {_V}, {_RT}, o AS (SELECT esp_id, CASE WHEN coalesce(ts > max(ts) OVER (PARTITION BY esp_id ORDER BY ingested_at, source_uri, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 'processed' ELSE 'superseded' END AS outcome FROM rt)
SELECT esp_id, outcome, count(*)::BIGINT AS n FROM o GROUP BY 1, 2""",
    "derived_severity": f"WITH {_L} SELECT esp_id, {_SHOWN} AS severity, {_HOSTED} AS hosted_severity FROM l",
    "severity_filter": f"WITH {_L} SELECT esp_id, {_SHOWN} AS severity FROM l WHERE {_SHOWN} <> 'normal'",
    "fleet_kpis": f"WITH {_L} SELECT count(*) FILTER (status = 'RUNNING')::BIGINT AS running, round(sum(coalesce(flow_rate, 0)), 2) AS total_flow, {_R('coalesce(avg(motor_temperature), 0)')} AS mean_temperature FROM l",
    "active_anomalies": f"WITH {_L}, dim AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY esp_id ORDER BY metadata_version DESC) AS k FROM pump_metadata) WHERE k = 1), a AS (SELECT dim.field, l.esp_id || ' ' || upper({_SHOWN}) AS t FROM l LEFT JOIN dim ON dim.esp_id = l.esp_id WHERE {_SHOWN} <> 'normal') SELECT field, string_agg(t, ' | ' ORDER BY t) AS anomalies FROM a GROUP BY field",
    "rolling_trend": f"WITH {_TREND} SELECT esp_id, event_id, points::BIGINT AS points, round(total, 2) AS total, low, high FROM t",
    "trend_bounds": f"WITH {_TREND}, x AS (SELECT *, least(floor(low), 60)::BIGINT AS lower_, greatest(ceil(high), 60)::BIGINT AS upper_ FROM t) SELECT esp_id, event_id, lower_ AS lower, upper_ AS upper, {_R('coalesce((flow_rate - lower_) / nullif(upper_ - lower_, 0), 0)')} AS place FROM x",
    "gauge_levels": f"""WITH {_L} SELECT esp_id, {_R('least(100.0::DOUBLE, greatest(0.0::DOUBLE, flow_rate / 140 * 100))')} AS flow_percent, {_R('least(100.0::DOUBLE, greatest(0.0::DOUBLE, motor_temperature / 140 * 100))')} AS temperature_percent,
{_R('least(100.0::DOUBLE, greatest(0.0::DOUBLE, motor_current / 90 * 100))')} AS current_percent, {_R('least(100.0::DOUBLE, greatest(0.0::DOUBLE, vibration / 15 * 100))')} AS vibration_percent,
CASE WHEN flow_rate < 60 THEN 'warning' ELSE 'normal' END AS flow_level, CASE WHEN motor_temperature >= 120 THEN 'critical' WHEN motor_temperature >= 90 THEN 'warning' ELSE 'normal' END AS temperature_level,
CASE WHEN motor_current > 75 THEN 'critical' ELSE 'normal' END AS current_level, CASE WHEN vibration > 12 THEN 'critical' ELSE 'normal' END AS vibration_level,
{_R('(flow_rate / 105 - 1) * 100')} AS flow_delta_percent, {_R('motor_temperature - 78')} AS temperature_delta FROM l""",
    "alert_rule_hits": f"WITH {_D}, b AS ({_BY_RULE}) SELECT rule_id, count(*)::BIGINT AS n_events, count(*) FILTER (hit)::BIGINT AS hits FROM b GROUP BY 1",
    "alert_severity": f"WITH {_D}, c AS (SELECT status, " + " + ".join(f"({c})::INT" for c in _HOLD.values()) + " AS n FROM s WHERE source = 'realtime') SELECT CASE WHEN n = 0 THEN 'normal' WHEN status = 'SHUTDOWN' OR n >= 2 THEN 'critical' ELSE 'warning' END AS severity, count(*)::BIGINT AS n FROM c GROUP BY 1",
    "alert_episodes": f"""{_ALERT}, y AS (SELECT *, {_uuid5(_ALERTS, "concat_ws('|', esp_id, rule_id, episode)")} AS episode_id FROM z WHERE kind <> 'suppressed')
SELECT kind, {_uuid5(_ALERTS, "concat_ws('|', episode_id, event_id, kind)")} AS alert_id, episode_id, esp_id, rule_id, {_LABEL} AS finding, {_ISO('ts')} AS "timestamp", event_id FROM y""",
    "alert_outcome_counts": f"{_ALERT} SELECT esp_id, rule_id, kind, count(*)::BIGINT AS n FROM z GROUP BY 1, 2, 3",
    "deterministic_ids": f"WITH n AS (SELECT DISTINCT coalesce(esp_id, '') || '|' || coalesce(\"timestamp\", '') AS name FROM telemetry) SELECT name, {_uuid5(_EVENTS, 'name')} AS event_id, {_uuid5(_ALERTS, 'name')} AS alert_id FROM n",
    "drain_missing": f"""WITH t AS (SELECT {_ID} AS id, source, source_uri FROM telemetry), q AS (SELECT {_ID} AS id FROM quarantine)
SELECT DISTINCT id AS event_id FROM t WHERE source = 'realtime' AND id IS NOT NULL AND id NOT IN (SELECT id FROM t WHERE id IS NOT NULL AND source_uri IN (SELECT source_uri FROM source_inventory WHERE source_uri IS NOT NULL)) AND id NOT IN (SELECT id FROM q WHERE id IS NOT NULL)""",
    "restore_diff": """WITH g AS (SELECT *, count(*)::BIGINT AS n FROM source_inventory GROUP BY ALL)
SELECT 'lost' AS side, n, source_uri, source_kind, size_bytes FROM g WHERE size_bytes % 7 = 0 UNION ALL SELECT 'extra', n, source_uri, source_kind, size_bytes FROM g WHERE size_bytes % 7 <> 0 AND size_bytes % 11 = 0""",
    "object_selection": r"""WITH i AS (SELECT *, try_cast(concat_ws('-', regexp_extract(source_uri, '/(\d{4})[-/](\d{2})[-/](\d{2})/', 1), regexp_extract(source_uri, '/(\d{4})[-/](\d{2})[-/](\d{2})/', 2), regexp_extract(source_uri, '/(\d{4})[-/](\d{2})[-/](\d{2})/', 3)) AS DATE) AS d FROM source_inventory),
k AS (SELECT *, row_number() OVER (PARTITION BY source_uri ORDER BY object_last_modified_utc DESC NULLS LAST, source_sha256 DESC NULLS LAST, size_bytes DESC NULLS LAST) AS k FROM i WHERE source_uri IS NOT NULL AND (source_kind = 'historical_csv' OR d = DATE '2024-01-02'))
SELECT source_uri, source_kind, object_last_modified_utc, size_bytes FROM k WHERE k = 1""",
    "prefix_usage": r"SELECT regexp_extract(source_uri, '^s3://[^/]+/[^/]+/[^/]+/') AS prefix, count(*)::BIGINT AS n_objects, coalesce(sum(size_bytes), 0)::BIGINT AS n_bytes FROM source_inventory GROUP BY 1",
    "inventory_join": """WITH k AS (SELECT source_uri, source_sha256 IS NOT NULL AS hashed, row_number() OVER (PARTITION BY source_uri ORDER BY object_last_modified_utc DESC NULLS LAST, source_sha256 DESC NULLS LAST, size_bytes DESC NULLS LAST) AS k FROM source_inventory WHERE source_uri IS NOT NULL)
SELECT t.source_kind, k.source_uri IS NOT NULL AS listed, coalesce(hashed, false) AS hashed, count(*)::BIGINT AS n FROM telemetry AS t LEFT JOIN k ON k.source_uri = t.source_uri AND k.k = 1 GROUP BY 1, 2, 3""",
    "key_lookup": f"WITH {_L} SELECT esp_id, status, flow_rate, (row_number() OVER (ORDER BY list_position(['ESP-103', 'ESP-101', 'ESP-102'], esp_id)))::INTEGER AS place FROM l WHERE esp_id IN ('ESP-101', 'ESP-102', 'ESP-103')",
    "archive_paths": f"WITH {_V}, {_RT} SELECT DISTINCT 'raw/realtime/' || esp_id || '/' || strftime(ts, '%Y/%m/%d/%H') || '/' || id || '.json' AS path FROM rt",
    "freshness_state": f"WITH {_L}, a AS (SELECT esp_id, (max(arrived) OVER () - arrived) / 1e6 AS age FROM l) SELECT esp_id, CASE WHEN age < 10 THEN 'fresh' WHEN age < 45 THEN 'stale' ELSE 'unavailable' END AS state FROM a",
    "replay_dry_run": f"WITH {_V} SELECT CASE WHEN rule_id = 'OK' THEN 'would_process' ELSE 'would_quarantine' END AS outcome, count(*)::BIGINT AS n FROM v GROUP BY 1",
    "five_min_windows": f"WITH {_D} SELECT esp_id, strftime(time_bucket(INTERVAL 5 MINUTE, ts), '%Y-%m-%dT%H:%M:%SZ') AS window_start, count(*)::BIGINT AS n FROM s WHERE source = 'realtime' GROUP BY 1, 2",
    "sessions": f"""WITH {_D}, g AS (SELECT esp_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY esp_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM s WHERE source = 'realtime'),
h AS (SELECT *, sum(new) OVER (PARTITION BY esp_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT esp_id, {_ISO('min(ts)')} AS session_start, count(*)::BIGINT AS n FROM h GROUP BY esp_id, k""",
    "cache_ratio": "WITH i AS (SELECT DISTINCT source_uri FROM source_inventory), c AS (SELECT count(*) FILTER (source_uri IN (SELECT source_uri FROM telemetry)) AS hits, count(*) AS total FROM i) SELECT hits::BIGINT AS hits, total::BIGINT AS total, coalesce(floor(hits * 100 / nullif(total, 0) + 0.5), 0)::BIGINT AS percent FROM c",
}
SQL["published_kpi"] = SQL["daily_kpi"].replace(" FROM s GROUP BY", " FROM s WHERE event_date = DATE '2024-01-01' GROUP BY")
SQL["stream_alerts"] = SQL["alert_episodes"]
SQL["stream_routed"] = f"""WITH {_V}, rt AS (SELECT *, rule_id = 'OK' AS ok FROM v WHERE source_kind = 'realtime_json'),
o AS (SELECT rule_id, CASE WHEN NOT ok THEN 'quarantined' WHEN coalesce(ts > max(ts) OVER (PARTITION BY esp_id, ok ORDER BY ingested_at NULLS LAST, source_uri, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) THEN 'processed' ELSE 'superseded' END AS outcome FROM rt)
SELECT rule_id, outcome, count(*)::BIGINT AS n FROM o GROUP BY 1, 2"""
_USABLE = f"""r AS (SELECT {_ID} AS id, esp_id, {_TS} AS ts, ingested_at AS arrived, status FROM telemetry
  WHERE source = 'realtime' AND esp_id IN (SELECT esp_id FROM pump_metadata) AND trim(coalesce(event_id, '')) <> '' AND "timestamp" IS NOT NULL)"""
SQL["stream_latest_state"] = f"""WITH {_USABLE}, l AS (SELECT *, row_number() OVER (PARTITION BY esp_id ORDER BY ts DESC, arrived NULLS LAST, id DESC) AS k FROM r)
SELECT esp_id, {_ISO('ts')} AS "timestamp", status FROM l WHERE k = 1"""
SQL["stream_hourly"] = f"""WITH {_USABLE}, e AS (SELECT id, esp_id, date_trunc('hour', ts) AS h, min(arrived) AS a FROM r WHERE arrived IS NOT NULL GROUP BY 1, 2, 3)
SELECT esp_id, strftime(h, '%Y-%m-%dT%H:%M:%SZ') AS hour_start, count(*)::BIGINT AS n FROM e WHERE a <= h + INTERVAL 7 HOUR GROUP BY esp_id, h"""
_SCENARIOS = ", ".join(f"'{x}'" for x in ("normal", "gas_slug", "low_flow", "mechanical", "blockage", "sensor_fault", "shutdown"))
SQL["generated_events"] = f"""WITH e AS (SELECT scenario, 'ESP-' || (101 + i % 3) AS esp_id FROM (SELECT unnest([{_SCENARIOS}]) AS scenario) AS s, range(600) AS t(i))
SELECT scenario, CASE WHEN esp_id NOT IN (SELECT esp_id FROM pump_metadata WHERE esp_id IS NOT NULL) THEN 'UNKNOWN_ESP_ID' ELSE 'OK' END AS rule_id,
  count(*)::BIGINT AS n FROM e GROUP BY 1, 2"""
SQL["restored_states"] = f'WITH {_L} SELECT esp_id, {_ISO("ts")} AS "timestamp", status, scenario, flow_rate FROM l'
_FIELDS = ("schema_version", "event_id", "timestamp", "esp_id", "source", "run_id", "flow_rate", "water_cut", *_OPT[:5], "motor_temperature", "motor_current", "vibration", "pump_frequency", "status", "scenario")
_JSON = "json_object(" + ", ".join(f"'{c}', \"{c}\"" for c in _FIELDS) + ")"
SQL["silver_payloads"] = f"WITH {_D} SELECT event_id, sha256({_JSON}::VARCHAR) AS payload_sha256 FROM s"
