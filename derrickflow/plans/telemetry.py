"""Queries of the telemetry platform's own operators over the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrickflow.functions import contract, rules, windows
from derrickflow.functions.ids import identity, spelled
from derrickflow.functions.times import iso_micros, micros_ntz
from derrickflow.functions.uuids import ALERTS, EVENTS, uuid5
from derrickflow.operators import alerts, parse, reconcile, state
from derrickflow.operators import publication as pub
from derrickflow.plans import publish
from derrickflow.session import materialise, scratch
from derrickflow.sources import archive, landing
from derrickflow.sources.telemetry import registered, table, usable
from derrickflow.streaming import lanes

#: The window of window_lookback and object_selection; all other queries take every event date of the table.
START, END, LOOKBACK = "2024-01-02", "2024-01-02", 1
steady = pub.steady


def _validated(spark: SparkSession, folder: str) -> DataFrame:
    return pub.validated(pub.placed(table(spark, folder, "telemetry")), registered(spark, folder))


def _disposed(spark: SparkSession, folder: str) -> DataFrame:
    return pub.dispositions(_validated(spark, folder))


def _silver(spark: SparkSession, folder: str) -> DataFrame:
    return pub.silver(_disposed(spark, folder), pub.dimension(table(spark, folder, "pump_metadata")))


def _valid(spark: SparkSession, folder: str) -> DataFrame:
    """Valid realtime rows with arrival, null where it is unknown."""
    v = _validated(spark, folder).where((F.col("rule_id") == contract.OK) & (F.col("source") == "realtime"))
    return v.withColumn("arrived", micros_ntz(F.col("ingested_at")))


def _arrived(spark: SparkSession, folder: str) -> DataFrame:
    """Valid realtime rows of known arrival."""
    return _valid(spark, folder).where("arrived is not null")


def _latest(spark: SparkSession, folder: str, of=_valid) -> DataFrame:
    """Latest states; an unknown arrival counts as the last of its time."""
    cols = ["arrived", "status", "scenario", "flow_rate", "motor_temperature", "motor_current", "vibration"]
    s = state.latest(of(spark, folder), F.col("arrived"), cols)
    return s.withColumns({"status": F.coalesce("status", F.lit("UNKNOWN")), "scenario": F.coalesce("scenario", F.lit("unknown"))})


def _decided(spark: SparkSession, folder: str) -> DataFrame:
    s = _silver(spark, folder).where("source = 'realtime'")
    return alerts.decisions(s.withColumn("ts", F.unix_micros("event_ts")))


def _trend(spark: SparkSession, folder: str) -> DataFrame:
    """Silver readings with a flow, numbered within the pump, with the last 24 points' aggregates."""
    s = _silver(spark, folder).where("source = 'realtime' and flow_rate is not null").select("esp_id", F.unix_micros("event_ts").alias("ts"), "event_id", "flow_rate")
    n = windows.numbered(materialise(s, "trend"), ["esp_id"], "ts", ["event_id"])
    v = F.col("flow_rate")
    return windows.rolling(n, ["esp_id"], "rn", 23, {"points": F.count(v), "total": F.sum(v), "low": F.min(v), "high": F.max(v)})


Q: dict = {}


def query(f):
    Q[f.__name__] = f
    return f


@query
def daily_kpi(spark, folder):
    k = pub.daily_kpis(_silver(spark, folder)).orderBy("event_date", "esp_id")
    return k.withColumn("event_date", F.col("event_date").cast("string"))


@query
def quality_checks(spark, folder):
    return pub.quality(_silver(spark, folder))


@query
def contract_verdicts(spark, folder):
    return _validated(spark, folder).select("source_uri", "event_id", "timestamp", "rule_id", "reason")


@query
def rejections_by_rule(spark, folder):
    return _validated(spark, folder).where(F.col("rule_id") != contract.OK).groupBy("source_kind", "rule_id").agg(F.count("*").alias("n"))


@query
def union_sources(spark, folder):
    t = table(spark, folder, "telemetry")
    short = ("tubing_pressure", "casing_pressure", "intake_temperature", "pump_frequency", "scenario")
    both = landing.union_sources(t.where("source_kind = 'historical_csv'").drop(*short), t.where("source_kind = 'realtime_json'"))
    return both.groupBy("source_kind").agg(F.count("*").alias("n"), F.count("scenario").alias("n_scenario"))


@query
def landed_lines(spark, folder):
    """Raw lines landed as files, one per object, read by the batch path and judged: lines by kind and rule."""
    to, lines = scratch(spark, "landed"), table(spark, folder, "raw_lines")
    landing.land(lines, to)
    some = [landing.read_events(spark, f"{to}/{kind}", kind).withColumn("source_kind", F.lit(kind)) for kind in landing.KINDS]
    v = pub.validated(landing.union_sources(*some), registered(spark, folder))
    return v.groupBy("source_kind", "rule_id").agg(F.count("*").alias("n"))


@query
def window_lookback(spark, folder):
    v = _validated(spark, folder).where(F.col("rule_id") == contract.OK)
    return v.groupBy(pub.in_window(START, END, LOOKBACK).alias("in_scope")).agg(F.count("*").alias("n"))


@query
def identity_profile(spark, folder):
    v = _validated(spark, folder).where((F.col("rule_id") == contract.OK) & pub.in_window(None, None, 0))
    p = pub.identity_profile(v.withColumn("_print", pub.fingerprint()))
    return p.where("n > 1").select(spelled(F.col("id")).alias("event_id"), "n", (F.col("n_payloads") > 1).alias("conflict"))


@query
def silver_canonical(spark, folder):
    return _silver(spark, folder).select("event_id", "timestamp", "esp_id", "source", "status", "flow_rate", "source_uri", "field", "metadata_version")


@query
def silver_payloads(spark, folder):
    """Hashes of the canonical JSON of silver rows."""
    return _silver(spark, folder).select("event_id", "payload_sha256")


@query
def identity_conflicts(spark, folder):
    return pub.conflicts(_disposed(spark, folder)).select("source_uri", "event_id", "rule_id")


@query
def quarantine_events(spark, folder):
    return pub.quarantine(_disposed(spark, folder)).select("source_uri", "event_id", "rule_id", "reason")


@query
def row_accounting(spark, folder):
    return pub.accounting(_disposed(spark, folder))


@query
def dataset_digest(spark, folder):
    s = _silver(spark, folder).select(F.sha2(F.concat_ws("|", "event_id", "timestamp", "esp_id", "source_uri"), 256).alias("h"))
    return pub.digest(s, "h")


@query
def dim_enriched(spark, folder):
    return _silver(spark, folder).groupBy("esp_id", "field", "metadata_version").agg(F.count("*").alias("n"))


@query
def missing_metadata(spark, folder):
    t = table(spark, folder, "telemetry")
    return t.join(registered(spark, folder), "esp_id", "left_anti").groupBy("esp_id").agg(F.count("*").alias("n"))


@query
def gold_daily(spark, folder):
    g = pub.gold(_silver(spark, folder))
    rounded = ("avg_liquid_rate_m3_day", "avg_oil_rate_m3_day", "avg_motor_temperature_c", "sample_coverage", "relative_flow_deficit")
    return g.drop("publication_run_id", "manifest_sha256", "baseline_liquid_rate_m3_day").withColumns({"event_date": F.col("event_date").cast("string")} | {c: steady(F.col(c)) for c in rounded})


@query
def kpi_top250(spark, folder):
    t = publish.top_kpis(pub.gold(_silver(spark, folder)))
    return t.select(F.col("event_date").cast("string").alias("event_date"), "esp_id", "samples", "peak_vibration_mm_s", steady(F.col("relative_flow_deficit")).alias("relative_flow_deficit"))


@query
def published_kpi(spark, folder):
    """Key figures of one day of the approved run of a publication, read by its pointer (rows of conflicting identities, which no run may have, are left out before)."""
    root = scratch(spark, "published")
    m = publish.manifest("all", "2024-01-01", "2024-01-02", 1, [{"uri": f"{folder}/telemetry.parquet", "source_kind": "realtime_json", "sha256": "", "size_bytes": 0}])
    d = _disposed(spark, folder).where(F.col("disposition") != pub.CONFLICTING)
    publish.publish(d, pub.dimension(table(spark, folder, "pump_metadata")), root, "run", m, ("realtime_json",))
    k = publish.published_kpis(spark, root, "2024-01-01", "2024-01-01")
    return k.withColumn("event_date", F.col("event_date").cast("string"))


@query
def source_kind_counts(spark, folder):
    return _silver(spark, folder).groupBy("source_kind").agg(F.count("*").alias("n"))


@query
def latest_state(spark, folder):
    return _latest(spark, folder).select("esp_id", iso_micros(F.col("ts")).alias("timestamp"), "status", "scenario", "flow_rate", "motor_temperature")


@query
def state_outcomes(spark, folder):
    o = state.outcomes(_arrived(spark, folder).select("esp_id", "ts", "arrived", "source_uri", "id"), "arrived", ["source_uri", "id"])
    return o.groupBy("esp_id", "outcome").agg(F.count("*").alias("n"))


@query
def derived_severity(spark, folder):
    return _latest(spark, folder).select("esp_id", rules.shown_severity().alias("severity"), rules.shown_severity(False).alias("hosted_severity"))


@query
def severity_filter(spark, folder):
    s = _latest(spark, folder).withColumn("severity", rules.shown_severity())
    return s.where("severity <> 'normal'").select("esp_id", "severity")


@query
def fleet_kpis(spark, folder):
    s = _latest(spark, folder)
    return s.agg(F.count_if(F.col("status") == "RUNNING").alias("running"), F.round(F.sum(F.coalesce("flow_rate", F.lit(0.0))), 2).alias("total_flow"), steady(F.coalesce(F.avg("motor_temperature"), F.lit(0.0))).alias("mean_temperature"))


@query
def active_anomalies(spark, folder):
    s = _latest(spark, folder).withColumn("severity", rules.shown_severity()).where("severity <> 'normal'").join(pub.dimension(table(spark, folder, "pump_metadata")), "esp_id", "left")
    text = F.concat("esp_id", F.lit(" "), F.upper("severity"))
    return s.groupBy("field").agg(F.array_join(F.sort_array(F.collect_list(text)), " | ").alias("anomalies"))


@query
def rolling_trend(spark, folder):
    return _trend(spark, folder).select("esp_id", "event_id", "points", F.round("total", 2).alias("total"), "low", "high")


@query
def trend_bounds(spark, folder):
    """Scales of the trend: whole bounds of the last points with the limit 60 folded in, and the reading's place between them."""
    t = _trend(spark, folder).withColumns({"lower": F.least(F.floor("low"), F.lit(60)).cast("long"), "upper": F.greatest(F.ceil("high"), F.lit(60)).cast("long")})
    place = F.coalesce(F.try_divide(F.col("flow_rate") - F.col("lower"), F.col("upper") - F.col("lower")), F.lit(0.0))
    return t.select("esp_id", "event_id", "lower", "upper", steady(place).alias("place"))


@query
def gauge_levels(spark, folder):
    """Gauges of the latest state: clamped percentages of full scale, levels, differences from the baselines 105 m3/day and 78 degrees."""
    s = _latest(spark, folder)
    share = lambda c, full: steady(F.least(F.lit(100.0), F.greatest(F.lit(0.0), F.col(c) / full * 100)))
    return s.select(
        "esp_id",
        share("flow_rate", 140.0).alias("flow_percent"),
        share("motor_temperature", 140.0).alias("temperature_percent"),
        rules.level(F.col("flow_rate"), 60.0, None, below=True).alias("flow_level"),
        rules.level(F.col("motor_temperature"), 90.0, 120.0).alias("temperature_level"),
        share("motor_current", 90.0).alias("current_percent"),
        share("vibration", 15.0).alias("vibration_percent"),
        rules.level(F.col("motor_current"), None, 75.0, reach=False).alias("current_level"),
        rules.level(F.col("vibration"), None, 12.0, reach=False).alias("vibration_level"),
        steady((F.col("flow_rate") / 105.0 - 1) * 100).alias("flow_delta_percent"),
        steady(F.col("motor_temperature") - 78.0).alias("temperature_delta"),
    )


@query
def alert_rule_hits(spark, folder):
    s = _silver(spark, folder).where("source = 'realtime'")
    return alerts.rule_hits(s)


@query
def alert_severity(spark, folder):
    s = _silver(spark, folder).where("source = 'realtime'")
    return s.groupBy(rules.severity(rules.triggered()).alias("severity")).agg(F.count("*").alias("n"))


@query
def alert_episodes(spark, folder):
    a = alerts.alerts(_decided(spark, folder))
    return a.select("kind", "alert_id", "episode_id", "esp_id", "rule_id", "finding", iso_micros(F.col("ts")).alias("timestamp"), "event_id")


@query
def alert_outcome_counts(spark, folder):
    return _decided(spark, folder).groupBy("esp_id", "rule_id", "kind").agg(F.count("*").alias("n"))


@query
def deterministic_ids(spark, folder):
    t = table(spark, folder, "telemetry").select("esp_id", "timestamp").distinct()
    name = F.concat_ws("|", F.coalesce("esp_id", F.lit("")), F.coalesce("timestamp", F.lit("")))
    return t.select(name.alias("name"), uuid5(EVENTS, name).alias("event_id"), uuid5(ALERTS, name).alias("alert_id"))


@query
def drain_missing(spark, folder):
    """Acknowledged realtime events, read from a JSON-lines ledger, whose object isn't listed and which no quarantine holds."""
    v = _validated(spark, folder)
    to = scratch(spark, "ledger")
    v.where("source = 'realtime' and id is not null").select("event_id", "run_id").write.json(to)
    ledger = reconcile.read_ledger(spark, to).select(identity(F.col("event_id")).alias("id")).distinct()
    landed = v.where("id is not null").join(table(spark, folder, "source_inventory").select("source_uri").distinct(), "source_uri", "left_semi")
    held = table(spark, folder, "quarantine").withColumn("id", identity(F.col("event_id"))).where("id is not null")
    return reconcile.missing(ledger, landed, held).select(spelled(F.col("id")).alias("event_id"))


@query
def restore_diff(spark, folder):
    """What a damaged copy of the listing lacks and has too much: it has no rows whose size is a multiple of 7, and others of multiples of 11 twice."""
    i = table(spark, folder, "source_inventory")
    size = F.col("size_bytes")
    left = i.where(size.isNull() | (size % 7 != 0))
    return reconcile.differences(i, left.unionByName(left.where(size % 11 == 0))).select("side", "n", "source_uri", "source_kind", "size_bytes")


@query
def object_selection(spark, folder):
    return landing.select_objects(table(spark, folder, "source_inventory"), START, END, 0).select("source_uri", "source_kind", "object_last_modified_utc", "size_bytes")


@query
def prefix_usage(spark, folder):
    i = table(spark, folder, "source_inventory")
    prefix = F.regexp_extract("source_uri", r"^s3://[^/]+/[^/]+/[^/]+/", 0)
    return i.groupBy(prefix.alias("prefix")).agg(F.count("*").alias("n_objects"), F.coalesce(F.sum("size_bytes"), F.lit(0)).cast("long").alias("n_bytes"))


@query
def inventory_join(spark, folder):
    """Rows of listed objects by kind and whether the listing has a hash; rows of unlisted objects are counted too."""
    i = landing.select_objects(table(spark, folder, "source_inventory"), "1970-01-01", "9999-12-31", 0).select("source_uri", F.col("source_sha256").isNotNull().alias("hashed"), F.lit(True).alias("listed"))
    t = table(spark, folder, "telemetry").select("source_uri", "source_kind").join(i, "source_uri", "left")
    return t.groupBy("source_kind", F.coalesce("listed", F.lit(False)).alias("listed"), F.coalesce("hashed", F.lit(False)).alias("hashed")).agg(F.count("*").alias("n"))


@query
def key_lookup(spark, folder):
    """The latest states of three given pumps, in the given order."""
    found = archive.lookup(_latest(spark, folder), "esp_id", ["ESP-103", "ESP-101", "ESP-102"]).select("esp_id", "status", "flow_rate")
    # three rows: numbered in the order in which they come
    return found.withColumn("place", F.row_number().over(Window.partitionBy(F.lit(1)).orderBy(F.monotonically_increasing_id())))


@query
def restored_states(spark, folder):
    """Latest states, exported as table items with a hashed manifest, and brought back."""
    root, s = scratch(spark, "items"), _latest(spark, folder).select("esp_id", "ts", "status", "scenario", "flow_rate")
    archive.write_items(s, f"{root}/state")
    archive.export(spark, root, f"{root}-export")
    archive.restore(spark, f"{root}-export", f"{root}-back").collect()
    back = archive.read_items(spark, f"{root}-back/state", s.schema)
    return back.select("esp_id", iso_micros(F.col("ts")).alias("timestamp"), "status", "scenario", "flow_rate")


@query
def archive_paths(spark, folder):
    """Raw archive paths of the valid realtime events of known arrival (as its SQL has it; see REPLY_r01.md)."""
    v = _arrived(spark, folder)
    return v.select(archive.archive_path(F.col("esp_id"), F.col("ts"), spelled(F.col("id"))).alias("path")).distinct()


@query
def freshness_state(spark, folder):
    """State of every pump's latest reading by its age, should the next load fail."""
    s = _latest(spark, folder, _arrived).select("esp_id", "arrived")
    newest = F.max("arrived").over(Window.partitionBy(F.lit(1)))  # one row per pump
    age = ((newest - F.col("arrived")) / 1e6).alias("age")
    return s.select("esp_id", age).select("esp_id", reconcile.freshness(F.col("age"), F.lit(False), 10.0, 45.0).alias("state"))


@query
def replay_dry_run(spark, folder):
    return reconcile.dry_run(_validated(spark, folder))


@query
def five_min_windows(spark, folder):
    s = _silver(spark, folder).where("source = 'realtime'")
    w = s.groupBy("esp_id", F.window("event_ts", "5 minutes").alias("w")).agg(F.count("*").alias("n"))
    return w.select("esp_id", F.date_format("w.start", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("window_start"), "n")


@query
def sessions(spark, folder):
    """Sessions of readings of a pump at most 30 minutes apart."""
    s = _silver(spark, folder).where("source = 'realtime'")
    w = s.groupBy("esp_id", F.session_window("event_ts", "30 minutes").alias("w")).agg(F.count("*").alias("n"))
    return w.select("esp_id", F.date_format("w.start", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("session_start"), "n")


@query
def generated_events(spark, folder):
    """Generated events of all scenarios, judged by the contract; no table is read but the registered pumps."""
    some = [landing.generate(spark, 3, 200, s, run=s) for s in landing.SCENARIOS]
    every = some[0]
    for x in some[1:]:
        every = every.unionByName(x)
    v = pub.validated(every, registered(spark, folder))
    return v.groupBy("scenario", "rule_id").agg(F.count("*").alias("n"))


@query
def cache_ratio(spark, folder):
    """Share of listed objects that hold telemetry, rounded to whole percent (0 for an empty listing)."""
    i = table(spark, folder, "source_inventory").select("source_uri").distinct()
    t = table(spark, folder, "telemetry").select("source_uri", F.lit(1).alias("hit")).distinct()
    r = i.join(t, "source_uri", "left").agg(F.count("hit").alias("hits"), F.count("*").alias("total"))
    return r.select("hits", "total", F.coalesce(F.floor(F.try_divide(F.col("hits") * 100, F.col("total")) + 0.5), F.lit(0)).cast("long").alias("percent"))


def _streamed(spark, df, arrived="ingested_at"):
    """df as a stream in order of arrival, in several batches."""
    to = scratch(spark, "staged")
    return lanes.read_stream(spark, to, df.schema, lanes.staged(df, to, arrived))


def _usable_stream(spark, folder):
    t = table(spark, folder, "telemetry").select("source", "esp_id", "event_id", "timestamp", "ingested_at", "flow_rate", "status")
    return usable(_streamed(spark, t), registered(spark, folder))


@query
def stream_hourly(spark, folder):
    h = lanes.hourly(spark, _usable_stream(spark, folder), scratch(spark, "stream"))
    return h.select("esp_id", F.date_format(F.timestamp_micros("period"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("hour_start"), "n")


@query
def stream_latest_state(spark, folder):
    s = lanes.latest_state(spark, _usable_stream(spark, folder), ["status", "flow_rate"], scratch(spark, "stream"))
    return s.select("esp_id", iso_micros(F.col("ts")).alias("timestamp"), "status")


@query
def stream_routed(spark, folder):
    """Outcomes of realtime records, each delivered as a JSON line and routed in order of arrival."""
    t = table(spark, folder, "telemetry").where("source_kind = 'realtime_json'")
    lines = t.select("source_uri", F.lit(0).alias("line_no"), F.to_json(F.struct(*contract.FIELDS)).alias("payload"), "ingested_at")
    r = lanes.routed(spark, _streamed(spark, lines), registered(spark, folder), scratch(spark, "stream"))
    return r.outcomes().groupBy("rule_id", "outcome").agg(F.count("*").alias("n"))


@query
def replay_failed(spark, folder):
    """Replay of the batches of ten records of which one is rejected, as failure notices name them: by outcome and rule, first as a dry run, then routed."""
    t = table(spark, folder, "telemetry").where("source_kind = 'realtime_json'")
    at = F.col("_metadata.file_path").alias("shard"), F.col("_metadata.row_index").alias("sequence")
    log = materialise(t.select(*at, "source_uri", *contract.FIELDS, "ingested_at"), "log")
    bad = pub.validated(log, registered(spark, folder)).where(F.col("rule_id") != contract.OK)
    first = (F.floor(F.col("sequence") / 10) * 10).alias("first")
    notices = bad.select("shard", first).distinct().withColumn("last", F.col("first") + 9)
    lines = lanes.failed_range(log, notices).select("source_uri", F.lit("realtime_json").alias("source_kind"), F.col("sequence").cast("int").alias("line_no"), F.to_json(F.struct(*contract.FIELDS)).alias("payload"), "ingested_at")
    dry = parse.parse_lines(lines, registered(spark, folder)).groupBy(F.lit("dry run").alias("mode"), reconcile.would(), "rule_id").agg(F.count("*").alias("n"))
    r = lanes.Router(spark, registered(spark, folder), scratch(spark, "replay"))
    r.each(lines, 0)
    return dry.unionByName(r.outcomes().groupBy(F.lit("execute").alias("mode"), "outcome", "rule_id").agg(F.count("*").alias("n")))


@query
def stream_alerts(spark, folder):
    """Alerts of a stream of canonical events in order of time, in several batches."""
    s = _silver(spark, folder).where("source = 'realtime'").withColumn("ts", F.unix_micros("event_ts"))
    some = s.select("esp_id", "ts", "event_ts", "event_id", "status", "scenario", "flow_rate", "motor_temperature", "vibration", "motor_current", "tubing_pressure")
    a = lanes.send_alerts(spark, _streamed(spark, some, "event_ts"), scratch(spark, "stream"))
    return a.select("kind", "alert_id", "episode_id", "esp_id", "rule_id", "finding", iso_micros(F.col("ts")).alias("timestamp"), "event_id")
