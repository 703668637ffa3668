"""Queries of the data-pipeline problems over the driver's tables (names pN_...)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.functions.ids import identity, spelled
from derrickflow.functions.times import iso_seconds, micros_ntz
from derrickflow.operators import compaction, exactly_once, late_events, parse, regular_grid, spikes
from derrickflow.operators.publication import steady
from derrickflow.session import split_bytes, stored_bytes
from derrickflow.sources.telemetry import registered, table, usable


def _usable(spark: SparkSession, folder: str) -> DataFrame:
    return usable(table(spark, folder, "telemetry"), registered(spark, folder))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Objects that others hold entirely: left out by the compaction, whose files hold all their events."""
    done = compaction.compact(spark, f"{folder}/telemetry.parquet")
    return done.absorbed.select(F.col("uri").alias("source_uri"))


def p1_compacted(spark: SparkSession, folder: str) -> DataFrame:
    """What the compacted files hold per pump: rows, events."""
    done = compaction.compact(spark, f"{folder}/telemetry.parquet")
    return spark.read.parquet(done.folder).groupBy("esp_id").agg(F.count("*").alias("n_rows"), F.countDistinct(identity(F.col("event_id"))).alias("n_events"))


def p1_files(spark: SparkSession, folder: str) -> DataFrame:
    """The compacted files: pump, blocks, rows, bytes. Their number depends on the target size, so this has no SQL."""
    return compaction.compact(spark, f"{folder}/telemetry.parquet").files.select(F.col("key").alias("esp_id"), "file", "n_blocks", "n_rows", "n_bytes")


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    """Pump hours whose aggregate was corrected between its first publication and the cut-off."""
    hours = late_events.hourly(late_events.arrivals(_usable(spark, folder)))
    return hours.where("corrections > 0").select("esp_id", iso_seconds(F.col("period")).alias("hour_start"))


def p2_hourly(spark: SparkSession, folder: str) -> DataFrame:
    """First and final hourly aggregates per pump."""
    h = late_events.hourly(late_events.arrivals(_usable(spark, folder)))
    return h.select("esp_id", iso_seconds(F.col("period")).alias("hour_start"), "n_first", "n", F.round("total", 2).alias("total_flow"), "low", "high")


def _flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags of the usable readings of running pumps; of an event's rows the first to arrive counts (ties: the least values)."""
    fields = list(spikes.POSSIBLE)
    first = F.min(F.struct(F.coalesce("arrived", F.lit((1 << 63) - 1)).alias("a"), F.xxhash64("source_uri").alias("u"), "esp_id", "ts", *fields)).alias("r")
    readings = _usable(spark, folder).where("status = 'RUNNING'").groupBy("id").agg(first).select("id", "r.esp_id", "r.ts", *[f"r.{f}" for f in fields])
    splits = -(-stored_bytes(spark, f"{folder}/telemetry.parquet") // split_bytes(spark))
    return spikes.implausible(readings, partitions=max(2 * spark.sparkContext.defaultParallelism, 2 * splits))


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    """Readings and fields that are impossible, stuck or spikes."""
    return _flags(spark, folder).select(spelled(F.col("id")).alias("event_id"), "field").distinct()


def p3_flags(spark: SparkSession, folder: str) -> DataFrame:
    """Flags per pump field and kind."""
    return _flags(spark, folder).groupBy("field", "kind").agg(F.count("*").alias("n"))


def _parsed(spark: SparkSession, folder: str) -> DataFrame:
    return parse.parse_lines(table(spark, folder, "raw_lines"), registered(spark, folder))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are no valid event, with the first rule they break."""
    return parse.rejected(_parsed(spark, folder)).select("source_uri", "line_no", "rule_id")


def p4_rejected(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected events by rule and reason."""
    return parse.rejected(_parsed(spark, folder)).groupBy("rule_id", "reason").agg(F.count("*").alias("n"))


def p4_events(spark: SparkSession, folder: str) -> DataFrame:
    """The valid events, typed."""
    return parse.accepted(_parsed(spark, folder))


def delivery_order(telemetry: DataFrame) -> F.Column:
    """Bytes that sort deliveries by arrival (unknown last), object and content."""
    arrived = F.coalesce(micros_ntz(F.col("ingested_at")), F.lit((1 << 63) - 1))
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    return F.concat(number(arrived), F.encode(F.coalesce("source_uri", F.lit("")), "UTF-8"), F.unhex(F.lit("00")), number(F.xxhash64(*[F.col(c) for c in telemetry.columns])))


def _stored(spark: SparkSession, folder: str) -> exactly_once.Store:
    path = f"{folder}/telemetry.parquet"
    store = exactly_once.Store.for_bytes(spark, stored_bytes(spark, path))
    store.upsert_files(path, "telemetry", ["event_id"], identity(F.col("event_id")), delivery_order(table(spark, folder, "telemetry")))
    return store


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """Identifiers delivered more than once, from the compacted store's copies."""
    return _stored(spark, folder).index().where("_copies > 1").select(spelled(F.col("_id")).alias("event_id"))


def p5_events(spark: SparkSession, folder: str) -> DataFrame:
    """Exactly one row per event: counts per source of the compacted store's messages."""
    kept = _stored(spark, folder).messages(["source"])
    return kept.where("_id is not null").groupBy("source").agg(F.count("*").alias("n_events"), F.sum("_copies").alias("n_copies"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Slots without a reading that readings less than a day apart cover."""
    grid = regular_grid.regular(_usable(spark, folder))
    return grid.where("status = 'filled'").select("esp_id", iso_seconds(F.col("slot")).alias("slot_start"))


def p6_series(spark: SparkSession, folder: str) -> DataFrame:
    """The five-minute series of every pump."""
    g = regular_grid.regular(_usable(spark, folder))
    return g.select("esp_id", iso_seconds(F.col("slot")).alias("slot_start"), "status", "n", steady(F.col("rate")).alias("flow_rate"))


QUERIES = {f.__name__: f for f in (p1_found, p1_compacted, p1_files, p2_found, p2_hourly, p3_found, p3_flags, p4_found, p4_rejected, p4_events, p5_found, p5_events, p6_found, p6_series)}

_UUID = "right(regexp_replace(lower(event_id), '[^0-9a-f]', '', 'g'), 32)"
_ID = f"""(CASE WHEN trim(coalesce(event_id, '')) = '' THEN NULL ELSE concat_ws('-', substr({_UUID}, 1, 8), substr({_UUID}, 9, 4),
  substr({_UUID}, 13, 4), substr({_UUID}, 17, 4), substr({_UUID}, 21, 12)) END)"""
#: DuckDB has the time as a zoned text; its cast to TIMESTAMPTZ and back is UTC.
_TS = "(CAST(\"timestamp\" AS TIMESTAMPTZ) AT TIME ZONE 'UTC')"
_USABLE = f"""r AS (SELECT {_ID} AS id, esp_id, {_TS} AS ts, ingested_at AS arrived, flow_rate FROM telemetry
  WHERE source = 'realtime' AND esp_id IN (SELECT esp_id FROM pump_metadata) AND trim(coalesce(event_id, '')) <> '' AND "timestamp" IS NOT NULL)"""
_ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')".format

SQL = {
    "p1_found": f"""WITH t AS (SELECT DISTINCT source_uri AS u, {_ID} AS id FROM telemetry),
o AS (SELECT u, count(id) AS n, count(*) - count(id) AS nameless FROM t GROUP BY u),
p AS (SELECT a.u AS a, b.u AS b, count(*) AS c FROM t AS a JOIN t AS b ON a.id = b.id AND a.u <> b.u GROUP BY 1, 2)
SELECT DISTINCT a AS source_uri FROM p JOIN o AS x ON x.u = a JOIN o AS y ON y.u = b
WHERE c = x.n AND x.nameless = 0 AND (y.n > x.n OR (y.n = x.n AND b < a))""",
    "p1_compacted": f"""WITH k AS (SELECT {_ID} AS id, esp_id FROM telemetry),
e AS (SELECT id, min(esp_id) AS esp_id FROM k WHERE id IS NOT NULL GROUP BY id UNION ALL SELECT id, esp_id FROM k WHERE id IS NULL)
SELECT esp_id, count(*)::BIGINT AS n_rows, count(DISTINCT id)::BIGINT AS n_events FROM e GROUP BY esp_id""",
    "p2_found": f"""WITH {_USABLE}, e AS (SELECT id, esp_id, date_trunc('hour', ts) AS h, min(arrived) AS a FROM r WHERE arrived IS NOT NULL GROUP BY 1, 2, 3)
SELECT DISTINCT esp_id, {_ISO('h')} AS hour_start FROM e WHERE a > h + INTERVAL 65 MINUTE AND a <= h + INTERVAL 7 HOUR""",
    "p2_hourly": f"""WITH {_USABLE}, e AS (SELECT id, esp_id, date_trunc('hour', ts) AS h, arrived AS a, CASE WHEN isnan(flow_rate) THEN NULL ELSE flow_rate END AS v,
  row_number() OVER (PARTITION BY id, esp_id, date_trunc('hour', ts) ORDER BY arrived, CASE WHEN isnan(flow_rate) THEN NULL ELSE flow_rate END NULLS FIRST) AS k FROM r WHERE arrived IS NOT NULL)
SELECT esp_id, {_ISO('h')} AS hour_start, (count(*) FILTER (a <= h + INTERVAL 65 MINUTE))::BIGINT AS n_first, count(*)::BIGINT AS n, round(sum(v), 2) AS total_flow, min(v) AS low, max(v) AS high
FROM e WHERE k = 1 AND a <= h + INTERVAL 7 HOUR GROUP BY esp_id, h""",
    "p5_found": f"SELECT {_ID} AS event_id FROM telemetry WHERE {_ID} IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "p5_events": f"""WITH k AS (SELECT {_ID} AS id, source, ingested_at, source_uri FROM telemetry WHERE {_ID} IS NOT NULL),
e AS (SELECT id, source, count(*) OVER (PARTITION BY id) AS n, row_number() OVER (PARTITION BY id ORDER BY ingested_at NULLS LAST, source_uri) AS k FROM k)
SELECT source, count(*)::BIGINT AS n_events, sum(n)::BIGINT AS n_copies FROM e WHERE k = 1 GROUP BY source""",
    "p6_found": f"""WITH {_USABLE}, v AS (SELECT DISTINCT esp_id, ts FROM r WHERE flow_rate IS NOT NULL AND NOT isnan(flow_rate)),
g AS (SELECT esp_id, ts, lag(ts) OVER (PARTITION BY esp_id ORDER BY ts) AS before FROM v)
SELECT esp_id, {_ISO('s')} AS slot_start FROM (SELECT esp_id, unnest(generate_series(time_bucket(INTERVAL 5 MINUTE, before) + INTERVAL 5 MINUTE,
  time_bucket(INTERVAL 5 MINUTE, ts) - INTERVAL 5 MINUTE, INTERVAL 5 MINUTE)) AS s FROM g WHERE ts - before < INTERVAL 24 HOUR)""",
    "p6_series": f"""WITH {_USABLE}, v AS (SELECT esp_id, epoch_us(ts) AS us, avg(flow_rate) AS v, count(*) AS n FROM r WHERE flow_rate IS NOT NULL AND NOT isnan(flow_rate) GROUP BY ALL),
g AS (SELECT *, us // 300000000 AS c, lag(us) OVER w AS us0, lag(v) OVER w AS v0 FROM v WINDOW w AS (PARTITION BY esp_id ORDER BY us)),
p AS (SELECT *, us - us0 < 86400000000 AS near, unnest(generate_series(us0 // 300000000, c)) AS cell FROM g WHERE us0 IS NOT NULL),
o AS (SELECT esp_id, cell, 0 AS n, NULL AS v, CASE WHEN near THEN least(us, cell * 300000000 + 300000000) - greatest(us0, cell * 300000000) END AS part, (v0 + v) / 2 AS mid FROM p
  UNION ALL SELECT esp_id, c, n, v, NULL, NULL FROM g),
s AS (SELECT esp_id, cell, sum(n) AS n, avg(v) AS v, sum(part) AS part, sum(part * mid) AS volume FROM o GROUP BY 1, 2)
SELECT esp_id, {_ISO('make_timestamp(cell * 300000000)')} AS slot_start, CASE WHEN n > 0 THEN 'reading' WHEN part IS NOT NULL THEN 'filled' ELSE 'uncovered' END AS status, n::BIGINT AS n,
  round(CASE WHEN part > 0 THEN volume / part ELSE v END + 1e-9, 6) AS flow_rate FROM s""",
}
