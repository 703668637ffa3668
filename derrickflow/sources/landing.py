"""Raw objects: CSV by header name, JSON with corrupt records, listings, selection by date, generated events."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.functions import contract
from derrickflow.functions.times import HOUR, iso_micros
from derrickflow.functions.uuids import EVENTS, uuid5
from derrickflow.operators import parse
from derrickflow.sources.files import resolve

#: Kinds of raw objects.
KINDS = (parse.CSV_KIND, "realtime_json")


def _plain(uri: Column) -> Column:
    return F.regexp_replace(uri, "^s3[an]?://", "s3://")


def source_uri() -> Column:
    """The scanned file's URI with object-store scheme variants made equal."""
    return _plain(F.col("_metadata.file_path"))


def land(lines: DataFrame, to: str) -> None:
    """Write undecoded lines (source_uri, source_kind, line_no, payload) as one text file per object: to/kind/<hash of the URI>. A null payload is an empty line.

    An object's lines are held by one task: objects are small here, which is their very problem.
    """

    def write(table: pa.Table) -> pa.Table:
        table = table.sort_by("line_no")
        kind, uri = table.column("source_kind")[0].as_py(), table.column("source_uri")[0].as_py()
        fs, base = resolve(f"{to}/{kind}")
        fs.create_dir(base, recursive=True)
        text = "".join(f"{x or ''}\n" for x in table.column("payload").to_pylist())
        with fs.open_output_stream(f"{base}/{hashlib.sha1(uri.encode()).hexdigest()}.txt") as sink:
            sink.write(text.encode())
        return pa.table({"n": [table.num_rows]})

    for kind in KINDS:
        fs, base = resolve(f"{to}/{kind}")
        fs.create_dir(base, recursive=True)
    some = lines.where("source_uri is not null and source_kind is not null").select("source_uri", "source_kind", F.col("line_no").cast("int").alias("line_no"), "payload")
    some.groupBy("source_kind", "source_uri").applyInArrow(write, "n long").agg(F.sum("n")).collect()


def lines_of(spark: SparkSession, paths: str | list[str], kind: str) -> DataFrame:
    """The undecoded lines of raw files, as parse.typed_lines takes them: source_uri, source_kind, line_no, payload, ingested_at.

    line_no is 1 for the first line of a file and null for the others: files are read in splits, of which only the first knows its lines' numbers.
    """
    raw = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))

    def first(batches):
        seen = None
        for b in batches:
            path, at = b.column("path"), b.column("at")
            # a split's rows come in order; a partition holds whole splits, one after the other
            starts = pc.and_(pc.equal(at, 0), pc.not_equal(path, pa.concat_arrays([pa.array([seen], pa.string()), path[:-1].cast(pa.string())]).fill_null("")))
            seen = path[-1].as_py() if b.num_rows else seen
            number = pc.if_else(starts, pa.scalar(1, pa.int32()), pa.scalar(None, pa.int32()))
            yield pa.RecordBatch.from_arrays([path, number, b.column("value")], names=["path", "line_no", "payload"])

    found = raw.mapInArrow(first, "path string, line_no int, payload string")
    return found.select(_plain(F.col("path")).alias("source_uri"), F.lit(kind).alias("source_kind"), "line_no", "payload", F.lit(None).cast("timestamp_ntz").alias("ingested_at"))


def read_events(spark: SparkSession, paths: str | list[str], kind: str) -> DataFrame:
    """Events of raw files of one kind: the contract's fields, malformed (why a line is no record at all, or null), version_text, source_uri.

    CSV files are read each by its own header, whatever its order; absent columns are null, other columns ignored. A number that is
    none is NaN, which the contract rejects.
    """
    t = parse.typed_lines(lines_of(spark, paths, kind))
    version = F.when(F.col("schema_version").between(-1e9, 1e9) & (F.col("schema_version") == F.floor("schema_version")), F.col("schema_version").cast("int"))
    return t.select(*[version.alias(f) if f == "schema_version" else f for f in contract.FIELDS], "malformed", "version_text", "source_uri")


def read_csv(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """read_events() of CSV files with headers."""
    return read_events(spark, paths, parse.CSV_KIND)


def read_json(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """read_events() of JSON-lines files."""
    return read_events(spark, paths, KINDS[1])


def union_sources(historical: DataFrame, realtime: DataFrame) -> DataFrame:
    """Both kinds of events by column name; columns of one kind only are null for the other."""
    return historical.unionByName(realtime, allowMissingColumns=True)


def date_of(uri: Column) -> Column:
    """The date in an object's path (.../YYYY/MM/DD/HH/... or .../YYYY-MM-DD/...); null if there is none."""
    parts = F.regexp_extract(uri, r"/(\d{4})[-/](\d{2})[-/](\d{2})/", 0)
    return F.try_to_date(F.translate(F.trim(F.translate(parts, "/", " ")), " ", "-"))


def select_objects(listing: DataFrame, start: str, end: str, lookback_days: int = 1) -> DataFrame:
    """Listed objects, each once, that a run over start..end reads: all historical ones, realtime ones of the window's dates.

    Of an object listed twice the entry with the latest time (then greatest hash) stands.
    """
    within = date_of(F.col("source_uri")).between(F.date_sub(F.to_date(F.lit(start)), lookback_days), F.to_date(F.lit(end)))
    some = listing.where((F.col("source_kind") == "historical_csv") | within)
    rest = ["source_kind", "object_last_modified_utc", "source_sha256", "size_bytes"]
    best = F.max(F.struct("object_last_modified_utc", "source_sha256", "size_bytes", "source_kind")).alias("o")
    return some.where("source_uri is not null").groupBy("source_uri").agg(best).select("source_uri", *[f"o.{c}" for c in rest])


#: Signals of generated events (mean and spread), and what a scenario has instead. "tick" is the number of the event of its pump.
LEVELS = {
    "flow_rate": (120.0, 4.0), "intake_pressure": (700.0, 8.0), "discharge_pressure": (1600.0, 15.0), "motor_temperature": (92.0, 2.0), "vibration": (2.5, 0.3),
    "motor_current": (68.0, 2.0), "tubing_pressure": (700.0, 10.0), "casing_pressure": (500.0, 10.0), "pump_frequency": (60.0, 0.0), "intake_temperature": (78.0, 0.0), "water_cut": (0.4, 0.02),
}
SCENARIOS = {
    "normal": {},
    "gas_slug": {"flow_rate": ("120 + 35 * sin(tick / 5)", 4.0), "intake_pressure": ("700 - 21 * sin(tick / 5)", 8.0), "motor_current": ("68 + 5.25 * abs(sin(tick / 5))", 2.0)},
    "low_flow": {"flow_rate": (42.0, 3.0), "motor_temperature": (137.0, 3.0), "motor_current": (82.0, 2.0), "discharge_pressure": (1510.0, 0.0)},
    "mechanical": {"vibration": ("least(16, 3 + tick * 0.08)", 0.5), "motor_current": ("72 + tick * 0.06", 0.0), "discharge_pressure": ("1600 - least(220, tick * 1.5)", 15.0)},
    "blockage": {"tubing_pressure": (1000.0, 20.0), "flow_rate": (42.0, 3.0), "discharge_pressure": (1630.0, 0.0), "motor_current": (84.0, 0.0), "motor_temperature": (125.0, 0.0)},
    "sensor_fault": {"motor_temperature": (91.0, 0.0)},
    "shutdown": {"flow_rate": (0.0, 0.0), "motor_current": (0.0, 0.0), "pump_frequency": (0.0, 0.0), "vibration": (0.0, 0.0), "motor_temperature": (75.0, 0.0)},
}


def generate(spark: SparkSession, pumps: int, ticks: int, scenario: str = "normal", start_us: int = 1_704_067_200_000_000, step_us: int = 1_000_000, run: str = "generated", seed: int = 1, source: str = "realtime") -> DataFrame:
    """Deterministic events of v1: a row per pump and tick, the same on every run with the same arguments. Noise is even within a signal's spread."""
    if scenario not in SCENARIOS:
        raise ValueError(f"scenario is one of {tuple(SCENARIOS)}")
    d = spark.range(pumps * ticks).select((F.col("id") % pumps).cast("int").alias("p"), F.floor(F.col("id") / pumps).alias("tick"))

    def signal(name: str) -> Column:
        mean, spread = SCENARIOS[scenario].get(name, LEVELS[name])
        noise = F.pmod(F.xxhash64("p", "tick", F.lit(seed), F.lit(name)), F.lit(2001)) / 1000.0 - 1.0
        return (F.expr(mean) if isinstance(mean, str) else F.lit(mean)).cast("double") + noise * spread

    esp = F.concat(F.lit("ESP-"), (F.col("p") + 101).cast("string"))
    own = {
        "schema_version": F.lit(1), "event_id": uuid5(EVENTS, F.concat_ws("|", F.lit(run), esp, F.col("tick").cast("string"))), "timestamp": iso_micros(F.lit(start_us) + F.col("tick") * step_us),
        "esp_id": esp, "source": F.lit(source), "run_id": F.lit(run), "status": F.lit("SHUTDOWN" if scenario == "shutdown" else "RUNNING"), "scenario": F.lit(scenario),
    }
    return d.select(*[(own[f] if f in own else signal(f)).alias(f) for f in contract.FIELDS])


def seed_history(spark: SparkSession, pumps: int = 3, days: int = 7, end_us: int = 1_704_067_200_000_000, run: str = "seed") -> DataFrame:
    """Hourly historical events of the days up to end_us."""
    return generate(spark, pumps, days * 24, start_us=end_us - days * 24 * HOUR, step_us=HOUR, run=run, source="historical")
