"""The v1 telemetry contract as one native column expression: the first rule an event breaks, and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrickflow.functions.times import micros

#: The contract's fields, values and rule names, in the order in which they are judged.
SCHEMA_VERSION = 1
SOURCES = ("historical", "realtime")
STATUSES = ("RUNNING", "SHUTDOWN", "UNKNOWN")
REQUIRED = ("schema_version", "event_id", "timestamp", "esp_id", "source", "run_id", "status")
REQUIRED_NUMBERS = ("flow_rate", "water_cut", "motor_temperature", "motor_current", "vibration")
OPTIONAL_NUMBERS = ("intake_pressure", "discharge_pressure", "tubing_pressure", "casing_pressure", "intake_temperature", "pump_frequency")
MALFORMED, VERSION, MISSING, PUMP, SOURCE, STATUS, TIME, FINITE, RANGE, OK = (
    "MALFORMED_PAYLOAD", "SCHEMA_VERSION_UNSUPPORTED", "MISSING_FIELD", "UNKNOWN_ESP_ID", "INVALID_SOURCE",
    "INVALID_STATUS", "INVALID_TIMESTAMP", "NON_FINITE_NUMBER", "OUT_OF_RANGE", "OK",
)
CONFLICT = "DUPLICATE_EVENT_ID_CONFLICT"
FIELDS = (
    "schema_version", "event_id", "timestamp", "esp_id", "source", "run_id", "flow_rate", "water_cut", "intake_pressure",
    "discharge_pressure", "tubing_pressure", "casing_pressure", "intake_temperature", "motor_temperature", "motor_current",
    "vibration", "pump_frequency", "status", "scenario",
)


def finite(c: Column) -> Column:
    """True for a number that is neither null, NaN nor infinite."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False))


def broken(known: Column, ts: Column | None = None, malformed: Column | None = None) -> Column:
    """Number (from 1, in the order of RULE_OF) of the first check that a row of FIELDS fails; 0 if none.

    One chain of cheap predicates, evaluated once: names and reasons are looked up by its number.
    """
    c = F.col
    ts = micros(c("timestamp")) if ts is None else ts
    checks = [F.lit(False) if malformed is None else malformed.isNotNull(), ~c("schema_version").eqNullSafe(F.lit(SCHEMA_VERSION))]
    checks += [F.coalesce(c(f), F.lit("")) == "" for f in REQUIRED[1:]]
    checks += [~F.coalesce(known, F.lit(False)), ~c("source").isin(*SOURCES), ~c("status").isin(*STATUSES), ts.isNull()]
    checks += [~finite(c(f)) for f in REQUIRED_NUMBERS]
    checks += [~c("water_cut").between(0.0, 1.0)] + [c(f) < 0 for f in ("flow_rate", "motor_current", "vibration")]
    checks += [c(f).isNotNull() & ~finite(c(f)) for f in OPTIONAL_NUMBERS]
    chain = F.when(checks[0], 1)
    for i, check in enumerate(checks[1:], 2):
        chain = chain.when(check, i)
    return chain.otherwise(0)


#: The rule of each check, in order, and its reason where that is the same for all rows.
RULE_OF = (
    [MALFORMED, VERSION] + [MISSING] * 6 + [PUMP, SOURCE, STATUS, TIME] + [FINITE] * len(REQUIRED_NUMBERS) + [RANGE] * 4 + [FINITE] * len(OPTIONAL_NUMBERS)
)
REASON_OF = (
    ["", ""] + [f"required field '{f}' is missing" for f in REQUIRED[1:]] + ["", "", "", "timestamp is not a UTC ISO-8601 value"]
    + [f"field '{f}' must be a finite number" for f in REQUIRED_NUMBERS]
    + ["water_cut must be within 0..1"] + [f"{f} must be >= 0" for f in ("flow_rate", "motor_current", "vibration")]
    + [f"optional field '{f}' must be a finite number or null" for f in OPTIONAL_NUMBERS]
)


def rule_name(number: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in [OK, *RULE_OF]]), number + 1)


def reason_text(number: Column, malformed: Column | None = None, version_text: Column | None = None) -> Column:
    """Why a check failed. malformed: the reason of the first check. version_text: how the version is shown."""
    shown = F.coalesce(F.col("schema_version").cast("string"), F.lit("None")) if version_text is None else version_text
    texts = F.element_at(F.array(*[F.lit(x) for x in ["valid", *REASON_OF]]), number + 1)
    at = lambda rule: number == RULE_OF.index(rule) + 1
    return (
        F.when(at(MALFORMED), F.lit("") if malformed is None else malformed)
        .when(at(VERSION), F.concat(F.lit("schema_version "), shown, F.lit(f" is not supported (expected {SCHEMA_VERSION})")))
        .when(at(PUMP), F.concat(F.lit("esp_id '"), F.col("esp_id"), F.lit("' is not a registered pump")))
        .when(at(SOURCE), F.concat(F.lit("source '"), F.col("source"), F.lit(f"' must be one of {sorted(SOURCES)}")))
        .when(at(STATUS), F.concat(F.lit("status '"), F.col("status"), F.lit(f"' must be one of {sorted(STATUSES)}")))
        .otherwise(texts)
    )


def judge(rows: DataFrame, known: Column, ts: Column | None = None, malformed: Column | None = None, version_text: Column | None = None) -> DataFrame:
    """rows with rule_id and reason: the first rule that a row of FIELDS breaks; (OK, valid) if none.

    known: whether esp_id is registered. ts: microseconds of the timestamp, null if it is no zoned
    ISO-8601 time (by default parsed from the column). malformed: the reason why the raw record is
    no event at all, or null. In number columns a null is an absent value, NaN a present value that is no finite number.
    """
    n = F.col("_check")
    r = rows.withColumn("_check", broken(known, ts, malformed))
    return r.withColumns({"rule_id": rule_name(n), "reason": reason_text(n, malformed, version_text)}).drop("_check")
