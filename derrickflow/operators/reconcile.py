"""Reconciliation: what was acknowledged and did not land, and whether a copy equals its original."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.functions import contract


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Acknowledged events of a producer's JSON-lines ledger: event_id and run_id. Blank lines count for nothing; a broken line raises, as a ledger must be whole."""
    return spark.read.schema("event_id string, run_id string").option("mode", "FAILFAST").json(path)


def missing(ledger: DataFrame, landed: DataFrame, quarantined: DataFrame, key: str = "id") -> DataFrame:
    """Acknowledged rows of which neither the landed nor the quarantined ones hold the key (null keys are missing)."""
    return ledger.join(landed.select(key), key, "left_anti").join(quarantined.select(key), key, "left_anti")


def differences(original: DataFrame, copy: DataFrame) -> DataFrame:
    """Rows that one of two tables holds more often than the other: side (lost, extra), n, and the columns.

    Multisets are compared by one aggregation over the union; order doesn't matter, nulls are equal. No rows: they are the same.
    """
    cols = original.columns
    both = original.select(*cols, F.lit(1).alias("_w")).unionByName(copy.select(*cols, F.lit(-1).alias("_w")))
    d = both.groupBy(*cols).agg(F.sum("_w").alias("_w")).where("_w <> 0")
    return d.select(F.when(F.col("_w") > 0, "lost").otherwise("extra").alias("side"), F.abs("_w").alias("n"), *cols)


def would() -> Column:
    """What a replay of a judged row would do."""
    return F.when(F.col("rule_id") == contract.OK, "would_process").otherwise("would_quarantine").alias("outcome")


def dry_run(validated: DataFrame) -> DataFrame:
    """What a replay of validated rows would do, without doing it: rows per outcome."""
    return validated.groupBy(would()).agg(F.count("*").alias("n"))


def freshness(age_seconds: Column, loaded: Column, ttl: float = 10.0, limit: float = 45.0) -> Column:
    """fresh within ttl, where nothing is loaded; beyond it, and for an unknown age, fresh after a good load. After a failed one stale within limit, else unavailable."""
    return F.when((age_seconds < ttl) | loaded, "fresh").when(age_seconds < limit, "stale").otherwise("unavailable")
