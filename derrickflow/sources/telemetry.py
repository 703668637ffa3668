"""The driver's tables, and the notion of a usable reading."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.functions.ids import identity
from derrickflow.functions.times import micros, micros_ntz


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def registered(spark: SparkSession, folder: str) -> DataFrame:
    """The pumps with a metadata row. Its size is left to the optimiser to check: no broadcast hint."""
    return table(spark, folder, "pump_metadata").where("esp_id is not null").select("esp_id").distinct()


def usable(telemetry: DataFrame, pumps: DataFrame) -> DataFrame:
    """Usable readings: source realtime, a registered pump, an event_id and a (readable, zoned) timestamp.

    Adds id (16 bytes), ts (microseconds) and arrived (microseconds or null); keeps all columns but
    event_id and timestamp, of which the reader prunes what isn't used.
    """
    return (
        telemetry.where(F.col("source") == "realtime")
        .join(pumps, "esp_id", "left_semi")
        .withColumns({"id": identity(F.col("event_id")), "ts": micros(F.col("timestamp")), "arrived": micros_ntz(F.col("ingested_at"))})
        .drop("event_id", "timestamp")
        .where("id is not null and ts is not null")
    )
