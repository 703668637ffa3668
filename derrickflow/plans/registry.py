"""All queries of the core, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from derrickflow.plans import pipeline, telemetry, telemetry_sql


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    return telemetry.daily_kpi(spark, folder)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return telemetry.Q | pipeline.QUERIES


def oracle_sql() -> dict[str, str]:
    return telemetry_sql.SQL | pipeline.SQL
