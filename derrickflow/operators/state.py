"""Latest state per pump: strictly newer wins, of equal times the first to arrive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from derrickflow.functions import windows


def latest(rows: DataFrame, order: Column, columns: list[str], tie: str = "id") -> DataFrame:
    """Per pump the row of greatest ts and, among these, least `order` (arrival; a long), then greatest tie. Partial aggregation, no window.

    Rows with a null esp_id or ts are ignored; an unknown arrival counts as the last.
    """
    top = F.max_by(F.struct(*columns), F.struct(F.col("ts"), -F.coalesce(order, F.lit((1 << 63) - 1)), F.col(tie))).alias("s")
    return rows.where("esp_id is not null and ts is not null").groupBy("esp_id").agg(top, F.max("ts").alias("ts")).select("esp_id", "ts", "s.*")


def outcomes(rows: DataFrame, arrived: str, ties: list[str]) -> DataFrame:
    """rows with outcome: processed where ts is newer than all that arrived before for the pump, else superseded."""
    r = windows.running_max(rows, ["esp_id"], arrived, ties, "ts", "_newest")
    return r.withColumn("outcome", F.when(F.col("_newest").isNull() | (F.col("ts") > F.col("_newest")), "processed").otherwise("superseded")).drop("_newest")
