"""Queries without a window take every event date of the table."""

from conftest import DATA
from pyspark.sql import functions as F

from derrickflow.functions.times import iso_micros, micros
from derrickflow.plans import telemetry


def later(spark, to, days):
    """The telemetry of DATA followed by copies under other identities, days apart; the pumps as they are."""
    t = spark.read.parquet(f"{DATA}/telemetry.parquet")
    every = t
    for d in days:
        moved = F.when(micros(F.col("timestamp")).isNotNull(), iso_micros(micros(F.col("timestamp")) + d * 86_400_000_000)).otherwise(F.col("timestamp"))
        named = F.translate("event_id", "0123456789", "0123456789"[d % 10 :] + "0123456789"[: d % 10])  # other UUIDs, spelled as before
        every = every.unionByName(t.withColumns({"timestamp": moved, "event_id": named}))
    every.write.parquet(f"{to}/telemetry.parquet")
    spark.read.parquet(f"{DATA}/pump_metadata.parquet").write.parquet(f"{to}/pump_metadata.parquet")
    return to


def test_days_after_the_second_are_published(spark, tmp_path):
    to = later(spark, str(tmp_path), (5, 43))
    one, all_ = (telemetry.row_accounting(spark, f).first().asDict() for f in (DATA, to))
    assert all_ == {k: 3 * v for k, v in one.items()} and all_["out_of_scope_rows"] == 0 and all_["silver_rows"] > 0
    days = {r.event_date for r in telemetry.daily_kpi(spark, to).select("event_date").distinct().collect()}
    assert {"2024-01-01", "2024-01-06", "2024-02-13"} <= days
    repeated = telemetry.identity_profile(spark, to)
    assert repeated.count() == 3 * telemetry.identity_profile(spark, DATA).count() > 0
    assert {r.in_scope: r.n for r in telemetry.window_lookback(spark, to).collect()}[False] > 0
