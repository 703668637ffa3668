"""A pump's newest event counts as its latest state even if its arrival isn't known."""

from conftest import DATA
from pyspark.sql import functions as F

from derrickflow.functions.times import micros
from derrickflow.plans import telemetry


def test_newest_event_without_arrival(spark, tmp_path):
    t = spark.read.parquet(f"{DATA}/telemetry.parquet")
    new = t.where("esp_id = 'ESP-101' and source = 'realtime' and status = 'RUNNING' and ingested_at is not null and flow_rate > 0")
    new = new.where(micros(F.col("timestamp")).isNotNull()).limit(1)
    new = new.withColumns({"event_id": F.lit("ffffffff-ffff-ffff-ffff-ffffffffffff"), "timestamp": F.lit("2024-01-02T23:00:00Z"), "status": F.lit("SHUTDOWN"), "ingested_at": F.lit(None).cast(t.schema["ingested_at"].dataType)})
    t.unionByName(new).write.parquet(f"{tmp_path}/telemetry.parquet")
    spark.read.parquet(f"{DATA}/pump_metadata.parquet").write.parquet(f"{tmp_path}/pump_metadata.parquet")
    pump = lambda q: q(spark, str(tmp_path)).where("esp_id = 'ESP-101'").collect()
    assert [(r.timestamp, r.status) for r in pump(telemetry.latest_state)] == [("2024-01-02T23:00:00.000000Z", "SHUTDOWN")]
    assert [r.severity for r in pump(telemetry.severity_filter)] == ["critical"]
    assert [r.status for r in pump(telemetry.key_lookup)] == ["SHUTDOWN"]
    # where the arrival itself is the matter, such rows stay out
    assert telemetry.freshness_state(spark, str(tmp_path)).where("esp_id = 'ESP-101'").count() == 1
    assert sorted(map(tuple, telemetry.state_outcomes(spark, str(tmp_path)).collect())) == sorted(map(tuple, telemetry.state_outcomes(spark, DATA).collect()))
