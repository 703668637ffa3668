"""The streamed hourly counts are those of p2, in whatever order the copies of an event are read."""

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from derrickflow.functions.times import HOUR
from derrickflow.operators import late_events
from derrickflow.plans import pipeline, telemetry
from derrickflow.streaming import lanes


@pytest.mark.parametrize("backwards", [False, True])
def test_late_copy_read_first(spark, tmp_path, backwards):
    h = 1_704_067_200_000_000
    in_time, late, far = h + HOUR + 1, h + 9 * HOUR, h + 40 * HOUR
    files = [
        [("a", "E", h, late, 9.0), ("f", "E", h + 33 * HOUR, far, 1.0)],
        [("a", "E", h, in_time, 2.0), ("a", "F", h, in_time, 3.0), ("a", "E", h + HOUR, in_time, 4.0)],
        [("b", "E", h + 5, in_time + 5, 8.0), ("b", "E", h + 5, late, 7.0), ("c", "E", h, late, 5.0), ("d", "E", h, None, 6.0)],
        [("b", "E", h + 5, in_time + 1, 1.0)],
    ]
    schema = "id string, esp_id string, ts long, arrived long, flow_rate double"
    for i, rows in enumerate(files[::-1] if backwards else files):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")  # one file, one batch
    r = spark.read.schema(schema).parquet(f"{tmp_path}/in")
    got = lanes.hourly(spark, lanes.read_stream(spark, f"{tmp_path}/in", r.schema, 1), f"file://{tmp_path}/h").collect()
    want = late_events.hourly(late_events.arrivals(r)).select("esp_id", "period", "n", "total").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
    assert (("E", h, 2, 3.0)) in set(map(tuple, got))


def test_stream_equals_batch_on_a_table(spark):
    folder = DATA.replace("0.001", "0.01")
    got = {tuple(r) for r in telemetry.stream_hourly(spark, folder).select("esp_id", "hour_start", "n").collect()}
    want = {tuple(r) for r in pipeline.p2_hourly(spark, folder).select("esp_id", F.col("hour_start"), "n").collect()}
    assert got == want
