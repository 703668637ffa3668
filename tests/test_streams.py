"""Routed streams: one outcome per record, whatever is delivered again."""

import base64
import json

from conftest import DATA
from pyspark.sql import functions as F

from derrickflow.functions import contract
from derrickflow.functions.times import micros
from derrickflow.operators import alerts as A
from derrickflow.sources import landing
from derrickflow.sources.telemetry import registered
from derrickflow.streaming import lanes

LINE = "source_uri string, line_no int, payload string, ingested_at timestamp_ntz"


def lines(spark):
    good = landing.generate(spark, 2, 30, step_us=60_000_000)
    late = landing.generate(spark, 2, 5, run="late")
    every = good.withColumn("at", micros(F.col("timestamp"))).unionByName(late.withColumn("at", F.lit(1_704_067_200_000_000 + 1_900_000_000)))
    made = every.select(F.concat(F.lit("s3://b/"), "event_id").alias("source_uri"), F.lit(1).alias("line_no"), F.to_json(F.struct(*contract.FIELDS)).alias("payload"), F.timestamp_micros("at").cast("timestamp_ntz").alias("ingested_at"))
    bad = [("s3://b/x", 1, "[1]"), ("s3://b/x", 2, "no json"), ("s3://b/x", 3, None), ("s3://b/y", 1, '{"schema_version": 1, "esp_id": "ESP-101"}')]
    return made.unionByName(spark.createDataFrame([(*b, None) for b in bad], LINE))


def test_one_outcome_per_record(spark, tmp_path):
    df, pumps = lines(spark), registered(spark, DATA)
    n = lanes.staged(df, str(tmp_path / "in"), files=2)
    stream = lambda: lanes.read_stream(spark, str(tmp_path / "in"), df.schema, n)
    r = lanes.routed(spark, stream(), pumps, f"file://{tmp_path}/r")
    got = {(x.rule_id, x.outcome): x["count"] for x in r.outcomes().groupBy("rule_id", "outcome").count().collect()}
    assert got == {("OK", "processed"): 60, ("OK", "superseded"): 10, ("MALFORMED_PAYLOAD", "quarantined"): 3, ("MISSING_FIELD", "quarantined"): 1}
    assert len(list((tmp_path / "r" / "outcomes").iterdir())) >= 3
    held = {(x.source_uri, x.line_no): json.loads(x.json) for x in r.quarantined().collect()}
    assert base64.b64decode(held["s3://b/x", 2]["raw_base64"]) == b"no json" and held["s3://b/x", 3]["raw_base64"] is None and len(held) == 4
    assert r.archived().count() == 70 and all(x.path.startswith("raw/realtime/ESP-10") and json.loads(x.payload) for x in r.archived().collect())
    before = sorted(map(tuple, r.state().select("esp_id", "ts").collect()))
    # a restart finds nothing new, a batch that is tried again changes nothing
    again = lanes.routed(spark, stream(), pumps, f"file://{tmp_path}/r")
    last = max(again.states())
    own = spark.read.parquet(str(tmp_path / "r" / "outcomes" / f"batch={last}")).select("source_uri", "line_no")
    rows = {(x.source_uri, x.line_no) for x in own.collect()}
    again.each(spark.createDataFrame([x for x in df.collect() if (x.source_uri, x.line_no) in rows], LINE), last)
    assert sorted(map(tuple, again.state().select("esp_id", "ts").collect())) == before and again.outcomes().count() == 74
    # everything delivered once more is superseded, archived under its old path, and quarantined again
    again.each(df, last + 1)
    got = {(x.rule_id, x.outcome): x["count"] for x in again.outcomes().where("rule_id = 'OK'").groupBy("rule_id", "outcome").count().collect()}
    assert got == {("OK", "processed"): 60, ("OK", "superseded"): 80} and again.archived().count() == 70
    assert sorted(map(tuple, again.state().select("esp_id", "ts").collect())) == before


def test_alert_lane_counts_what_it_skips(spark, tmp_path):
    typed = lanes.alert_lines(lines(spark).withColumn("source_kind", F.lit("realtime_json")), str(tmp_path / "skipped"))
    assert typed.count() == 70 and tuple(spark.read.parquet(str(tmp_path / "skipped")).first()) == (74, 4)


def test_alerts_of_a_stream_equal_those_of_the_batch(spark, tmp_path):
    rows = landing.generate(spark, 2, 200, "low_flow", step_us=20_000_000, run="a").where("esp_id = 'ESP-101' or second(timestamp) < 40")
    rows = rows.unionByName(landing.generate(spark, 2, 60, "mechanical", step_us=90_000_000, run="b")).withColumn("ts", micros(F.col("timestamp")))
    some = rows.withColumn("at", F.timestamp_micros("ts")).drop("timestamp", "source")
    n = lanes.staged(some, str(tmp_path / "in"), "at", files=2)
    sent = lanes.send_alerts(spark, lanes.read_stream(spark, str(tmp_path / "in"), some.schema, n), f"file://{tmp_path}/out")
    want = A.alerts(A.decisions(rows))
    cols = ["alert_id", "episode_id", "kind", "esp_id", "rule_id", "severity", "event_id"]
    take = lambda df: sorted(map(tuple, df.select(*cols).collect()))
    assert take(sent) == take(want) and {k for _, _, k, *_ in take(want)} == {"trigger", "recovery"}
    assert len(list((tmp_path / "out" / "alerts").iterdir())) >= 3


def test_failed_ranges(spark):
    log = spark.createDataFrame([(s, i, f"{s}{i}") for s in "ab" for i in range(10)], "shard string, sequence int, payload string")
    notices = spark.createDataFrame([("a", 2, 4), ("a", 3, 5), ("b", 9, 20), ("c", 0, 9), ("a", 2, 4)], "shard string, first int, last int")
    assert sorted(r.payload for r in lanes.failed_range(log, notices).collect()) == ["a2", "a3", "a4", "a5", "b9"]


def test_history(spark):
    h = landing.seed_history(spark)
    assert h.count() == 504 == h.select("event_id").distinct().count() and {r.source for r in h.select("source").distinct().collect()} == {"historical"}
