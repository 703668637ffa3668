"""Raw files as the batch path reads them."""

import datetime as dt

from conftest import DATA
from pyspark.sql import functions as F

from derrickflow.functions.times import micros
from derrickflow.operators import publication as pub
from derrickflow.plans import pipeline, telemetry
from derrickflow.sources import landing

GOOD = '{"schema_version": 1, "event_id": "a", "timestamp": "2024-01-01T00:00:00Z", "esp_id": "ESP-101", "source": "realtime", "run_id": "r", "flow_rate": 1, "water_cut": 0.5, "motor_temperature": 1, "motor_current": 1, "vibration": 1, "status": "RUNNING"%s}'


def pumps(spark):
    return spark.createDataFrame([("ESP-101",)], "esp_id string")


def test_malformed_lines_break_the_first_rule(spark, tmp_path):
    lines = ["[1]", "not json", GOOD[:40], GOOD % "", GOOD % ', "pump_frequency": "fast"', GOOD % ', "pump_frequency": null, "other": {}', '{"schema_version": 2}', ""]
    (tmp_path / "a.json").write_text("\n".join(lines) + "\n")
    v = pub.validated(landing.read_json(spark, str(tmp_path)), pumps(spark))
    got = [r.rule_id for r in v.select("rule_id").collect()]
    assert sorted(got) == sorted(["MALFORMED_PAYLOAD"] * 4 + ["OK", "NON_FINITE_NUMBER", "OK", "SCHEMA_VERSION_UNSUPPORTED"])
    assert all(r.reason for r in v.collect())


def test_half_a_surrogate_pair(spark, tmp_path):
    (tmp_path / "a.json").write_text(GOOD.replace('"r"', '"\\ud800x"') % "" + "\n" + GOOD % "" + "\n")
    v = pub.validated(landing.read_json(spark, str(tmp_path)), pumps(spark))
    assert sorted((r.run_id, r.rule_id) for r in v.collect()) == [("?x", "OK"), ("r", "OK")]


def test_each_file_by_its_own_header(spark, tmp_path):
    names = ["schema_version", "event_id", "timestamp", "esp_id", "source", "run_id", "flow_rate", "water_cut", "motor_temperature", "motor_current", "vibration", "status"]
    values = ["1", "x", "2024-01-01T00:00:00Z", "ESP-101", "historical", "r", "100", "0.4", "1", "1", "1", "RUNNING"]
    swap = [*range(6), 7, 6, *range(8, 12)]
    (tmp_path / "a.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    (tmp_path / "b.csv").write_text("﻿" + ",".join(names[i] for i in swap) + ",extra\n" + ",".join(values[i] for i in swap) + ',"q, r"\n' + ",".join(values) + "\n")
    values[6] = "fast"
    (tmp_path / "c.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    for order in ("abc", "cba"):
        v = pub.validated(landing.read_csv(spark, [str(tmp_path / f"{x}.csv") for x in order]), pumps(spark))
        got = sorted((r.source_uri[-5:], r.rule_id, r.flow_rate, r.water_cut) for r in v.collect() if r.rule_id == "OK")
        assert got == [("a.csv", "OK", 100.0, 0.4), ("b.csv", "OK", 100.0, 0.4)]
        assert sorted((r.source_uri[-5:], r.rule_id) for r in v.collect() if r.rule_id != "OK") == [("b.csv", "MALFORMED_PAYLOAD"), ("c.csv", "NON_FINITE_NUMBER")]


def test_landed_lines_break_the_same_rules(spark):
    want = pipeline.p4_found(spark, DATA).join(spark.read.parquet(f"{DATA}/raw_lines.parquet").select("source_uri", "source_kind").distinct(), "source_uri")
    want = {(r.source_kind, r.rule_id): r["count"] for r in want.groupBy("source_kind", "rule_id").count().collect()}
    assert {(r.source_kind, r.rule_id): r.n for r in telemetry.landed_lines(spark, DATA).collect() if r.rule_id != "OK"} == want


def test_all_forms_of_zoned_times(spark):
    """The native expression reads what the standard's own parser reads, and refuses texts without zone."""
    dates = ["2024-02-29", "20240229", "2024-W09-4", "2024W094", "2024-W53-1", "2020-W53-7", "2023-02-29", "2024-W09", "0001-01-01"]
    times = ["T05", "T05:06", "T0506", "T05:06:07", "T050607", " 05:06:07.5", "T05:06:07,123", "T05:06:07.123456789012", "T25:00", "T05:60", "x05:06"]
    zones = ["Z", "+00:00", "-0530", "+05", "+01:02:03", "", "+24:00"]
    texts = [d + t + z for d in dates for t in times for z in zones]

    def plain(text):
        try:
            t = dt.datetime.fromisoformat(text)
            return None if t.tzinfo is None else (t.astimezone(dt.timezone.utc) - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)
        except (ValueError, OverflowError):
            return None

    df = spark.createDataFrame([(t,) for t in texts], "t string")
    wrong = [(r.t, r.m, plain(r.t)) for r in df.select("t", micros(F.col("t")).alias("m")).collect() if r.m != plain(r.t) and not r.t.startswith("0001")]
    assert not wrong, wrong[:10]
