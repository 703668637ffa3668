import json

from derrickflow.operators import parse


def test_long_versions_keep_reasons_of_their_own(spark):
    rows = [("u", "realtime_json", i, json.dumps({"schema_version": "9" * 300 + x}), None) for i, x in enumerate("ab")]
    rows += [("v", "historical_csv", 1, "schema_version,event_id", None)] + [("v", "historical_csv", 2 + i, "9" * 300 + x + ",e", None) for i, x in enumerate("cd")]
    lines = spark.createDataFrame(rows, "source_uri string, source_kind string, line_no int, payload string, ingested_at timestamp_ntz")
    got = parse.rejected(parse.parse_lines(lines, spark.createDataFrame([("E",)], "esp_id string"))).collect()
    assert {r.rule_id for r in got} == {"SCHEMA_VERSION_UNSUPPORTED"} and len({r.reason for r in got}) == 4
    assert all("9" * 300 + x in " ".join(r.reason for r in got) for x in "abcd")
