import base64
import json

import pytest
from pyspark.sql import functions as F

from derrickflow.sources import archive as A


def test_export_and_restore(spark, tmp_path):
    for p, data in (("a/x.json", b"1"), ("a/b/y.json", b""), ("z.csv", b"z" * 100000)):
        (tmp_path / "in" / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / p).write_bytes(data)
    root, out, back = (f"file://{tmp_path}/{d}" for d in ("in", "out", "back"))
    assert A.export(spark, root, out).count() == 3
    assert A.restore(spark, out, back).agg(F.sum("size_bytes")).first()[0] == 100001
    assert sorted(map(tuple, A.listing(spark, root).collect())) == sorted(map(tuple, A.listing(spark, back).collect()))
    (tmp_path / "out/files/a/x.json").write_bytes(b"2")
    with pytest.raises(ValueError, match="differs"):
        A.restore(spark, out, f"file://{tmp_path}/again")
    assert not (tmp_path / "again").exists()


@pytest.mark.parametrize("path", ["../x", "/x", "a\\b", "", "c:/x", "a/../b"])
def test_unsafe_paths(path):
    with pytest.raises(ValueError):
        A.safe(path)


def test_paths_envelopes_and_lookup(spark):
    df = spark.createDataFrame([("ESP-1", 1_704_067_200_000_000, "e", "R", "why", "é{")], "esp_id string, ts long, event_id string, rule_id string, reason string, raw string")
    assert df.select(A.archive_path(F.col("esp_id"), F.col("ts"), F.col("event_id"))).first()[0] == "raw/realtime/ESP-1/2024/01/01/00/e.json"
    e = json.loads(A.envelopes(df, F.col("raw"), F.lit("t")).first().json)
    assert base64.b64decode(e["raw_base64"]).decode() == "é{" and e["rule_id"] == "R"
    many = spark.createDataFrame([("a",), ("b",), ("c",)], "k string")
    assert [r.k for r in A.lookup(many, "k", ["c", "a", "x"]).collect()] == ["c", "a"]
