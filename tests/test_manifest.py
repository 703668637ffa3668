"""A run reads what its manifest lists, as it was when it was listed."""

import pytest
from pyspark.sql import functions as F

from derrickflow.functions import contract
from derrickflow.operators import reconcile
from derrickflow.plans import publish
from derrickflow.sources import archive, landing

PUMP = "esp_id string, metadata_version string, field string, rated_capacity_m3_day double, installation_date date, min_flow_rate double, max_motor_temperature double, baseline_liquid_rate_m3_day double"


def test_manifest_to_publication(spark, tmp_path):
    base = landing.generate(spark, 3, 40)
    day = tmp_path / "raw" / "realtime" / "ESP-101" / "2024" / "01" / "01" / "00"
    base.coalesce(1).write.json(str(day))
    old = tmp_path / "raw" / "historical" / "x"
    hist = base.where("esp_id = 'ESP-101'").limit(5).withColumns({"source": F.lit("historical"), "event_id": F.concat(F.lit("h-"), "event_id")})
    hist.select(*[c for c in contract.FIELDS if c not in ("scenario", "pump_frequency")]).coalesce(1).write.option("header", True).csv(str(old))
    other = tmp_path / "raw" / "realtime" / "ESP-101" / "2023" / "12" / "01" / "00"
    base.limit(3).coalesce(1).write.json(str(other))
    files = archive.listing(spark, f"file://{tmp_path}/raw")
    kind = F.when(F.col("path").startswith("historical"), "historical_csv").otherwise("realtime_json")
    listed = files.select(F.concat(F.lit(f"file://{tmp_path}/raw/"), "path").alias("source_uri"), kind.alias("source_kind"), F.lit("2024-01-01T01:00:00Z").alias("object_last_modified_utc"), F.col("sha256").alias("source_sha256"), "size_bytes")
    assert listed.count() == 3
    m = publish.manifest_of(spark, listed, "m1", "2024-01-01", "2024-01-01", 1)
    assert len(m["objects"]) == 2 and publish.objects_of(spark, m).count() == 2
    pumps = spark.createDataFrame([(f"ESP-{i}", "v1", "North", 150.0, None, 60.0, 120.0, 110.0) for i in (101, 102, 103)], PUMP)
    root, digest = f"file://{tmp_path}/pub", publish.sha256(m)
    report = publish.run_manifest(spark, m, pumps, root, "r1", digest)
    assert report["counts"]["silver_rows"] == 125 and report["counts"]["input_rows"] == 125 and report["counts"]["duplicate_delivery_ids"] == 0
    assert report["rules_version"] and report["window"] == {"start_date": "2024-01-01", "end_date": "2024-01-01", "late_arrival_lookback_days": 1}
    k = publish.published_kpis(spark, root, "2024-01-01", "2024-01-01")
    assert {r.esp_id: r.samples for r in k.collect()} == {"ESP-101": 45, "ESP-102": 40, "ESP-103": 40} and publish.published_kpis(spark, root, "2024-01-02", "2024-01-03").count() == 0
    plan = k._jdf.queryExecution().toString()
    assert "publication_run_id" in plan.split("PartitionFilters")[1][:300] and "event_date" in plan.split("PartitionFilters")[1][:300]
    assert publish.published_quality(spark, root).first().rows_seen == 125
    with pytest.raises(ValueError, match="recorded hash"):
        publish.run_manifest(spark, m, pumps, root, "r2", "0" * 64)
    changed = next(p for p in day.iterdir() if p.name.startswith("part-"))
    changed.write_text(changed.read_text() + "{}\n")
    with pytest.raises(ValueError, match="differs from the manifest"):
        publish.run_manifest(spark, m, pumps, root, "r3", digest)
    changed.unlink()
    with pytest.raises(ValueError, match="differs from the manifest"):
        publish.scan_manifest(spark, m)


def test_manifest_problems():
    good = publish.manifest("m", "2024-01-01", "2024-01-01", 1, [{"uri": "a", "source_kind": "x", "sha256": "0", "size_bytes": 1, "last_modified_utc": None, "more": 2}])
    assert good["objects"] == [{"uri": "a", "source_kind": "x", "sha256": "0", "size_bytes": 1}] and not list(publish.manifest_problems(good))
    for change in ({"manifest_version": 2}, {"start_date": "2025-01-01"}, {"objects": [{}]}, {"late_arrival_lookback_days": -1}, {"end_date": None}, {"objects": 3}):
        assert list(publish.manifest_problems(good | change)), change


def test_ledger(spark, tmp_path):
    (tmp_path / "l.jsonl").write_text('{"event_id": "a", "run_id": "r", "more": 1}\n\n{"event_id": "b", "run_id": "r"}\n')
    assert sorted(r.event_id for r in reconcile.read_ledger(spark, str(tmp_path / "l.jsonl")).collect()) == ["a", "b"]
    (tmp_path / "m.jsonl").write_text('{"event_id": "a"}\n{"event_id": \n')
    with pytest.raises(Exception):  # noqa: B017
        reconcile.read_ledger(spark, str(tmp_path / "m.jsonl")).collect()
