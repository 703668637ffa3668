import json
import random

import pytest
from pyspark.sql import functions as F

from derrickflow.functions import contract, rules, windows
from derrickflow.functions.ids import identity, spelled
from derrickflow.functions.times import micros
from derrickflow.functions.uuids import ALERTS, uuid5
from derrickflow.operators import alerts, reconcile, state
from derrickflow.operators import publication as pub
from derrickflow.plans import publish
from derrickflow.sources import landing
from derrickflow.streaming import lanes

M = 60_000_000


def test_identities(spark):
    u = "0300ed42-3af7-5369-a097-32e42f356c0f"
    forms = [u, u.upper(), "{" + u + "}", "urn:uuid:" + u, " " + u + " ", u.replace("-", ""), "URN:UUID:" + u.upper(), "other", "", "  ", None]
    df = spark.createDataFrame([(i, f) for i, f in enumerate(forms)], "i int, e string")
    got = [r.x for r in df.select("i", spelled(identity(F.col("e"))).alias("x")).orderBy("i").collect()]
    assert got == [u] * 7 + ["other", None, None, None]


def test_times(spark):
    texts = ["2024-01-01T00:00:00Z", "2024-01-01T05:30:00.123+05:30", "2024-01-01T00:00:00", "x", None, "2024-13-01T00:00:00Z", "2024-01-01", "2024-01-01T00:00Z"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    base = 1_704_067_200_000_000
    assert [r[0] for r in df.orderBy("i").select(micros(F.col("t"))).collect()] == [base, base + 123_000, None, None, None, None, None, base]


def test_uuid5_equals_the_standard(spark):
    import uuid

    names = ["", "a|b|c", "é|ü", "x" * 500]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert [r[0] for r in df.select(uuid5(ALERTS, F.col("n"))).collect()] == [str(uuid.uuid5(uuid.UUID(ALERTS), n)) for n in names]


def test_ordered_computations_against_plain_ones(spark):
    rng = random.Random(2)
    rows = [(rng.choice("AB"), rng.randrange(5 * 3_600_000_000), i, rng.randrange(100)) for i in range(400)]
    df = spark.createDataFrame(rows, "k string, t long, i int, v int")
    n = windows.numbered(df, ["k"], "t", ["i"])
    roll = {(r.i): (r.rn, r.s) for r in windows.rolling(n, ["k"], "rn", 3, {"s": F.sum("v")}, chunk=16).collect()}
    top = {r.i: r.m for r in windows.running_max(df, ["k"], "t", ["i"], "v", "m").collect()}
    prev = {r.i: r.prev_v for r in windows.previous(df, ["k"], "t", ["i"], ["v"]).collect()}
    for k in "AB":
        own = sorted((t, i, v) for kk, t, i, v in rows if kk == k)
        vs = [v for *_, v in own]
        for p, (_, i, _) in enumerate(own):
            assert roll[i] == (p + 1, sum(vs[max(0, p - 3) : p + 1]))
            assert top[i] == (max(vs[:p]) if p else None) and prev[i] == (vs[p - 1] if p else None)


def events(spark, rows):
    df = spark.createDataFrame(rows, "esp_id string, ts long, event_id string, flow_rate double, motor_temperature double")
    return df.withColumns({"status": F.lit("RUNNING"), "scenario": F.lit("normal"), "vibration": F.lit(1.0), "motor_current": F.lit(1.0), "tubing_pressure": F.lit(None).cast("double")})


def plain_alerts(rows, cooldown):
    out, s = [], {}
    for e, ts, i, flow, temp in sorted(rows, key=lambda r: (r[0], r[1], r[2])):
        if flow < 60 and temp > 120:
            if e not in s:
                s[e] = [i, 0]
            if ts >= s[e][1]:
                out.append((e, i, "trigger", s[e][0]))
                s[e][1] = ts + cooldown
            else:
                out.append((e, i, "suppressed", s[e][0]))
        elif e in s:
            out.append((e, i, "recovery", s.pop(e)[0]))
    return sorted(out)


def test_alert_episodes_against_a_plain_fold(spark):
    rng = random.Random(8)
    rows = [(f"E{rng.randrange(3)}", 1 + rng.randrange(400) * 40_000_000, f"id{i:04}", rng.choice([50.0, 50.0, 50.0, 70.0]), 125.0) for i in range(500)]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    d = alerts.decisions(events(spark, rows))
    got = sorted((r.esp_id, r.event_id, r.kind, r.episode_start) for r in d.where("rule_id = 'LOW_FLOW_OVERHEAT'").collect())
    assert got == plain_alerts(rows, rules.COOLDOWN) and {g[2] for g in got} == {"trigger", "suppressed", "recovery"}
    a = alerts.alerts(d)
    assert a.select("alert_id").distinct().count() == a.count() == sum(g[2] != "suppressed" for g in got)
    assert {r.severity for r in a.collect()} == {"warning", "info"}
    assert alerts.decisions(events(spark, [])).count() == 0


def test_fifty_hot_readings_send_one_alert(spark):
    d = alerts.decisions(events(spark, [("E", 1 + i * 1_000_000, f"{i:03}", 10.0, 130.0) for i in range(50)]))
    assert {r.kind: r["count"] for r in d.groupBy("kind").count().collect()} == {"trigger": 1, "suppressed": 49}


def test_latest_state_and_outcomes(spark):
    rows = [("A", 10, 1, "a"), ("A", 20, 2, "b"), ("A", 20, 3, "c"), ("A", 15, 4, "d"), ("B", 5, 9, "e"), (None, 99, 1, "f")]
    df = spark.createDataFrame(rows, "esp_id string, ts long, arrived long, id string")
    assert {(r.esp_id, r.id) for r in state.latest(df, F.col("arrived"), ["id"]).collect()} == {("A", "b"), ("B", "e")}
    got = {r.id: r.outcome for r in state.outcomes(df.where("esp_id is not null"), "arrived", ["id"]).collect()}
    assert got == {"a": "processed", "b": "processed", "c": "superseded", "d": "superseded", "e": "processed"}


def landed(spark, tmp_path):
    base = landing.generate(spark, 3, 30, "normal")
    base.where("schema_version = 1").coalesce(1).write.json(str(tmp_path / "json"))
    again = base.where("esp_id = 'ESP-101'").limit(5).withColumn("source", F.lit("historical"))
    fresh = again.withColumn("event_id", F.concat(F.lit("h-"), "event_id"))
    fresh.select("event_id", "status", *[c for c in contract.FIELDS if c not in ("event_id", "status", "scenario", "pump_frequency")]).coalesce(1).write.option("header", True).csv(str(tmp_path / "csv"))
    with open(tmp_path / "json" / "part-bad.json", "w") as f:
        f.write('[1]\n{"schema_version": 1}\n')
    h = landing.read_csv(spark, str(tmp_path / "csv")).withColumn("source_kind", F.lit("historical_csv"))
    r = landing.read_json(spark, str(tmp_path / "json")).withColumn("source_kind", F.lit("realtime_json"))
    both = landing.union_sources(h, r).withColumns({"ingested_at": F.current_timestamp(), "_place": F.monotonically_increasing_id()})
    return both


def test_sources_by_name_and_publication(spark, tmp_path):
    both = landed(spark, tmp_path)
    pumps = spark.createDataFrame([(f"ESP-{i}", "v1", "North", 150.0, None, 60.0, 120.0, 110.0) for i in (101, 102, 103)], "esp_id string, metadata_version string, field string, rated_capacity_m3_day double, installation_date date, min_flow_rate double, max_motor_temperature double, baseline_liquid_rate_m3_day double")
    v = pub.validated(both, pumps)
    assert v.where("source_kind = 'historical_csv' and rule_id = 'OK'").count() == 5
    assert v.where("malformed is not null").count() == 1
    objects = [{"uri": u, "source_kind": "x", "sha256": "0", "size_bytes": 1} for u in "ba"]
    m = publish.manifest("m", "2024-01-01", "2024-01-01", 1, objects)
    assert publish.sha256(m) == publish.sha256(publish.manifest("m", "2024-01-01", "2024-01-01", 1, objects[::-1]))
    d = pub.dispositions(v, "2024-01-01", "2024-01-01").drop("malformed")
    root = f"file://{tmp_path}/pub"
    one = publish.publish(d, pub.dimension(pumps), root, "r1", m)
    two = publish.publish(d, pub.dimension(pumps), root, "r2", m)
    assert one["canonical_data_sha256"] == two["canonical_data_sha256"] and one["counts"]["unexplained_rows"] == 0 and one["counts"]["silver_rows"] == 95
    pointer, silver, gold = publish.published(spark, root)
    assert pointer["published_run_id"] == "r2" and silver.count() == 95 and gold.count() == 3
    with pytest.raises(FileExistsError):
        publish.publish(d, pub.dimension(pumps), root, "r1", m)
    with pytest.raises(RuntimeError, match="quality gate"):
        publish.publish(d, pub.dimension(pumps).limit(1), root, "r3", m)
    assert publish.published(spark, root)[0]["published_run_id"] == "r2"
    assert json.loads(open(f"{tmp_path}/pub/staging/r3/quality-report.json").read())["quality_passed"] is False
    plan = silver.where("event_date = '2024-01-01'")._jdf.queryExecution().toString()
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters")[1][:200]


def test_manifests_are_checked():
    with pytest.raises(ValueError):
        publish.manifest("m", "2024-01-02", "2024-01-01", 1, [])
    with pytest.raises(ValueError):
        publish.manifest("m", "2024-01-01", "2024-01-01", 1, [{"uri": "a"}])
    good = publish.manifest("m", "2024-01-01", "2024-01-01", 1, [{"uri": "a", "source_kind": "x", "sha256": "0", "size_bytes": 1}])
    with pytest.raises(ValueError):
        publish.verify_manifest(good, "0")


def test_dispositions(spark):
    base = landing.generate(spark, 1, 6).withColumn("k", F.substring("timestamp", 18, 2).cast("int"))
    same, other = base.where("k = 1"), base.where("k = 2").withColumn("flow_rate", F.col("flow_rate") + 1)
    rows = base.withColumn("source_uri", F.lit("z")).unionByName(same.withColumn("source_uri", F.lit("a"))).unionByName(same.withColumn("source_uri", F.lit("a"))).unionByName(other.withColumn("source_uri", F.lit("b")))
    rows = rows.unionByName(base.where("k = 3").withColumns({"source_uri": F.lit("c"), "status": F.lit("x")})).withColumns({"source_kind": F.lit("x"), "ingested_at": F.lit(None).cast("timestamp"), "_place": F.monotonically_increasing_id()})
    pumps = spark.createDataFrame([("ESP-101",)], "esp_id string")
    v = pub.validated(rows, pumps)
    d = pub.dispositions(v, "2024-01-01", "2024-01-01")
    assert pub.accounting(d).first().asDict() == {"input_rows": 10, "invalid_rows": 1, "out_of_scope_rows": 0, "conflict_rows": 2, "duplicate_rows": 2, "silver_rows": 5}
    assert d.where("disposition = 'SILVER' and k = 1").first().source_uri == "a"
    assert pub.accounting(pub.dispositions(v, "2025-01-01", "2025-01-01")).first().out_of_scope_rows == 9
    empty = pub.dispositions(v.where("false"), "2024-01-01", "2024-01-01")
    assert pub.accounting(empty).first().input_rows == 0 and pub.quality(pub.silver(empty, pub.dimension(spark.createDataFrame([], "esp_id string, metadata_version string, field string")))).first().rows_seen == 0


def test_reconciliation(spark):
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    assert [r.id for r in reconcile.missing(ids("a", "b", "c"), ids("a", "a"), ids("b")).collect()] == ["c"]
    assert reconcile.differences(ids("a", "b", None), ids(None, "b", "a")).count() == 0
    assert {(r.side, r.n, r.id) for r in reconcile.differences(ids("a", "a", "b"), ids("a", "c")).collect()} == {("lost", 1, "a"), ("lost", 1, "b"), ("extra", 1, "c")}


def test_streams_equal_batches(spark, tmp_path):
    rows = landing.generate(spark, 2, 400, "low_flow", step_us=30_000_000).union(landing.generate(spark, 2, 40, run="other"))
    r = rows.withColumns({"id": identity(F.col("event_id")), "ts": micros(F.col("timestamp"))}).withColumn("arrived", F.col("ts") + 1)
    r.union(r.limit(50)).repartition(3).sortWithinPartitions("ts").write.parquet(str(tmp_path / "in"))
    stream = lambda: lanes.read_stream(spark, str(tmp_path / "in"), r.schema, 1)
    hourly = lanes.hourly(spark, stream(), f"file://{tmp_path}/h")
    want = r.groupBy("esp_id", F.floor(F.col("ts") / 3_600_000_000).alias("h")).agg(F.count("*").alias("n"))
    assert sorted(tuple(x) for x in hourly.select("esp_id", F.floor(F.col("period") / 3_600_000_000), "n").collect()) == sorted(tuple(x) for x in want.collect())
    latest = lanes.latest_state(spark, stream(), ["status"], f"file://{tmp_path}/s")
    assert sorted((x.esp_id, x.ts) for x in latest.collect()) == sorted((x.esp_id, x.ts) for x in state.latest(r, F.col("arrived"), ["status"]).collect())
    q = lanes.alerts(lanes.read_stream(spark, str(tmp_path / "in"), r.schema)).writeStream.format("memory").queryName("sent").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = alerts.decisions(r).where("kind = 'trigger'").count()
    assert spark.table("sent").where("kind = 'trigger'").count() == batch > 0


def test_gauges_and_severities(spark):
    assert [r[0] for r in spark.createDataFrame([(59.0,), (60.0,), (None,), (float("nan"),)], "v double").select(rules.level(F.col("v"), 60.0, None, below=True)).collect()] == ["warning", "normal", "unknown", "unknown"]
    df = spark.createDataFrame([(["SHUTDOWN"],), (["A"],), (["A", "B"],), ([],)], "r array<string>")
    assert [r[0] for r in df.select(rules.severity(F.col("r"))).collect()] == ["critical", "warning", "critical", "normal"]
    df = spark.createDataFrame([(1.0, True), (1.0, False), (50.0, True), (None, True)], "a double, ok boolean")
    assert [r[0] for r in df.select(reconcile.freshness(F.col("a"), F.col("ok"))).collect()] == ["fresh"] * 4
    df = spark.createDataFrame([(9.9,), (10.0,), (44.9,), (45.0,), (None,)], "a double")
    assert [r[0] for r in df.select(reconcile.freshness(F.col("a"), F.lit(False))).collect()] == ["fresh", "stale", "stale", "unavailable", "unavailable"]
    df = spark.createDataFrame([(74.9,), (75.0,), (75.1,)], "v double")
    level = lambda **how: [r[0] for r in df.select(rules.level(F.col("v"), None, 75.0, **how)).collect()]
    assert level() == ["normal", "critical", "critical"] and level(reach=False) == ["normal", "normal", "critical"]
