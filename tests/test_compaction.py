import random
import uuid

from pyspark.sql import functions as F

from derrickflow.functions.ids import identity
from derrickflow.operators.compaction import compact

SCHEMA = "event_id string, esp_id string, source_uri string, key string, path string"


def ident(i):
    return str(uuid.UUID(int=i * 7919 + 1))


def brute(rows):
    held, nameless = {}, set()
    for e, _, u, *_ in rows:
        if u is None:
            continue
        held.setdefault(u, set())
        if e:
            held[u].add(e.lower().replace("-", ""))
        else:
            nameless.add(u)
    return {a for a in held if a not in nameless and any(b != a and (held[a] < held[b] or held[a] == held[b] and b < a) for b in held)}


def write(spark, rows, path, files=3):
    spark.createDataFrame(rows, SCHEMA).repartition(files).write.parquet(path)


def test_against_brute_force(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for o in range(60):
        ids = rng.sample(range(25 if o % 2 else 400), rng.randint(1, 4))
        for i in ids + ids[: rng.randint(0, 1)]:
            e = ident(i)
            rows.append((rng.choice([e, e.upper(), e.replace("-", "")]) if rng.random() > 0.02 else None, f"ESP-{i % 3}" if i % 5 else None, f"s3://b/{o:03}", "k", None))
    rows += [(ident(1), "ESP-1", f"s3://hot/{n:03}", "k", "p") for n in range(40)]  # one id in very many objects
    write(spark, rows, str(tmp_path / "t"))
    done = compact(spark, str(tmp_path / "t"))
    assert {r.uri for r in done.absorbed.collect()} == brute(rows)
    out = spark.read.parquet(done.folder)
    assert out.count() == done.rows == len({r[0].lower().replace("-", "") for r in rows if r[0]}) + sum(not r[0] for r in rows)
    assert out.where("event_id is not null").groupBy(identity(F.col("event_id")).alias("i")).count().where("count > 1").count() == 0
    per = {r.key: r.n for r in done.files.groupBy("key").agg(F.count("*").alias("n")).collect()}
    assert set(per.values()) == {1} and None in per


def test_small_target_makes_more_files(spark, tmp_path):
    write(spark, [(ident(i), "ESP-1", f"s3://b/{i}", "k", None) for i in range(50)], str(tmp_path / "t"), 4)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    try:
        done = compact(spark, str(tmp_path / "t"), target=300)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "128m")
    assert done.files.count() > 1 and spark.read.parquet(done.folder).count() == 50


def test_empty_table(spark, tmp_path):
    write(spark, [], str(tmp_path / "t"), 1)
    done = compact(spark, str(tmp_path / "t"))
    assert done.rows == 0 and done.files.count() == 0 and done.absorbed.count() == 0


def test_untouched_row_groups_are_copied_undecoded(spark, tmp_path):
    """Files of one pump without repeats are joined as they are; only those that lose a row are decoded, and different schemas stay apart."""
    at = str(tmp_path / "t")
    for n in range(12):
        spark.createDataFrame([(ident(100 * n + i), f"ESP-{n % 3}", f"s3://b/{n:02}", "k", "p") for i in range(5)], SCHEMA).coalesce(1).write.mode("append").parquet(at)
    done = compact(spark, at)
    assert done.decoded == 0 and done.rows == 60 and done.files.count() == 3
    again = [(ident(100 * n), "ESP-1", f"s3://b/{n:02}", "k", "p") for n in range(4)] + [(ident(999), None, "s3://b/99", "k", "p")]
    spark.createDataFrame(again, SCHEMA).coalesce(1).write.mode("append").parquet(at)
    done = compact(spark, at)
    out = spark.read.parquet(done.folder)
    assert 0 < done.decoded < 40 and done.rows == out.count() == 61 == out.select("event_id").distinct().count()


def test_cases_come_from_what_was_copied(spark, tmp_path):
    """An object counts as absorbed only where the copied rows hold its events."""
    from derrickflow.operators import compaction as C

    rows = [(ident(i), "ESP-1", "s3://b/big", "k", None) for i in range(6)] + [(ident(i), "ESP-1", "s3://b/small", "k", None) for i in range(2)]
    rows += [(ident(i), "ESP-1", "s3://b/same", "k", None) for i in range(2)]
    write(spark, rows, str(tmp_path / "t"))
    done = compact(spark, str(tmp_path / "t"))
    assert {r.uri for r in done.absorbed.collect()} == {"s3://b/small", "s3://b/same"}
    found = C.located(spark.read.parquet(str(tmp_path / "t")), "event_id", "source_uri")
    again = C.repeats(found)
    held = C.absorbed(found, again)
    copied = spark.read.parquet(done.folder).select(identity(F.col("event_id")).alias("id"), F.col("source_uri").alias("uri"))
    assert {r.uri for r in copied.select("uri").distinct().collect()} == {"s3://b/big"}
    assert C.left_out(held, again, copied).count() == 2
    assert C.left_out(held, again, copied.limit(0)).count() == 0 == C.left_out(held, again, found.select("id", "uri").where("uri <> 's3://b/big'")).count()
