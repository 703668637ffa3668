from pyspark.sql import functions as F

from derrickflow.functions.ids import identity, spelled
from derrickflow.operators.exactly_once import Store, exactly_once

A, B = "0300ed42-3af7-5369-a097-32e42f356c0f", "1e8ea234-91d3-53cd-91f5-852dad47302f"


def frame(spark, rows):
    return spark.createDataFrame(rows, "event_id string, n int, bucket string, uri string")


def kept(df):
    return sorted((r.id, r.n, r._copies) for r in df.select(spelled(F.col("_id")).alias("id"), "n", "_copies").collect() if r.id), sum(1 for r in df.collect() if r._id is None)


def up(store, df, name):
    store.upsert(df, name, identity(F.col("event_id")), F.lpad(F.col("n").cast("string"), 5, "0"))


def test_copies_collapse_within_and_across_batches(spark):
    store = Store(spark, 3)
    one = frame(spark, [(A, 2, "x", None), (A.upper(), 1, "x", None), (None, 7, "x", ""), ("", 8, "x", "")])
    two = frame(spark, [("{" + A + "}", 0, "y", None), (" urn:uuid:" + B, 5, "y", None)])
    up(store, one, "one")
    up(store, two, "two")
    assert kept(store.compact()) == ([(A, 0, 3), (B, 5, 1)], 2)


def test_a_batch_upserted_again_replaces_itself(spark):
    store = Store(spark, 2)
    one = frame(spark, [(A, 1, "x", None)] * 5)
    for _ in range(3):
        up(store, one, "one")
    assert kept(store.compact()) == ([(A, 1, 5)], 0)


def test_many_copies_of_one(spark):
    df = spark.range(20000).select(F.when(F.col("id") % 3 == 0, F.lit(A)).otherwise(F.sha2(F.col("id").cast("string"), 256).substr(1, 32)).alias("event_id"), F.col("id").cast("int").alias("n"))
    out = exactly_once(df, identity(F.col("event_id")), F.lpad(F.col("n").cast("string"), 8, "0"), 1 << 20)
    assert out.count() == 20000 - 6667 + 1 and out.where("_copies > 1").first()._copies == 6667 and out.where("_copies > 1").first().n == 0


def test_no_rows(spark):
    assert exactly_once(frame(spark, []), identity(F.col("event_id")), F.lit("a"), 0) is None


def test_more_runs_than_are_merged_at_once(spark, monkeypatch):
    from derrickflow.operators import exactly_once as E

    monkeypatch.setattr(E, "FAN_IN", 2)
    store = Store(spark, 1)
    for i in range(5):
        up(store, frame(spark, [(A, i, "x", None), (None, i, "x", None), (f"{i:032x}", i, "x", None)]), str(i))
    rows, nameless = kept(store.compact())
    assert nameless == 5 and (A, 0, 5) in rows and len(rows) == 6


def test_clashing_names(spark):
    df = spark.createDataFrame([(A, 1, 2, "q"), (A, 0, 3, "r")], "event_id string, n int, _id int, _copies string")
    store = Store(spark, 2)
    up(store, df, "one")
    row = store.compact().first()
    assert (row.n, row._id_given, row._copies_given, row._copies) == (0, 3, "r", 2)


def blocks(store):
    return store.spark.read.option("recursiveFileLookup", "true").parquet(f"{store.folder}/catalogue").where("kind = 'run'")


def test_blocks_grow_with_the_batch_not_with_the_buckets(spark):
    """A small batch in a store of many buckets makes few blocks, and rows without an identifier make none."""
    df = spark.range(6000).select(F.when(F.col("id") % 10 > 2, F.sha2(F.col("id").cast("string"), 256).substr(1, 32)).alias("event_id"), F.col("id").cast("int").alias("n"))
    store = Store(spark, 24)
    store.upsert(df, "one", identity(F.col("event_id")), F.lpad(F.col("n").cast("string"), 8, "0"))
    assert blocks(store).count() <= 24 + 6000 // 4096 + 2 and blocks(store).agg(F.sum("n_rows")).first()[0] == 4200
    out = store.compact()
    assert out.count() == 6000 and out.where("_id is null").count() == 1800 and store.lost().count() == 0


def test_messages_stay_where_they_are(spark, tmp_path):
    """Files are indexed in place; the kept messages are read without the lost places, whatever columns are wanted."""
    at = str(tmp_path / "t")
    frame(spark, [(A, 2, "x", "p"), (A.upper(), 1, "y", "q"), (B, 3, "z", "r"), (None, 4, "w", "s")]).coalesce(1).write.parquet(at)
    store = Store(spark, 2)
    for _ in range(2):
        store.upsert_files(at, "t", ["event_id"], identity(F.col("event_id")), F.lpad(F.col("n").cast("string"), 5, "0"))
    assert sorted((r.uri, r._copies) for r in store.messages(["uri"]).collect()) == [("q", 2), ("r", 1), ("s", 1)]
    assert store.lost().count() == 1 and {r._copies for r in store.index().collect()} == {1, 2}
    assert set(store.messages().columns) == {"event_id", "n", "bucket", "uri", "_id", "_copies"}
