"""Far too many small files: consolidation by copying encoded blocks.

1. plan: identities are compared in narrow columns only. Objects (raw files) all of whose events another
   object holds are left out as a whole; of every other event_id one row is kept, in an object that stays.
2. blocks: a row group that loses no row and holds one pump only is taken as it is, by its footer entry. Only the others are
   read, without their surplus rows, and written as files with one block per pump. Full rows are never shuffled.
3. join: a pump's blocks, from whichever file, are copied byte by byte into few large files with
   rewritten footers. Schema, block counts and row totals are validated; any difference raises.
4. check: an object counts as absorbed if the copied files hold all its events and no row of its own.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from derrickflow.functions.ids import identity
from derrickflow.session import materialise, scratch, split_bytes, stored_bytes
from derrickflow.sources.blocks import copy_blocks, describe, schema_key, write_blocks
from derrickflow.sources.files import remove, resolve

#: Blocks to be copied: no tells a file's blocks apart, schema those that don't go together.
BLOCKS = "key string, uri string, no int, schema string, head binary, entry binary, n_rows long, n_bytes long"
#: Row groups of the input; pure: of one group only, whose name is then in key.
GROUPS = BLOCKS + ", first long, pure boolean"
COPIED = "key string, schema string, file long, uri string, n_blocks long, n_rows long, n_bytes long"
#: Rows of a stretch by which surplus rows find their row group.
STRETCH = 1 << 16
#: Bytes of an output file, and of rows held at once while packing.
TARGET, BUFFER = 128 << 20, 48 << 20


@dataclass
class Compacted:
    """folder: of the new files. files: one row per new file. absorbed: the objects that others hold entirely.

    decoded: rows that had to be read and written anew; all others were copied as they were.
    """

    folder: str
    files: DataFrame
    absorbed: DataFrame
    rows: int
    decoded: int


def located(df: DataFrame, key: str, object_: str) -> DataFrame:
    """id, uri, ord and the place (path, row) of every row of a Parquet input; only two columns are read."""
    place = F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("row")
    narrow = df.select(identity(F.col(key)).alias("id"), F.col(object_).alias("uri"), *place)
    return narrow.withColumn("ord", F.xxhash64("path", "row"))


def repeats(rows: DataFrame) -> DataFrame:
    """The rows whose id occurs more than once, with the kept row's ord and whether several objects hold the id.

    Ids are counted with partial aggregation, so that one id with very many copies is no burden; the
    join back is an equi-join whose other side has one row per id, which AQE splits if it is skewed.
    """
    ids = (
        rows.where("id is not null")
        .groupBy("id")
        .agg(F.count("*").alias("n"), F.min("ord").alias("kept"), F.min(F.xxhash64("uri")).alias("a"), F.max(F.xxhash64("uri")).alias("b"))
        .where("n > 1")
        .select("id", "kept", (F.col("a") != F.col("b")).alias("several"))
    )
    # written first, so that its size is known: if it is small, the join moves no rows
    return rows.join(materialise(ids, "ids"), "id")


def absorbed(rows: DataFrame, again: DataFrame) -> DataFrame:
    """Objects of which another holds every id and further ones, or exactly the same ids under a lesser uri.

    An object with a row without id, or with a null uri, is none. Only objects all of whose ids occur
    elsewhere are looked at. Of objects with the same ids one represents all; a representative is
    compared with the holders of its rarest id only, and a pair counts when as many ids are common as
    the object has. No list of an id's holders is ever gathered.
    """
    post = materialise(again.where("several and uri is not null").select("uri", "id").distinct(), "postings")
    extra = again.where("uri is not null").groupBy("uri", "id").agg((F.count("*") - 1).alias("x")).groupBy("uri").agg(F.sum("x").alias("x"))
    objects = rows.where("uri is not null").groupBy("uri").agg(F.count("*").alias("n_rows"), F.count("id").alias("n_ids"))
    shared = post.groupBy("uri").agg(F.count("*").alias("shared"), F.sum(F.xxhash64("id").cast("decimal(20,0)")).alias("f1"), F.bit_xor(F.xxhash64("id", F.lit(7))).alias("f2"))
    sized = materialise(
        shared.join(objects, "uri").join(extra, "uri", "left").select(
            "uri", (F.col("n_ids") - F.coalesce("x", F.lit(0))).alias("n"), "shared", (F.col("n_rows") > F.col("n_ids")).alias("nameless"), "f1", "f2"
        ),
        "objects",
    )
    # objects with only shared ids, by set: the least uri stands for the set. A holder with a nameless row is no case, but may absorb
    whole = sized.where("n = shared")
    leads = whole.groupBy("n", "f1", "f2").agg(F.min("uri").alias("lead"))
    cases = whole.where("not nameless").join(leads, ["n", "f1", "f2"]).select("uri", "n", "lead")
    same = cases.where("uri <> lead").select("uri", "n", F.col("lead").alias("by"))
    single = cases.where("uri = lead").select("uri", "n")
    df = post.groupBy("id").agg(F.count("*").alias("df"))
    rarest = (
        post.join(single, "uri").join(df, "id").groupBy("uri", "n").agg(F.min(F.struct("df", "id")).alias("r")).select("uri", "n", F.col("r.id").alias("id"))
    )
    follow = whole.join(leads, ["n", "f1", "f2"]).where("uri <> lead").select("uri")
    holders = post.join(follow, "uri", "left_anti").join(sized.select("uri", F.col("n").alias("n_by")), "uri").select(F.col("uri").alias("by"), "id", "n_by")
    wider = rarest.join(holders, "id").where("n_by > n").select("uri", "n", "by")
    pairs = same.unionByName(wider)
    common = pairs.join(post, "uri").join(post.withColumnRenamed("uri", "by"), ["by", "id"]).groupBy("uri", "by", "n").agg(F.count("*").alias("c"))
    return common.where("c = n").groupBy("uri").agg(F.min("by").alias("held_by"))


def _table(rows: list[dict], ddl: str) -> pa.Table:
    types = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.Table.from_pylist(rows, pa.schema([(n, types[t]) for n, t in (c.split() for c in ddl.split(", "))]))


def row_groups(spark: SparkSession, path: str, group: str, tasks: int) -> DataFrame:
    """GROUPS of all Parquet files at a path, from their footers."""

    def read(batches):
        for b in batches:
            rows = []
            for uri in b.column(0).to_pylist():
                fs, at = resolve(uri)
                with fs.open_input_file(at) as f:
                    meta = pq.ParquetFile(f).metadata
                column = next((i for i in range(meta.num_columns) if meta.schema.column(i).path == group), None)
                head, blocks = describe(uri)
                schema, first = hashlib.sha1(schema_key(head)).hexdigest()[:12], 0
                for no, (n, size, entry) in enumerate(blocks):
                    stats = None if column is None else meta.row_group(no).column(column).statistics
                    one = stats is not None and stats.has_null_count and stats.has_min_max and stats.null_count == 0 and isinstance(stats.min, str) and stats.min == stats.max
                    # longer values may stand cut in the footer
                    one = one and len(stats.min.encode()) < 64
                    none = stats is not None and stats.has_null_count and stats.null_count == n
                    row = {"key": stats.min if one else None, "uri": uri, "no": no, "schema": schema, "head": head, "entry": entry, "n_rows": n, "n_bytes": size, "first": first, "pure": one or none}
                    rows.append(row)
                    first += n
            yield from _table(rows, GROUPS).to_batches()

    # a listing: the files' contents aren't read
    paths = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
    return paths.repartition(tasks).mapInArrow(read, GROUPS)


def _pack(unit: int, groups: list[tuple[str, int, int]], skip: dict[str, np.ndarray], folder: str, group: str, key: str):
    """Blocks per group of what remains of some row groups (path, number, first row); at most BUFFER bytes of rows are held beside a row group's batch."""
    held, size, part = [], 0, 0

    def flush():
        nonlocal held, size, part
        table = pa.concat_tables(held, promote_options="default").combine_chunks()
        names = pc.fill_null(table.column(group).cast(pa.string()), "\0")
        codes = pc.dictionary_encode(names).combine_chunks()
        codes = codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes
        index = codes.indices.to_numpy(zero_copy_only=False)
        order = np.argsort(index, kind="stable")
        ends = np.cumsum(np.bincount(index, minlength=len(codes.dictionary))).tolist()
        uri, head, blocks = write_blocks(table.take(order), ends, folder, f"unit-{unit}-{part}", [group, key])
        schema = hashlib.sha1(schema_key(head)).hexdigest()[:12]
        for no, (name, (rows, n_bytes, entry)) in enumerate(zip(codes.dictionary.to_pylist(), blocks)):
            yield {"key": None if name == "\0" else name, "uri": uri, "no": no, "schema": schema, "head": head, "entry": entry, "n_rows": rows, "n_bytes": n_bytes}
        held, size, part = [], 0, part + 1

    file, open_ = None, None
    for path, no, first in sorted(groups):
        if path != file:
            fs, at = resolve(path)
            file, open_ = path, pq.ParquetFile(fs.open_input_file(at))
        gone = skip.get(path, np.empty(0, np.int64))
        for batch in open_.iter_batches(65536, row_groups=[no]):
            end = first + batch.num_rows
            lost = gone[np.searchsorted(gone, first) : np.searchsorted(gone, end)] - first
            if len(lost):
                keep = np.ones(batch.num_rows, bool)
                keep[lost] = False
                batch = batch.filter(pa.array(keep))
            first = end
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]).replace_schema_metadata(None))
                size += batch.nbytes
            if size > BUFFER:
                yield from flush()
    if held:
        yield from flush()


def compact(spark: SparkSession, path: str, key: str = "event_id", group: str = "esp_id", object_: str = "source_uri", target: int = TARGET, folder: str | None = None) -> Compacted:
    """Consolidate the Parquet table at path (a file or a folder of files) into few files per group, in folder (default: a scratch folder).

    Every id of `key` is kept once, rows without id all stay, whole and unchanged. Rows with a null
    group form a group of their own. An empty table gives no files. Columns other than key, group and
    object_ are carried along whatever their names and types. Blocks of different schemas go to different files.
    """
    df = spark.read.parquet(path)
    rows = located(df, key, object_)
    again = materialise(repeats(rows), "repeats")
    held = materialise(absorbed(rows, again), "held")
    # of each id the first row outside of absorbed objects stays: there is one, as what holds an absorbed object is absorbed by none in the end
    left = again.join(held.select("uri", F.lit(True).alias("out")), "uri", "left")
    kept = left.where("out is null").groupBy("id").agg(F.min("ord").alias("stays"))
    surplus = materialise(left.join(kept, "id").where("ord <> stays").select("path", "row"), "surplus")

    n_bytes = stored_bytes(spark, path)
    units = max(1, round(n_bytes / split_bytes(spark)))
    groups = materialise(row_groups(spark, path, group, 2 * units), "groups")
    total, lost = groups.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0], surplus.count()
    place = ["path", "stretch"]
    span = F.sequence(F.floor(F.col("first") / STRETCH), F.floor((F.col("first") + F.col("n_rows") - 1) / STRETCH))
    spread = groups.where("n_rows > 0").select(F.col("uri").alias("path"), "no", "first", "n_rows", F.explode(span).alias("stretch"))
    found = surplus.withColumn("stretch", F.floor(F.col("row") / STRETCH)).join(spread, place).where("row >= first and row < first + n_rows").select("path", "no", "row")
    touched = found.groupBy("path", "no").agg(F.count("*").alias("n_lost"))
    sorted_out = materialise(groups.join(touched.withColumnRenamed("path", "uri"), ["uri", "no"], "left"), "groups")
    whole = F.col("pure") & F.col("n_lost").isNull()
    direct = sorted_out.where(whole & (F.col("n_rows") > 0)).select(*[c.split()[0] for c in BLOCKS.split(", ")])
    open_ = sorted_out.where(~whole & (F.col("n_rows") > 0) & (F.coalesce("n_lost", F.lit(0)) < F.col("n_rows"))).withColumnRenamed("uri", "path")
    unit = F.pmod(F.xxhash64("path", "no"), F.lit(units)).cast("int").alias("unit")
    staged = scratch(spark, "blocks")

    def pack(key_, left, right):
        out = []
        if left.num_rows:
            where, skip = right.sort_by([("path", "ascending"), ("row", "ascending")]), {}
            at, row = np.asarray(where.column("path").to_pylist(), object), where.column("row").to_numpy()
            cuts = [0, *(np.flatnonzero(at[1:] != at[:-1]) + 1).tolist(), len(at)]
            for i, j in zip(cuts, cuts[1:]):
                if i < j:
                    skip[at[i]] = row[i:j]
            out = list(_pack(key_[0].as_py(), list(zip(*(left.column(c).to_pylist() for c in ("path", "no", "first")))), skip, staged, group, key))
        return _table(out, BLOCKS)

    # the tables below are small, their work isn't: a fixed number of partitions keeps AQE from putting it all into one task
    sides = open_.select("path", "no", "first", unit), found.select("path", "row", unit)
    left, right = (t.repartition(2 * units, "unit").groupBy("unit") for t in sides)
    packed = materialise(left.cogroup(right).applyInArrow(pack, BLOCKS), "packed")
    blocks = packed.unionByName(direct)
    folder = folder or scratch(spark, "compacted")
    tasks = 2 * max(spark.sparkContext.defaultParallelism, n_bytes // target)
    report = materialise(join_blocks(blocks, folder, target, tasks), "report")
    made = report.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.coalesce(F.sum("n_blocks"), F.lit(0))).first()
    want = blocks.agg(F.coalesce(F.sum("n_rows"), F.lit(0)), F.count("*")).first()
    decoded = packed.agg(F.coalesce(F.sum("n_rows"), F.lit(0))).first()[0]
    if (made[0], made[1]) != (want[0], want[1]) or made[0] != total - lost:
        raise RuntimeError(f"compaction made {made[0]} rows in {made[1]} blocks; packed were {want[0]} in {want[1]}, and {total - lost} rows are to be kept")
    remove(staged)
    copied = spark.read.schema(df.schema).parquet(folder).select(identity(F.col(key)).alias("id"), F.col(object_).alias("uri")) if made[0] else rows.select("id", "uri").limit(0)
    return Compacted(folder, report, left_out(held, again, copied), made[0], decoded)


def left_out(held: DataFrame, again: DataFrame, copied: DataFrame) -> DataFrame:
    """The objects of held (uri, held_by) of which the copied rows (id, uri) hold every event and no row of the object's own."""
    post = materialise(again.join(held, "uri", "left_semi").select(F.col("uri").alias("of"), "id").distinct(), "left-out")
    there = copied.select("id").join(post, "id").distinct().groupBy("of").agg(F.count("*").alias("n_there"))
    whole = post.groupBy("of").agg(F.count("*").alias("n")).join(there, "of").where("n = n_there").select(F.col("of").alias("uri"))
    return held.join(whole, "uri", "left_semi").join(copied.select("uri").distinct(), "uri", "left_anti")


def join_blocks(blocks: DataFrame, folder: str, target: int = TARGET, tasks: int = 16) -> DataFrame:
    """Copy catalogued blocks (BLOCKS) into files of about target bytes per key and schema; a row (COPIED) per file.

    Only numbers are put in order within a key; the blocks' footer entries are joined back.
    """
    small = blocks.select("key", "schema", "uri", "no", "n_bytes")
    order = Window.partitionBy("key", "schema").orderBy("uri", "no").rowsBetween(Window.unboundedPreceding, -1)
    at = small.select("uri", "no", F.floor(F.coalesce(F.sum("n_bytes").over(order), F.lit(0)) / target).alias("file"))
    placed = blocks.join(at, ["uri", "no"])

    def copy(table: pa.Table) -> pa.Table:
        key, schema, file = (table.column(c)[0].as_py() for c in ("key", "schema", "file"))
        some = sorted(zip(*(table.column(c).to_pylist() for c in ("uri", "no", "head", "entry"))))
        name = f"{hashlib.sha1(repr(key).encode()).hexdigest()[:16]}-{schema}-{file}.parquet"
        fs, base = resolve(folder)
        fs.create_dir(base, recursive=True)
        # a repeated attempt writes the same bytes under a temporary name of its own; the move makes one of them the file
        part = f"{base}/_{uuid.uuid4().hex}"
        n, rows, size = copy_blocks([(u, h, e) for u, _, h, e in some], part)
        if rows != sum(table.column("n_rows").to_pylist()):
            raise ValueError(f"{key}: {rows} rows copied, {sum(table.column('n_rows').to_pylist())} catalogued")
        fs.move(part, f"{base}/{name}")
        return _table([{"key": key, "schema": schema, "file": file, "uri": f"{folder}/{name}", "n_blocks": n, "n_rows": rows, "n_bytes": size}], COPIED)

    by = ["key", "schema", "file"]
    return placed.repartition(tasks, *by).groupBy(*by).applyInArrow(copy, COPIED)
