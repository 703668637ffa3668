"""Messages delivered more than once: idempotent upserts into hash-bucketed sorted storage.

The storage has two parts. Messages stay in the files they came in, which never change. Beside them lies an index by
identifier: narrow entries (identifier, order of delivery, place of the message), hash-bucketed and sorted.

An upsert reads only what the index needs. Equal identifiers are collapsed before the exchange by bucket, so that an
identifier with very many copies is one entry per split, and again when a bucket's entries are written as sorted runs. A batch is
catalogued under its name; the same batch upserted again replaces itself. Compaction merges the sorted runs of
all batches bucket by bucket and collapses equal identifiers to one. The places of collapsed entries are kept: a
reader of the messages leaves these out and moves no message. Messages without identifier need no entry.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from derrickflow.session import materialise, scratch
from derrickflow.sources.blocks import write_blocks
from derrickflow.sources.files import resolve

ID, ORDER, COPIES, BUCKET = "_id", "_order", "_copies", "_bucket"
ENTRY = pa.schema([(BUCKET, pa.int32()), (ID, pa.binary()), (ORDER, pa.binary()), ("file", pa.int64()), ("row", pa.int64()), (COPIES, pa.int64())])
ENTRY_DDL = f"{BUCKET} int, {ID} binary, {ORDER} binary, file long, row long, {COPIES} long"
#: kind: run (a block of sorted entries of the buckets bucket..last) or lost (places of collapsed entries).
RUNS = "kind string, bucket int, last int, uri string, block int, n_rows long"
RUN_SCHEMA = pa.schema([("kind", pa.string()), ("bucket", pa.int32()), ("last", pa.int32()), ("uri", pa.string()), ("block", pa.int32()), ("n_rows", pa.int64())])
SPAN = pa.schema([("path", pa.string()), ("file", pa.int64()), ("no", pa.int32()), ("first", pa.int64()), ("n", pa.int64())])
BUFFER = 48 << 20
#: Rows of a stretch by which places find their row group.
STRETCH = 1 << 16
#: Entries of a block at least; it may hold several buckets. Entries a bucket is to have, bytes of messages for one, and buckets at most (their runs are then more).
BLOCK, FULL, ENTRY_BYTES, MOST = 1 << 12, 1 << 17, 64, 1 << 16
#: Runs merged at once. More of them are merged in several levels, each of which writes its runs.
FAN_IN = 64


def in_order(table: pa.Table) -> pa.Table:
    keys = [(c, "ascending") for c in (BUCKET, ID, ORDER, "file", "row")]
    return table.take(pc.sort_indices(table, sort_keys=keys))


def collapse(table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """Of consecutive entries with equal identity the first, with the copies of all; and the places of the others."""
    n = table.num_rows
    ids = table.column(ID).combine_chunks()
    ids = ids.chunk(0) if isinstance(ids, pa.ChunkedArray) else ids
    new = np.ones(n, bool)
    if n > 1:
        new[1:] = ~pc.equal(ids[1:], ids[:-1]).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(new)
    copies = np.add.reduceat(table.column(COPIES).to_numpy(), at) if n else np.empty(0, np.int64)
    kept = table.take(at) if len(at) < n else table
    kept = kept.set_column(kept.schema.get_field_index(COPIES), COPIES, pa.array(copies, pa.int64()))
    return kept, table.select(["file", "row"]).filter(pa.array(~new))


def merge_runs(runs: list[Iterator[pa.Table]]) -> Iterator[tuple[pa.Table, pa.Table]]:
    """Merge runs (sorted tables of one bucket, an identity at most once in each) into sorted pieces with collapsed identities, and what is lost.

    Holds a piece of each run. Everything up to the least of the pieces' last identities is complete.
    """
    heads: list[pa.Table | None] = [next(r, None) for r in runs]
    while any(h is not None for h in heads):
        edge = min(h.column(ID)[-1].as_py() for h in heads if h is not None)
        out = []
        for i, h in enumerate(heads):
            if h is None or h.column(ID)[0].as_py() > edge:
                continue
            # both sides are sorted: the number of rows up to the edge is found by bisection
            lo, hi = 0, h.num_rows
            while lo < hi:
                mid = (lo + hi) // 2
                lo, hi = (mid + 1, hi) if h.column(ID)[mid].as_py() <= edge else (lo, mid)
            out.append(h.slice(0, lo))
            heads[i] = h.slice(lo) if lo < h.num_rows else next(runs[i], None)
        t = pa.concat_tables(out).combine_chunks()
        yield collapse(in_order(t) if len(out) > 1 else t)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to tables of about BUFFER bytes."""
    held, size = [], 0
    for b in batches:
        if b.num_rows:
            held.append(b)
            size += b.nbytes
        if size > BUFFER:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


class _Writer:
    """Writes sorted entries and lost places to files of a folder, and says what is where."""

    def __init__(self, folder: str):
        self.folder, self.said = folder, []

    def run(self, kept: pa.Table) -> None:
        bucket = kept.column(BUCKET).to_numpy()
        ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
        # whole buckets are put together to blocks, so that a small batch isn't cut into as many blocks as there are buckets
        cut, start = [], 0
        for e in ends.tolist():
            if e - start >= BLOCK or e == len(bucket):
                cut.append(e)
                start = e
        uri, _, blocks = write_blocks(kept, cut, f"{self.folder}/runs", "run", [BUCKET])
        first = [0, *cut[:-1]]
        self.said += [("run", int(bucket[a]), int(bucket[e - 1]), uri, i, e - a) for i, (a, e) in enumerate(zip(first, cut))]

    def lost(self, places: pa.Table) -> None:
        if places.num_rows:
            fs, base = resolve(f"{self.folder}/lost")
            fs.create_dir(base, recursive=True)
            name = f"lost-{uuid.uuid4().hex}.parquet"
            with fs.open_output_stream(f"{base}/{name}") as sink:
                pq.write_table(places, sink, compression="zstd")
            self.said.append(("lost", -1, -1, f"{self.folder}/lost/{name}", 0, places.num_rows))

    def batch(self) -> pa.RecordBatch:
        said, self.said = self.said, []
        return pa.RecordBatch.from_pylist([dict(zip(RUN_SCHEMA.names, r)) for r in said], RUN_SCHEMA)


class Store:
    """Messages with a hash-bucketed sorted index by identifier, in a folder that all executors share."""

    def __init__(self, spark: SparkSession, buckets: int, folder: str | None = None):
        self.spark, self.buckets = spark, buckets
        self.folder = folder or scratch(spark, "store")
        self.batches: dict[str, tuple[str, list[str], F.Column]] = {}
        self._merged: DataFrame | None = None

    @classmethod
    def for_bytes(cls, spark: SparkSession, n_bytes: int, folder: str | None = None) -> Store:
        """A store whose buckets hold about FULL entries (taking ENTRY_BYTES bytes of messages for one), and are no fewer than the cores."""
        return cls(spark, min(MOST, max(spark.sparkContext.defaultParallelism, -(-n_bytes // (FULL * ENTRY_BYTES)))), folder)

    def upsert(self, batch: DataFrame, name: str, identity: F.Column, order: F.Column) -> None:
        """Add a batch under a name that is its own; doing so again with that name replaces the batch.

        Of equal identities the row of least `order` (a binary or string column, ties by place) is kept. A null
        identity is none: such rows are kept as they are. A column that has one of this module's four names is carried
        under that name with _given behind it. An empty batch adds nothing.
        """
        own, names = {ID, ORDER, COPIES, BUCKET}, {}
        for c in batch.columns:
            names[c] = c
            while names[c].lower() in own or (names[c] != c and names[c] in batch.columns):
                names[c] += "_given"
        # identity and order are written beside the messages, as they may be of columns that are renamed
        ready = batch.select(*[F.col(f"`{c}`").alias(to) for c, to in names.items()], identity.alias(ID), order.cast("binary").alias(ORDER))
        to = f"{self.folder}/messages/{self._safe(name)}"
        ready.write.mode("overwrite").parquet(to)
        self.upsert_files(to, name, [ID], F.col(ID), F.col(ORDER))

    def upsert_files(self, path: str, name: str, key: list[str], identity: F.Column, order: F.Column) -> None:
        """upsert() of Parquet files that stay where they are and must not change. key: the columns that identity refers to."""
        n, folder = self.buckets, self.folder
        place = F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")
        scan = self.spark.read.parquet(path).select(identity.alias(ID), order.cast("binary").alias(ORDER), *place).where(F.col(ID).isNotNull())
        entries = scan.select(F.pmod(F.xxhash64(ID), F.lit(n)).cast("int").alias(BUCKET), ID, ORDER, "file", "row", F.lit(1).cast("long").alias(COPIES))

        def before(batches):
            for t in _pieces(batches):
                kept, lost = collapse(in_order(t))
                yield from kept.cast(ENTRY).to_batches()
                if lost.num_rows:
                    # lost places have no copies, and are dealt to all buckets
                    k = lost.num_rows
                    deal = pa.array(lost.column("row").to_numpy() % n, pa.int32())
                    none = pa.nulls(k, pa.binary())
                    yield from pa.table([deal, none, none, lost.column("file"), lost.column("row"), pa.array(np.zeros(k, np.int64))], schema=ENTRY).to_batches()

        def write(batches):
            out = _Writer(folder)
            for t in _pieces(batches):
                there = pc.greater(t.column(COPIES), 0)
                kept, lost = collapse(in_order(t.filter(there)))
                if kept.num_rows:
                    out.run(kept)
                out.lost(pa.concat_tables([lost, t.filter(pc.invert(there)).select(["file", "row"])]))
            if out.said:
                yield out.batch()

        dealt = entries.mapInArrow(before, ENTRY_DDL).repartition(n, BUCKET)
        dealt.mapInArrow(write, RUNS).write.mode("overwrite").parquet(f"{folder}/catalogue/batch={self._safe(name)}")
        self.batches[name] = path, key, identity
        self._merged = None

    @staticmethod
    def _safe(name: str) -> str:
        return hashlib.sha1(name.encode()).hexdigest()[:16]

    def merged(self) -> DataFrame:
        """The catalogue (RUNS) after compaction: of each bucket one run, in which an identity stands once.

        A bucket with one run needs no merge and keeps it.
        """
        if self._merged is not None:
            return self._merged
        catalogue = self.spark.read.schema(RUNS).option("recursiveFileLookup", "true").parquet(f"{self.folder}/catalogue")
        folder, fan_in = self.folder, FAN_IN

        def merge(table: pa.Table) -> pa.Table:
            bucket, out = table.column("of")[0].as_py(), _Writer(folder)
            rows = table.to_pylist()
            if len(rows) == 1 and rows[0]["bucket"] == rows[0]["last"]:
                return table.select(RUN_SCHEMA.names).cast(RUN_SCHEMA)
            runs = sorted((r["uri"], r["block"]) for r in rows)

            def read(uri, block):
                fs, path = resolve(uri)
                with fs.open_input_file(path) as f:
                    for b in pq.ParquetFile(f).iter_batches(16384, row_groups=None if block is None else [block]):
                        b = b.filter(pc.equal(b.column(BUCKET), bucket))
                        if b.num_rows:
                            yield pa.Table.from_batches([b])

            fs, base = resolve(f"{folder}/runs")

            def merged(some) -> tuple[str, int]:
                to, n, writer = f"{base}/merged-{uuid.uuid4().hex}.parquet", 0, None
                with fs.open_output_stream(to) as sink:
                    for kept, lost in merge_runs([read(*r) for r in some]):
                        writer = writer or pq.ParquetWriter(sink, kept.schema, compression="zstd", write_statistics=[BUCKET], store_schema=False)
                        writer.write_table(kept)
                        out.lost(lost)
                        n += kept.num_rows
                    writer.close()
                return f"{folder}/runs/{to.rpartition('/')[2]}", n

            made = []
            while len(runs) > fan_in:
                runs = [(merged(runs[i : i + fan_in])[0], None) for i in range(0, len(runs), fan_in)]
                made += runs
            uri, n = merged(runs)
            for u, _ in made:
                inner, path = resolve(u)
                inner.delete_file(path)
            out.said.append(("run", bucket, bucket, uri, -1, n))
            return pa.Table.from_batches([out.batch()])

        # a fixed number of partitions: AQE would put so small a catalogue, but not so small a work, into one task
        runs = catalogue.where("kind = 'run'").withColumn("of", F.explode(F.sequence("bucket", "last")))
        done = runs.repartition(2 * self.buckets, "of").groupBy("of").applyInArrow(merge, RUNS)
        self._merged = materialise(catalogue.where("kind = 'lost'").unionByName(done), "merged")
        return self._merged

    def index(self) -> DataFrame:
        """The merged index: _id, file and row of the message that is kept, _copies; an entry per identity."""
        runs = self.merged().where("kind = 'run'").select("bucket", "uri", "block")

        def read(batches):
            for b in batches:
                for bucket, uri, block in zip(*(b.column(c).to_pylist() for c in ("bucket", "uri", "block"))):
                    fs, path = resolve(uri)
                    with fs.open_input_file(path) as f:
                        for e in pq.ParquetFile(f).iter_batches(65536, row_groups=None if block < 0 else [block], columns=[BUCKET, ID, "file", "row", COPIES]):
                            yield e.filter(pc.equal(e.column(BUCKET), bucket)).select([ID, "file", "row", COPIES])

        return runs.repartition(2 * self.buckets, "bucket", "uri").mapInArrow(read, f"{ID} binary, file long, row long, {COPIES} long")

    def lost(self) -> DataFrame:
        """Places (file, row) of the messages that are not kept."""

        def read(batches):
            for b in batches:
                for uri in b.column(0).to_pylist():
                    fs, path = resolve(uri)
                    with fs.open_input_file(path) as f:
                        yield from pq.ParquetFile(f).iter_batches(65536)

        return self.merged().where("kind = 'lost'").select("uri").repartition(2 * self.buckets).mapInArrow(read, "file long, row long")

    def messages(self, columns: list[str] | None = None) -> DataFrame | None:
        """The kept messages, with _id and _copies: one row per identity, and all rows without one; of the given columns, or all. None if there is no batch.

        Files are read row group by row group, without the lost places; only places are moved.
        """
        index = self.index().where(F.col(COPIES) > 1).select("file", "row", COPIES)
        marks = materialise(self.lost().withColumn(COPIES, F.lit(0).cast("long")).unionByName(index), "marks")
        out = None
        for path, key, identity in self.batches.values():
            part = self._read(path, key, identity, marks, columns)
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    def _read(self, path: str, key: list[str], identity: F.Column, marks: DataFrame, columns: list[str] | None) -> DataFrame:
        df = self.spark.read.parquet(path)
        names = [c for c in df.columns if c not in (ORDER, COPIES) and (columns is None or c in columns or c in key)]
        schema = df.select(*names).schema.add(COPIES, "long")
        arrow = to_arrow_schema(schema)
        listed = self.spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", F.xxhash64("path").alias("file"))
        files = listed.where(~F.element_at(F.split("path", "/"), -1).rlike("^[._]"))
        units = 2 * max(self.spark.sparkContext.defaultParallelism, self.buckets)

        def footers(batches):
            for b in batches:
                rows = []
                for at, file in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    fs, local = resolve(at)
                    with fs.open_input_file(local) as f:
                        meta, first = pq.ParquetFile(f).metadata, 0
                    for no in range(meta.num_row_groups):
                        rows.append({"path": at, "file": file, "no": no, "first": first, "n": meta.row_group(no).num_rows})
                        first += rows[-1]["n"]
                yield pa.RecordBatch.from_pylist(rows, SPAN)

        spans = materialise(files.repartition(self.buckets).mapInArrow(footers, "path string, file long, no int, first long, n long"), "spans").where("n > 0")
        spread = spans.withColumn("part", F.explode(F.sequence(F.floor(F.col("first") / STRETCH), F.floor((F.col("first") + F.col("n") - 1) / STRETCH))))
        mine = marks.withColumn("part", F.floor(F.col("row") / STRETCH)).join(spread.select("file", "part", "no", "first", "n"), ["file", "part"])
        mine = mine.where("row >= first and row < first + n").select(F.col("file").alias("of_file"), F.col("no").alias("of_no"), "row", COPIES)

        def read(left: pa.Table, right: pa.Table) -> pa.Table:
            out = []
            for span in left.to_pylist():
                copies = np.ones(span["n"], np.int64)
                copies[right.column("row").to_numpy() - span["first"]] = right.column(COPIES).to_numpy()
                fs, local = resolve(span["path"])
                with fs.open_input_file(local) as f:
                    t = pq.ParquetFile(f).read_row_group(span["no"], columns=names)
                t = pa.table([*(t.column(c) for c in names), pa.array(copies)], names=[*names, COPIES]).filter(pa.array(copies > 0))
                out.append(t.cast(arrow))
            return pa.concat_tables(out) if out else arrow.empty_table()

        left, right = (t.repartition(units, *by).groupBy(*by) for t, by in ((spans, ["file", "no"]), (mine, ["of_file", "of_no"])))
        full = left.cogroup(right).applyInArrow(read, schema).withColumn(ID, identity)
        return full.select(*[c for c in names if c != ID and (columns is None or c in columns)], ID, COPIES)

    def compact(self) -> DataFrame | None:
        """Merge all runs; the kept messages (see messages()). None if there are no rows."""
        out = self.messages()
        return None if out is None or out.isEmpty() else out


def exactly_once(df: DataFrame, identity: F.Column, order: F.Column, n_bytes: int, name: str = "all") -> DataFrame | None:
    """One row per identity of a single batch, by upsert and compaction. None if there are no rows."""
    store = Store.for_bytes(df.sparkSession, n_bytes)
    store.upsert(df, name, identity, order)
    return store.compact()
