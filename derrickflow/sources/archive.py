"""Raw archive paths, quarantine envelopes, and export and restore of file trees with checked hashes."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from derrickflow.sources.files import resolve

LISTED = "path string, size_bytes long, sha256 string"
CHUNK = 8 << 20


def archive_path(esp_id: Column, ts: Column, event_id: Column) -> Column:
    """Where an event's raw object lies: by pump and hour of event time, named by the event, so a repeat overwrites itself."""
    hour = F.date_format(F.timestamp_micros(ts), "yyyy/MM/dd/HH")
    return F.concat(F.lit("raw/realtime/"), esp_id, F.lit("/"), hour, F.lit("/"), event_id, F.lit(".json"))


def envelopes(rejected: DataFrame, raw: Column, received_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rejected rows as JSON envelopes that keep the raw bytes: rule_id, json (rule, reason, time of receipt, payload in base64), after the columns to keep."""
    whole = F.struct("rule_id", "reason", received_at.cast("string").alias("received_at"), F.base64(F.encode(raw, "UTF-8")).alias("raw_base64"))
    return rejected.select(*keep, "rule_id", F.to_json(whole, {"ignoreNullFields": "false"}).alias("json"))


def lookup(rows: DataFrame, key: str, wanted: list[str]) -> DataFrame:
    """The rows of the wanted keys, in the order of the list."""
    return rows.where(F.col(key).isin(wanted)).orderBy(F.array_position(F.array(*map(F.lit, wanted)), F.col(key)))


def safe(path: str) -> str:
    """A relative path that stays within its root; raises ValueError for any other."""
    if not path or path.startswith("/") or "\\" in path or ":" in path or ".." in path.split("/"):
        raise ValueError(f"unsafe path {path!r}")
    return path


def _hash(uri: str, to: str | None = None) -> tuple[int, str]:
    """Size and hash of a file, read in chunks; copied to `to` by the way, if given."""
    fs, path = resolve(uri)
    h, n, sink = hashlib.sha256(), 0, None
    if to:
        out, target = resolve(to)
        out.create_dir(target.rpartition("/")[0], recursive=True)
        sink = out.open_output_stream(target)
    with fs.open_input_stream(path) as f:
        while piece := f.read(CHUNK):
            h.update(piece)
            n += len(piece)
            if sink:
                sink.write(piece)
    if sink:
        sink.close()
    return n, h.hexdigest()


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Relative path, size and SHA-256 of all files under root, hashed in parallel. Names are listed by tasks too."""
    return _each(_names(spark, root), lambda path: _hash(f"{root}/{path}"))


def hashed(uris: DataFrame) -> DataFrame:
    """Size and SHA-256 of the files that a table's path column names: path, size_bytes, sha256; a file that isn't there has no row."""

    def work(uri):
        fs, path = resolve(uri)
        return _hash(uri) if fs.get_file_info(path).type == pafs.FileType.File else (None, None)

    return _each(uris.select("path"), work).where("sha256 is not null")


def _names(spark: SparkSession, root: str) -> DataFrame:
    """Relative paths of the files under root, as a table: it is never gathered on the driver. Hidden files are left out."""
    fs, base = resolve(root)
    if fs.get_file_info(base).type != pafs.FileType.Directory:
        return spark.createDataFrame([], "path string")
    top = [(f.path, f.type == pafs.FileType.Directory) for f in fs.get_file_info(pafs.FileSelector(base)) if not f.base_name.startswith((".", "_"))]

    def walk(batches):
        for b in batches:
            for path, folder in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                inner, _ = resolve(root)
                found = [path] if not folder else [f.path for f in inner.get_file_info(pafs.FileSelector(path, recursive=True)) if f.type == pafs.FileType.File and not f.base_name.startswith((".", "_"))]
                yield pa.record_batch([pa.array([safe(p[len(base) + 1 :]) for p in found], pa.string())], ["path"])

    return spark.createDataFrame(top, "path string, folder boolean").repartition(4 * spark.sparkContext.defaultParallelism).mapInArrow(walk, "path string")


def _each(paths: DataFrame, work) -> DataFrame:
    def run(batches):
        for b in batches:
            names_ = b.column(0).to_pylist()
            got = [work(n) for n in names_]
            yield pa.record_batch([pa.array(names_, pa.string()), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.string())], ["path", "size_bytes", "sha256"])

    return paths.repartition(4 * paths.sparkSession.sparkContext.defaultParallelism).mapInArrow(run, LISTED)


def write_items(table: DataFrame, to: str) -> None:
    """Table items as JSON-lines files, nulls kept, which an export takes along like any files."""
    table.write.mode("errorifexists").option("ignoreNullFields", "false").json(to)


def read_items(spark: SparkSession, path: str, schema) -> DataFrame:
    """The items that write_items wrote; a line that isn't one raises."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def export(spark: SparkSession, root: str, to: str) -> DataFrame:
    """Copy all files under root to a new folder; the manifest of what was copied is written beside them, in _manifest."""
    done = _each(_names(spark, root), lambda path: _hash(f"{root}/{path}", f"{to}/files/{path}"))
    done.write.mode("errorifexists").parquet(f"{to}/_manifest")
    return spark.read.parquet(f"{to}/_manifest")


def restore(spark: SparkSession, exported: str, to: str) -> DataFrame:
    """Bring back an export: everything is verified against its manifest before anything is written."""
    manifest = spark.read.schema(LISTED).parquet(f"{exported}/_manifest")
    bad = listing(spark, f"{exported}/files").join(manifest, ["path", "size_bytes", "sha256"], "left_anti").unionByName(manifest.join(listing(spark, f"{exported}/files"), ["path", "size_bytes", "sha256"], "left_anti"))
    if first := bad.select("path").head(1):
        raise ValueError(f"the export differs from its manifest, as in {first[0].path}")
    return _each(_names(spark, f"{exported}/files"), lambda path: _hash(f"{exported}/files/{path}", f"{to}/{path}"))
