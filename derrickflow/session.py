"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

from derrickflow.sources.files import remove

_own: dict[str, str] = {}
_kept: set[str] = set()


def build(master: str = "local[*]", name: str = "derrickflow", **conf: str) -> SparkSession:
    """A session with the settings every query here relies on (UTC, AQE)."""
    b = (
        SparkSession.builder.master(master)
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """URI of the folder that all executors share.

    It is spark.checkpoint.dir where the session has one. Only a local master may go without:
    it then gets a temporary folder of its own, removed at exit.
    """
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return (root if "://" in root else "file://" + os.path.abspath(root)).rstrip("/")
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _own:
        made = tempfile.mkdtemp(prefix="derrickflow-")
        _own[sc.applicationId] = "file://" + made
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        sc.setCheckpointDir(_own[sc.applicationId])
    return _own[sc.applicationId]


def scratch(spark: SparkSession, what: str) -> str:
    """URI of a new, unused folder for a written table in the shared folder.

    It lies below the application's own folder, which is removed when the driver's Python ends:
    what is to stay is written elsewhere.
    """
    app = f"{shared_dir(spark)}/derrickflow/{spark.sparkContext.applicationId}"
    if app not in _kept:
        _kept.add(app)
        atexit.register(_forget, app)
    return f"{app}/{what}-{uuid.uuid4().hex[:12]}"


def _forget(folder: str) -> None:
    try:
        remove(folder)
    except OSError:
        pass


def split_bytes(spark: SparkSession) -> int:
    """The session's scan split size; the unit of work of operators that read files themselves."""
    size = spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    return int(size(spark.conf.get("spark.sql.files.maxPartitionBytes", "128m").rstrip("Bb")))


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files at a path, by way of the file system's own summary."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return int(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getContentSummary(at).getLength())


def materialise(df, what: str):
    """df, written to the shared folder once and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    to = scratch(spark, what)
    df.write.parquet(to)
    return spark.read.schema(df.schema).parquet(to)
