"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def get_session(master: str | None = None, app: str = "cauce",
                shuffle_partitions: int | None = None, conf: dict | None = None) -> SparkSession:
    """A session with AQE on, UTC session time and the UI off. On a cluster
    pass ``master=None`` so the launcher's settings win."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for k, v in settings.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this must be set by the launcher to shared storage; we only
    create a private folder when the session is local (tests) and it is unset.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        spark.sparkContext.setCheckpointDir(d)
        return d
    master = spark.sparkContext.master or ""
    if not master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir is not set; point it at shared storage")
    d = tempfile.mkdtemp(prefix="cauce-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


def stage_path(spark: SparkSession, kind: str = "stage") -> str:
    """A new folder for intermediate data, under this session's own folder in
    the shared checkpoint folder (``release`` removes them all)."""
    return f"{_session_dir(spark)}/{kind}-{uuid.uuid4().hex}"


def _session_dir(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/cauce-{spark.sparkContext.applicationId}"


def materialize(df):
    """Cut lineage: write the frame as a Parquet table under the shared
    ``spark.checkpoint.dir`` and read it back. Frames reused by several jobs
    are then computed once, survive executor loss, and later reads get
    column pruning and filter pushdown. Never a local checkpoint."""
    spark = df.sparkSession
    path = stage_path(spark)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Make this package importable in Python workers that were started without
    it on their path: its code travels with the session, once."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    app = spark.sparkContext.applicationId
    on_path = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if app in _SHIPPED or root in on_path or not os.path.isdir(os.path.join(root, "cauce")):
        return
    folder = tempfile.mkdtemp(prefix="cauce-code-")  # read by the driver's file server until the session ends
    spark.sparkContext.addPyFile(shutil.make_archive(os.path.join(folder, "cauce"), "zip", root, "cauce"))
    _SHIPPED.add(app)


def release(spark: SparkSession) -> None:
    """Remove everything this session has staged. Frames that were built on it
    can't be read afterwards, so call it when their results are written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_dir(spark))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staging(spark: SparkSession):
    """``with staging(spark): ...`` releases the staged tables at the end."""
    try:
        yield spark
    finally:
        release(spark)
