"""Session helpers: a tuned builder for tests/bench and a shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package relies on.  Session zone UTC keeps
# TIMESTAMP (LTZ) columns written by the landing sink unambiguous; the
# operators themselves never depend on it (see functions.columns.utc_wall_clock).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "latewatch", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session with the package defaults.

    On a cluster the master comes from ``spark-submit``; ``master`` is only
    used for local runs and tests.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folders of local sessions without ``spark.checkpoint.dir``, by application.
_local: dict[str, str] = {}


def _own_folder(application: str) -> str:
    if application not in _local:
        _local[application] = tempfile.mkdtemp(prefix="latewatch-")
    return _local[application]


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names a shared (HDFS/S3/ABFS) folder there.  Only under a local
    master may it be unset: ``fallback`` or a new temporary folder serves then, the
    same for the whole application (the setting itself is fixed once Spark runs).
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = fallback or _own_folder(spark.sparkContext.applicationId)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str, fallback: str | None = None) -> str:
    """A fresh sub-folder of the shared checkpoint folder for one run of one job."""
    return f"{checkpoint_root(spark, fallback)}/{name}-{uuid.uuid4().hex}"
