"""Session set-up and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(app_name: str = "textpulse", master: str | None = None, **conf) -> SparkSession:
    """Sizing (shuffle partitions, memory, executors) belongs to the caller or spark-submit."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        # Streaming state on local disk instead of the heap, uploaded to the checkpoint.
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.adaptive.enabled": "true",
        **{key.replace("__", "."): value for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, str(value))
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> SparkSession:
    """Epoch seconds become wall-clock text in several places, always read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_own_root: list[str] = []


def scratch_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name under the shared checkpoint folder the cluster names.

    A single-process session without that setting gets one folder of its own, as in tests;
    a cluster has to name one, as executors do not see the driver's disk. The folder is
    removed when the session's JVM ends, if it has not been dropped before.
    """
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError(f"set {CHECKPOINT_CONF} to a folder that all executors share")
        if not _own_root:
            _own_root.append(tempfile.mkdtemp(prefix="textpulse-"))
            _drop_at_exit(spark, _own_root[0])
        root = _own_root[0]
    path = os.path.join(root, f"{purpose}-{uuid.uuid4().hex}")
    _drop_at_exit(spark, path)
    return path


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a scratch folder before the session ends."""
    files, hadoop_path = _files_of(spark, path)
    files.delete(hadoop_path, True)
    files.cancelDeleteOnExit(hadoop_path)


def _drop_at_exit(spark: SparkSession, path: str) -> None:
    files, hadoop_path = _files_of(spark, path)
    files.deleteOnExit(hadoop_path)


def _files_of(spark: SparkSession, path: str) -> tuple:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path
