"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Runtime settings the operators rely on; safe to put on an existing session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(name: str, shuffle_partitions: int | None = None, **conf: str) -> SparkSession:
    """Session with UTC, adaptive execution, RocksDB state and graceful stream stop.

    ``shuffle_partitions`` is left to the cluster unless given: adaptive execution coalesces
    small shuffles, so it only has to be large enough for the biggest one.
    """
    builder = SparkSession.builder.appName(name)
    settings = {
        **RUNTIME,
        "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
        "spark.sql.streaming.stopGracefullyOnShutdown": "true",
        "spark.scheduler.mode": "FAIR",
        **conf,
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on a session that somebody else built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which every executor can reach.

    Only a local master without that setting gets a temporary folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder shared by all executors")
        base = tempfile.mkdtemp(prefix="basketline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/basketline/{uuid.uuid4().hex}"


@contextmanager
def scratch_folder(spark: SparkSession) -> Iterator[str]:
    """A shared folder for the tables of one job, removed when the job is done."""
    folder = shared_folder(spark)
    try:
        yield folder
    finally:
        path, fs = hadoop_path(spark, folder)
        fs.delete(path, True)


def through_table(frame, folder: str):
    """Write a frame as Parquet and read it back: cuts lineage and survives lost executors."""
    frame.write.mode("overwrite").parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def hadoop_path(spark: SparkSession, path):
    """The Hadoop path of a text or Java URI, and its file system, for exists and rename."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath, jpath.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath, fs = hadoop_path(spark, path)
    return fs.exists(jpath)
