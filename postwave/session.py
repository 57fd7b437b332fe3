"""Session defaults and the shared work folder."""

import re
import tempfile
import uuid
from functools import lru_cache

from pyspark.sql import SparkSession


def build_session(master=None, app="postwave", shuffle_partitions=None, driver_memory=None):
    """A session with the settings every job here relies on; the caller's cluster settings win."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans of a live batch are built anew; noting the Python line of each column takes a good part of that.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        # The default type has no statistics, so a time bound would skip no row group of a table written here.
        .config("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
        # Open buckets of a busy stream outgrow the heap of the default in-memory state store.
        .config(
            "spark.sql.streaming.stateStore.providerClass",
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
        )
    )
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    return builder.getOrCreate()


def shared_dir(spark, name):
    """A fresh folder for checkpoints and work tables, below ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster the executors would not see it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        base = local_dir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@lru_cache(maxsize=1)
def local_dir():
    return tempfile.mkdtemp(prefix="postwave-")


def write_table(df, path):
    """Write a table and read it back: its plan is cut, and lost executors cost nothing of it."""
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df, name):
    """``write_table`` to a fresh folder, for rows that several jobs read."""
    return write_table(df, shared_dir(df.sparkSession, name))


def discard(spark, path):
    """Delete a work table that nothing reads any more."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
