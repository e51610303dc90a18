"""Session settings and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}

#: Static settings for streams whose state Spark keeps: it lives in RocksDB, and should a caller use
#: Python state functions, their calls go over a unix socket, so that no port is opened for them.
STREAM_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.python.unix.domain.socket.enabled": "true",
}


def local_session(cores: int | str = "*", **extra: str) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("paneflow")
    settings = {
        **SETTINGS,
        **STREAM_SETTINGS,
        "spark.ui.enabled": "false",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": "8g",
        "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="paneflow-warehouse-"),
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``, or else the warehouse.

    A cluster that names no such folder and whose warehouse is on local disks is
    refused, since executors could not read what others wrote.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        root = spark.conf.get("spark.sql.warehouse.dir")
        on_one_machine = spark.conf.get("spark.master", "").split("[")[0] == "local"
        if not on_one_machine and root.startswith(("file:", "/")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


_open = threading.local()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{scratch_root(spark)}/paneflow/{label}-{uuid.uuid4().hex}"
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, by the session's own file systems (not through Spark Connect)."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def passing_scratch(spark: SparkSession) -> Iterator[None]:
    """What is written to fresh paths inside is removed at the end; results must be used by then."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        mine, _open.paths = _open.paths, outer
        for path in mine:
            remove(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as parquet in the shared folder and read it back.

    Cuts the lineage: a value that depends on how rows were laid out (a partition
    id, a position) is fixed once it is on disk, also when an executor is lost.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slot(folder: str, label: str, batch_id: int) -> str:
    """Where a micro-batch keeps what the next one goes on from.

    Two places take turns, so nothing piles up: a micro-batch reads the one of its predecessor and
    overwrites the other, also when it is run again.
    """
    return f"{folder.rstrip('/')}/{label}/turn={batch_id % 2}"


def write_slot(df: DataFrame, folder: str, label: str, batch_id: int) -> DataFrame:
    """Write what a micro-batch keeps, and read it back."""
    df.write.mode("overwrite").parquet(slot(folder, label, batch_id))
    return read_slot(df.sparkSession, folder, label, batch_id, df.schema)


def read_slot(spark: SparkSession, folder: str, label: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """What the micro-batch of that id kept; nothing before the first, 0."""
    if batch_id < 0:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(slot(folder, label, batch_id))
