"""Session defaults and the shared folder for checkpoints and scratch tables."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Adaptive execution sizes reducers at run time and splits skewed join partitions,
# so the shuffle width below is only the upper bound it starts from.
ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: int | str = 8, app_name: str = "tidemart", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the local bench."""
    defaults = {
        **ADAPTIVE,
        "spark.sql.shuffle.partitions": str(cores),
        # Recording a Python call site per column expression costs more than planning it.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        "spark.sql.dataFrameQueryContext.enabled": "false",
    }
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in {**defaults, **conf}.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def checkpoint_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    ``spark.checkpoint.dir`` names a folder every executor can reach. A local session without
    that setting uses a folder in its warehouse.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if configured is None:
        if not re.fullmatch(r"local(\[[^\[\]]*\])?", context.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        configured = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def scratch_schema(spark: SparkSession, schema: str) -> str:
    """A schema of the catalog whose tables lie below the checkpoint folder."""
    place = f"{checkpoint_root(spark).rstrip('/')}/{schema}".replace("'", "\\'")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {schema} LOCATION '{place}'")
    return schema


def scratch_name(spark: SparkSession, label: str) -> str:
    """A fresh table name in a schema below the checkpoint folder."""
    return f"{scratch_schema(spark, 'tidemart_scratch')}.{label}_{uuid.uuid4().hex}"


@contextmanager
def planned_by_rows(spark: SparkSession) -> Iterator[None]:
    """Until the block ends, plans go by the rows that the catalog counted of a table, not by the size of its files.

    Files are packed and a plan reads few of their columns: by their size Spark takes a table for small that fills
    the driver's memory when it is broadcast. Tables that were not analyzed are judged by their files as before.
    """
    setting = "spark.sql.cbo.planStats.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


class Folder:
    """A folder on whatever file system its path names: listings and removal."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._jvm = spark._jvm
        self._root = self._path(path)
        self._files = self._root.getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, *parts):
        return self._jvm.org.apache.hadoop.fs.Path(*parts)

    def _entries(self) -> list:
        return list(self._files.listStatus(self._root)) if self._files.exists(self._root) else []

    def written_folders(self) -> list[str]:
        """Names of the folders below whose write has ended, in order."""
        folders = (e.getPath() for e in self._entries() if e.isDirectory())
        return sorted(p.getName() for p in folders if self._files.exists(self._path(p, "_SUCCESS")))

    def remove(self, name: str = "") -> None:
        """Delete an entry, or the folder itself."""
        self._files.delete(self._path(self._root, name) if name else self._root, True)


@contextmanager
def scratch_table(frame: DataFrame, label: str) -> Iterator[DataFrame]:
    """``frame`` written once to the scratch folder, to be read until the block ends."""
    path = scratch_path(frame.sparkSession, label)
    frame.write.parquet(path)
    try:
        yield frame.sparkSession.read.schema(frame.schema).parquet(path)
    finally:
        Folder(frame.sparkSession, path).remove()
