"""Session defaults, the shared working folder and staged tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "tickloom", **conf: str) -> SparkSession:
    """A session with the settings the jobs rely on; the cluster's own settings stay in force."""
    builder = SparkSession.builder.appName(app_name)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_root: str | None = None


def work_dir(spark: SparkSession, name: str) -> str:
    """A new, unused path in the folder that all executors share (``spark.checkpoint.dir``).

    Only a ``local`` session may fall back to a temporary folder: on a cluster other machines
    could not read it, so the missing setting is an error there.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors can reach")
        global _local_root
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="tickloom-")
        root = _local_root
    return os.path.join(root, f"{name}-{uuid.uuid4().hex}")


_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staging_scopes", default=())


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the tables that were staged inside it.

        with staging(spark):
            spread_signal(ticks, oracle).write.parquet(result)

    Results that read staged tables must be written inside. Without it the tables stay.
    """
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            delete(spark, path)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of the written table.

    It cuts the lineage, so a lost executor re-reads files instead of recomputing the plan above,
    and gives Catalyst the table's real size to choose joins by. The write runs at once.
    """
    path = work_dir(df.sparkSession, name)
    for scope in _scopes.get()[-1:]:
        scope.append(path)
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system a path belongs to, and the path as its Path."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)
