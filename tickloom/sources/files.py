"""Files as sources: tables for batch jobs and file streams that stand in for topics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def stream_parquet(
    spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None
) -> DataFrame:
    """A stream of Parquet files. ``path`` is a directory, or a glob when it names a file."""
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_text(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A stream of captured messages, one per line, in column ``value``."""
    reader = spark.readStream
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def stream_topic_text(spark: SparkSession, root: str, topic: str) -> DataFrame:
    """The messages of one topic below ``root``, which holds ``topic=<name>/`` folders.

    The root is read, not the topic's folder: there a stream's commit log says which files count.
    """
    rows = spark.readStream.schema("value string, topic string").text(root)
    return rows.where(F.col("topic") == topic).select("value")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)
