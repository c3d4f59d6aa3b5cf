"""Raw feed messages to typed records and dead letters, from one read of the messages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tickloom.schemas import struct
from tickloom.session import delete, file_system
from tickloom.sources.feeds import MESSAGE, accepted, letters
from tickloom.streaming.folders import drop_older, written

LETTERS = T.StructType([
    T.StructField("value", T.StringType()),
    T.StructField("records", T.ArrayType(struct("index string, reason string"))),
])


def ingest_stream(
    raw: DataFrame,
    read: Callable[[DataFrame], DataFrame],
    path: str,
    publish: Callable[[DataFrame, int], None],
) -> DataStreamWriter:
    """Writer that reads each micro-batch of messages once and hands on records and letters.

    The parsed records of a micro-batch are staged below ``path``; from there ``publish`` gets the
    accepted ones with the batch's id, and one letter for each message with unreadable records goes
    to ``dead_letters/batch_id=<id>/``. Letters are overwritten by batch id, so a repeated batch
    leaves none twice. Start it with a checkpoint location and a trigger.
    """

    def ingest(batch: DataFrame, batch_id: int) -> None:
        spark, staged = batch.sparkSession, f"{path}/staged/batch_id={batch_id}"
        records = read(batch.withColumn(MESSAGE, F.monotonically_increasing_id()))
        records.write.mode("overwrite").parquet(staged)
        records = spark.read.schema(records.schema).parquet(staged)
        publish(accepted(records), batch_id)
        unread = letters(records)
        unread.write.mode("overwrite").parquet(f"{path}/dead_letters/batch_id={batch_id}")
        drop_older(spark, f"{path}/staged", batch_id, keep=1)

    return raw.writeStream.foreachBatch(ingest)


def dead_letters_of(spark: SparkSession, path: str) -> DataFrame:
    """The letters of an ``ingest_stream``: a message's text, its unreadable records and why."""
    return written(spark, f"{path}/dead_letters", LETTERS)


def add_once(rows: DataFrame, path: str, batch_id: int) -> None:
    """Adds a folder of rows that file streams may read, once however often the batch is repeated.

    The folder is written aside and renamed when it is complete, so that no reader sees a part of
    it; a batch whose folder is there already is left as it is.
    """
    spark = rows.sparkSession
    folder, aside = f"{path}/batch_id={batch_id}", f"{path}/_aside-{batch_id}"
    fs, target = file_system(spark, folder)
    if fs.exists(target):
        return
    rows.write.mode("overwrite").parquet(aside)
    if not fs.rename(file_system(spark, aside)[1], target):
        delete(spark, aside)
        raise OSError(f"{aside} cannot be renamed to {folder}")


def read_added(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all folders that ``add_once`` has added."""
    return spark.read.schema(schema).parquet(path).select(*schema.names)
