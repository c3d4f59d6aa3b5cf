"""Keeps stored tables up to date from their JSON topics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tickloom.schemas import struct
from tickloom.session import delete
from tickloom.sinks.tables import StoredTable, write_table
from tickloom.sources.feeds import accepted, dead_letters
from tickloom.sources.landing import read_landing
from tickloom.streaming.folders import batch_ids, days_in, drop_older, read_batches, written

MANIFEST = struct("day int, merged bigint")


def store_stream(topic: DataFrame, table: StoredTable, path: str) -> DataStreamWriter:
    """Writer that projects each micro-batch of messages into the table.

    Rows go to ``rows/batch_id=<id>/day=<day>/`` and unreadable messages to
    ``broken/batch_id=<id>/``. Both are overwritten by batch id, so a repeated batch leaves no
    duplicates. Start it with a checkpoint location and a trigger.
    """

    def store(batch: DataFrame, batch_id: int) -> None:
        landing = read_landing(batch, table.landing).persist()
        try:
            rows = table.project(accepted(landing))
            write_table(rows, table, f"{path}/rows/batch_id={batch_id}")
            broken = dead_letters(landing)
            broken.write.mode("overwrite").parquet(f"{path}/broken/batch_id={batch_id}")
        finally:
            landing.unpersist()

    return topic.writeStream.foreachBatch(store)


def stored(spark: SparkSession, table: StoredTable, path: str) -> DataFrame:
    """The rows of a table kept by ``store_stream``, with their ``day``."""
    schema = table.schema(spark)
    last, days = _manifest(spark, path)
    fresh = [i for i in batch_ids(spark, f"{path}/rows") if i > last]
    parts = [read_batches(spark, f"{path}/rows", schema, fresh)]
    if days:
        parts.append(_read_days(spark, path, schema, days))
    return reduce(DataFrame.unionByName, parts)


def compact(spark: SparkSession, table: StoredTable, path: str, keep: int = 2) -> None:
    """Merges the folders of all but the newest ``keep`` micro-batches into the table's days.

    Only days that these micro-batches have rows of are rewritten, each as
    ``merged/batch_id=<last batch>/day=<day>``; a manifest names the current folder of every day, so
    the cost follows the new rows, not the history. Readers take the new manifest, and with it the
    new folders in place of the micro-batches, from the moment it is complete.

    Safe beside a running ``store_stream``: a batch may be repeated only while it is the newest.
    Folders of days that a manifest has replaced stay until the next one, for those who still read.
    """
    last, days = _manifest(spark, path)
    ids = batch_ids(spark, f"{path}/rows")
    ready = [i for i in ids[: len(ids) - keep] if i > last]
    if not ready:
        return
    schema = table.schema(spark)
    touched = sorted({day for i in ready for day in days_in(spark, f"{path}/rows/batch_id={i}")})
    rows = read_batches(spark, f"{path}/rows", schema, ready)
    known = {day: days[day] for day in touched if day in days}
    if known:
        rows = rows.unionByName(_read_days(spark, path, schema, known))
    write_table(rows.drop("day"), table, f"{path}/merged/batch_id={ready[-1]}", ranged=True)
    current = days | dict.fromkeys(touched, ready[-1])
    named = spark.createDataFrame(sorted(current.items()), MANIFEST)
    named.coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/batch_id={ready[-1]}")
    for i in ready:
        delete(spark, f"{path}/rows/batch_id={i}")
    for day, folder in _replaced(spark, path, {*days.items(), *current.items()}):
        delete(spark, f"{path}/merged/batch_id={folder}/day={day}")
    drop_older(spark, f"{path}/manifest", ready[-1], keep=1)


def _manifest(spark: SparkSession, path: str) -> tuple[int, dict[int, int]]:
    """The last micro-batch that was merged (-1 before any), and of every day the merge it is in."""
    newest = batch_ids(spark, f"{path}/manifest")[-1:]
    if not newest:
        return -1, {}
    rows = spark.read.schema(MANIFEST).parquet(f"{path}/manifest/batch_id={newest[0]}")
    return newest[0], {row["day"]: row["merged"] for row in rows.collect()}  # a row per day


def _read_days(
    spark: SparkSession, path: str, schema: T.StructType, days: dict[int, int]
) -> DataFrame:
    folders = [f"{path}/merged/batch_id={i}/day={day}" for day, i in sorted(days.items())]
    reader = spark.read.option("basePath", f"{path}/merged").schema(schema)
    return reader.parquet(*folders).select(*schema.names)


def _replaced(
    spark: SparkSession, path: str, named: set[tuple[int, int]]
) -> list[tuple[int, int]]:
    """The (day, merge) folders that none of the manifests in use names."""
    there = [
        (day, i)
        for i in batch_ids(spark, f"{path}/merged")
        for day in days_in(spark, f"{path}/merged/batch_id={i}")
    ]
    return [own for own in there if own not in named]


def broken(spark: SparkSession, path: str) -> DataFrame:
    """Messages that could not be read."""
    return written(spark, f"{path}/broken", struct("value string"))
