"""Folders named by micro-batch id, on whatever file system the path belongs to."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import epoch_micros

from tickloom.session import delete, file_system

_PREFIX = "batch_id="


def batch_ids(spark: SparkSession, path: str) -> list[int]:
    """Ids of the batch folders directly below ``path`` that were written completely."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    ids = [int(n[len(_PREFIX):]) for n in names if n.startswith(_PREFIX)]
    return sorted(
        i for i in ids if fs.exists(file_system(spark, f"{path}/{_PREFIX}{i}/_SUCCESS")[1])
    )


def days_in(spark: SparkSession, path: str) -> list[int]:
    """The days of a folder's ``day=<day>/`` folders."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removeprefix("day=")) for n in names if n.startswith("day="))


def newest_before(spark: SparkSession, path: str, batch_id: int) -> int | None:
    earlier = [i for i in batch_ids(spark, path) if i < batch_id]
    return earlier[-1] if earlier else None


def drop_older(spark: SparkSession, path: str, batch_id: int, keep: int) -> None:
    """Delete the batch folders before ``batch_id`` except the newest ``keep``."""
    earlier = [i for i in batch_ids(spark, path) if i < batch_id]
    for old in earlier[:-keep]:
        delete(spark, f"{path}/{_PREFIX}{old}")


def written(
    spark: SparkSession, path: str, schema: T.StructType, *, known: bool = True
) -> DataFrame:
    """The completely written batch folders below ``path`` as one table, empty if there is none.

    With ``known`` false the folders' own schema may have more columns than ``schema``.
    """
    return read_batches(spark, path, schema, batch_ids(spark, path), known=known)


def read_batches(
    spark: SparkSession, path: str, schema: T.StructType, ids: list[int], *, known: bool = True
) -> DataFrame:
    """The folders of the batches ``ids`` as one table."""
    if not ids:
        return spark.createDataFrame([], schema)
    reader = spark.read.option("basePath", path)
    if known:
        reader = reader.schema(schema)
    return reader.parquet(*[f"{path}/{_PREFIX}{i}" for i in ids]).drop("batch_id")


# Notes: a few numbers that a micro-batch leaves to the next one


def write_note(spark: SparkSession, path: str, batch_id: int, note: dict) -> None:
    """Leaves a small dictionary; the batch's own note is overwritten if it is repeated."""
    fs, file = file_system(spark, f"{path}/{_PREFIX}{batch_id}.json")
    out = fs.create(file, True)
    out.write(bytearray(json.dumps(note).encode()))
    out.close()


def read_note(spark: SparkSession, path: str, batch_id: int) -> dict:
    """The note of the last batch before ``batch_id``, empty before any. Older ones are deleted."""
    fs, folder = file_system(spark, path)
    if not fs.exists(folder):
        return {}
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    ids = sorted(
        int(n[len(_PREFIX) : -len(".json")])
        for n in names
        if n.startswith(_PREFIX) and n.endswith(".json")
    )
    earlier = [i for i in ids if i < batch_id]
    for old in earlier[:-2]:
        delete(spark, f"{path}/{_PREFIX}{old}.json")
    if not earlier:
        return {}
    stream = fs.open(file_system(spark, f"{path}/{_PREFIX}{earlier[-1]}.json")[1])
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


# Rows by time: a batch only adds pieces of time, and whole pieces are dropped when they have passed


def add_pieces(rows: DataFrame, path: str, batch_id: int, piece_s: int, time_col: str) -> None:
    """Adds the rows of a batch as ``batch_id=<id>/piece=<number>/``, overwritten if repeated."""
    piece = F.floor(epoch_micros(F.col(time_col)) / (piece_s * 1_000_000))
    (
        rows.withColumn("piece", piece)
        .hint("rebalance", F.col("piece"))
        .write.partitionBy("piece")
        .mode("overwrite")
        .parquet(f"{path}/{_PREFIX}{batch_id}")
    )


def read_pieces(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    before: int,
    bounds: tuple[int, int],
    piece_s: int,
    time_col: str,
) -> DataFrame:
    """Rows of batches before ``before`` with bounds[0] < time <= bounds[1], in microseconds.

    Only the pieces that overlap the bounds are read.
    """
    unit = piece_s * 1_000_000
    low, high = bounds[0] // unit, bounds[1] // unit
    folders = [
        f"{path}/{_PREFIX}{i}/piece={number}"
        for i in batch_ids(spark, path)
        if i < before
        for number in _pieces(spark, f"{path}/{_PREFIX}{i}")
        if low <= number <= high
    ]
    if not folders:
        return spark.createDataFrame([], schema)
    rows = spark.read.option("basePath", path).schema(schema).parquet(*folders)
    return rows.select(*schema.names).where(within(time_col, bounds))


def within(time_col: str, bounds: tuple[int, int]) -> Column:
    at = epoch_micros(F.col(time_col))
    return (at > bounds[0]) & (at <= bounds[1])


def drop_pieces(spark: SparkSession, path: str, before: int, passed: int, piece_s: int) -> None:
    """Deletes pieces that end at ``passed`` (microseconds) or earlier, and emptied batches.

    Call it before a batch with what the batches before it no longer need: then the batch finds the
    same pieces again if it is repeated.
    """
    unit = piece_s * 1_000_000
    for i in batch_ids(spark, path):
        if i >= before:
            continue
        folder = f"{path}/{_PREFIX}{i}"
        there = _pieces(spark, folder)
        gone = [number for number in there if (number + 1) * unit <= passed]
        if len(gone) == len(there):
            delete(spark, folder)
            continue
        for number in gone:
            delete(spark, f"{folder}/piece={number}")


def _pieces(spark: SparkSession, path: str) -> list[int]:
    fs, folder = file_system(spark, path)
    names = [status.getPath().getName() for status in fs.listStatus(folder)]
    return sorted(int(n.removeprefix("piece=")) for n in names if n.startswith("piece="))
