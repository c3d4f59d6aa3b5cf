"""Stored tables read for a time range."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import day_number, instant
from tickloom.sinks.tables import StoredTable


def read_table(spark: SparkSession, table: StoredTable, path: str) -> DataFrame:
    """The table with its ``day`` column. The schema is known, so no file is opened for it."""
    return spark.read.schema(table.schema(spark)).parquet(path)


def time_range(
    rows: DataFrame, time_col: str, start: datetime | str, end: datetime | str
) -> DataFrame:
    """Rows with ``start <= time <= end``; bounds without a zone are UTC.

    Spark prunes day folders only by a predicate on ``day`` itself, so that one is added.
    """
    first, last = instant(start), instant(end)
    return rows.where(F.col("day").between(day_number(first), day_number(last))).where(
        F.col(time_col).between(first, last)
    )
