"""Stored tables: landing rows projected to storage columns, partitioned by day, sorted by key."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom import schemas
from tickloom.functions.times import day_number, to_millis


@dataclass(frozen=True)
class StoredTable:
    """A stored table: landing schema, projection to storage columns, time column, sort order."""

    name: str
    landing: T.StructType
    project: Callable[[DataFrame], DataFrame]
    time_col: str
    sort: tuple[str, ...]

    def schema(self, spark: SparkSession) -> T.StructType:
        """Storage columns and ``day``."""
        rows = self.project(spark.createDataFrame([], self.landing))
        return rows.withColumn("day", F.lit(0)).schema


def _windowed(landing: DataFrame) -> DataFrame:
    kept = [name for name in landing.columns if name not in ("window_start", "window_end")]
    return landing.select(to_millis(F.col("window_start")).alias("window_start"), *kept)


def _spread(landing: DataFrame) -> DataFrame:
    """A record that names no symbol has an empty one."""
    kept = [name for name in schemas.SPREAD.names if name != "ts_ms"]
    symbol = F.col("symbol") if "symbol" in landing.columns else F.lit("")
    return landing.select(F.timestamp_millis("ts_ms").alias("ts"), *kept, symbol.alias("symbol"))


def _peg(landing: DataFrame) -> DataFrame:
    kept = [name for name in schemas.PEG_ALERT.names if name != "publish_time"]
    return landing.select(F.timestamp_seconds("publish_time").alias("ts"), *kept)


_BY_PRODUCT = ("product_id", "window_start")

TABLES = {
    table.name: table
    for table in [
        StoredTable("ohlcv_1s", schemas.BAR, _windowed, "window_start", _BY_PRODUCT),
        StoredTable("ohlcv_10s", schemas.BAR, _windowed, "window_start", _BY_PRODUCT),
        StoredTable("ohlcv_1m", schemas.BAR, _windowed, "window_start", _BY_PRODUCT),
        StoredTable(
            "cross_source_spread", schemas.SPREAD_BY_SYMBOL, _spread, "ts", ("symbol", "ts")
        ),
        StoredTable("imbalance", schemas.IMBALANCE, _windowed, "window_start", _BY_PRODUCT),
        StoredTable("usdc_peg_alerts", schemas.PEG_ALERT, _peg, "ts", ("ts",)),
    ]
}


def write_table(rows: DataFrame, table: StoredTable, path: str, *, ranged: bool = False) -> None:
    """Write stored rows into ``day=YYYYMMDD/`` folders, each file sorted by the table's order.

    The rebalance hint sends a day's rows together and lets adaptive execution cut a heavy day into
    files of the advisory size, whatever its rows look like, copies included. Inside a file the
    sort makes row-group statistics selective. No sampling pass over the rows' own plan is needed.

    A file of a heavy day then covers all keys and times of that day. With ``ranged`` the day is cut
    at bounds of (key, time) instead, so that its files cover disjoint ranges and a narrow query
    opens few of them. The bounds are sampled, which reads ``rows`` twice: for rows that are stored.
    """
    dated = rows.withColumn("day", day_number(F.col(table.time_col)))
    placed = (
        dated.repartitionByRange("day", *table.sort)
        if ranged
        else dated.hint("rebalance", F.col("day"))
    )
    (
        placed.sortWithinPartitions("day", *table.sort)
        .write.partitionBy("day")
        .mode("overwrite")
        .parquet(path)
    )
