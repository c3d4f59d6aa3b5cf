"""Streaming forms of the windowed and stateless analytics. All are declarative."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.operators.bars import bars_by_size
from tickloom.operators.imbalance import pane_imbalance
from tickloom.operators.peg import peg_alerts
from tickloom.settings import (
    BAR_SIZES,
    BARS_TOPIC,
    HOP_SIZE_S,
    HOP_SLIDE_S,
    IMBALANCE_TOPIC,
    PEG_THRESHOLD,
    PEG_TOPIC,
)
from tickloom.sinks.topics import json_messages


def unique_trades(trades: DataFrame, *, time_col: str = "time", lateness: str) -> DataFrame:
    """Drops redelivered trades that arrive within ``lateness`` of each other. Optional."""
    watermarked = trades.withWatermark(time_col, lateness)
    return watermarked.dropDuplicatesWithinWatermark(["product_id", "trade_id"])


def stream_bars(
    trades: DataFrame,
    sizes: Mapping[str, int] = BAR_SIZES,
    *,
    lateness: str = "10 seconds",
    time_col: str = "time",
    **options,
) -> DataFrame:
    """Closed bars of all sizes, labelled in ``bar``; one query that reads its source once.

    A bar appears once the watermark passes its end, so short bars do not wait for long ones. The
    sizes must be multiples of the smallest.
    """
    trades = trades.withWatermark(time_col, lateness)
    return bars_by_size(trades, sizes, time_col=time_col, **options)


def stream_imbalance(
    ticks: DataFrame,
    *,
    lateness: str = "10 seconds",
    time_col: str = "received_at",
    size_s: int = HOP_SIZE_S,
    slide_s: int = HOP_SLIDE_S,
) -> DataFrame:
    ticks = ticks.withWatermark(time_col, lateness)
    return pane_imbalance(ticks, size_s=size_s, slide_s=slide_s, time_col=time_col)


def bar_messages(labelled: DataFrame) -> DataFrame:
    """Bars of all sizes as JSON messages, each size to its own topic."""
    prefix, suffix = BARS_TOPIC.split("{label}")
    topic = F.concat(F.lit(prefix), F.col("bar"), F.lit(suffix))
    return json_messages(labelled, topic, key="product_id", exclude=("bar",))


def imbalance_messages(imbalance: DataFrame) -> DataFrame:
    return json_messages(imbalance, IMBALANCE_TOPIC, key="product_id")


def peg_messages(oracle: DataFrame, threshold: float = PEG_THRESHOLD) -> DataFrame:
    return json_messages(peg_alerts(oracle, threshold), PEG_TOPIC, key="feed_id")


def rows_dropped_late(query: StreamingQuery) -> int:
    """Rows that came behind the watermark, over the progress reports the query still holds."""
    return sum(
        operator.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for operator in progress.stateOperators
    )
