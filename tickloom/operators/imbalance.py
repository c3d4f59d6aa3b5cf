"""Top-of-book imbalance over sliding windows."""

from __future__ import annotations

from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.prices import imbalance_ratio, quote_width
from tickloom.functions.times import window_bounds
from tickloom.settings import HOP_SIZE_S, HOP_SLIDE_S


def _measures() -> dict:
    bid_qty, ask_qty = F.col("best_bid_quantity"), F.col("best_ask_quantity")
    return {
        "avg_imbalance": imbalance_ratio(bid_qty, ask_qty),
        "avg_spread": quote_width(F.col("best_bid"), F.col("best_ask")),
        "avg_bid_qty": bid_qty,
        "avg_ask_qty": ask_qty,
    }


def hop_imbalance(
    ticks: DataFrame,
    *,
    size_s: int = HOP_SIZE_S,
    slide_s: int = HOP_SLIDE_S,
    time_col: str = "received_at",
) -> DataFrame:
    """Averages per product and sliding window, every tick copied into each window it falls in.

    The plain form, one aggregate. ``pane_imbalance`` is cheaper.
    """
    hop = F.window(time_col, f"{size_s} seconds", f"{slide_s} seconds")
    averages = [F.avg(expr).alias(name) for name, expr in _measures().items()]
    return (
        ticks.groupBy("product_id", hop)
        .agg(*averages, F.count("*").alias("tick_count"))
        .select(*window_bounds(), "product_id", *_measures(), "tick_count")
    )


def pane_imbalance(
    ticks: DataFrame,
    *,
    size_s: int = HOP_SIZE_S,
    slide_s: int = HOP_SLIDE_S,
    time_col: str = "received_at",
) -> DataFrame:
    """The same result from panes: sums and counts of non-overlapping pieces.

    A tick is aggregated once; only panes are copied into the windows they belong to. On a stream
    these are two stateful operators, the second of which sees closed panes.
    """
    pane = F.window(time_col, f"{gcd(size_s, slide_s)} seconds")
    partials = []
    for name, expr in _measures().items():
        partials += [F.sum(expr).alias(f"{name}_sum"), F.count(expr).alias(f"{name}_n")]
    panes = (
        ticks.groupBy("product_id", pane)
        .agg(*partials, F.count("*").alias("tick_count"))
        .withColumnRenamed("window", "pane")
    )
    # The end of a pane, less a microsecond, lies in a window exactly when the whole pane does:
    # panes divide both bounds. On a stream it also carries the watermark on.
    hop = F.window(F.window_time("pane"), f"{size_s} seconds", f"{slide_s} seconds")
    averages = [
        F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")).alias(name) for name in _measures()
    ]
    return (
        panes.groupBy("product_id", hop)
        .agg(*averages, F.sum("tick_count").alias("tick_count"))
        .select(*window_bounds(), "product_id", *_measures(), "tick_count")
    )
