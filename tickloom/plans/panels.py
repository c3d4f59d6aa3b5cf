"""The dashboard's time series: one function per series, over a stored table and a time range."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.prices import imbalance_band
from tickloom.sources.tables import time_range

# Fixed value: the dashboard opens on the last quarter of an hour.
DEFAULT_RANGE = timedelta(minutes=15)


def last_range(now: datetime | None = None) -> tuple[datetime, datetime]:
    end = now or datetime.now(timezone.utc)
    return end - DEFAULT_RANGE, end


def _series(
    rows: DataFrame,
    time_col: str,
    columns: list[str],
    start,
    end,
    product_id: str | None = None,
    symbol: str | None = None,
) -> DataFrame:
    rows = time_range(rows, time_col, start, end)
    for name, wanted in (("product_id", product_id), ("symbol", symbol)):
        if wanted is not None:
            rows = rows.where(F.col(name) == wanted)
    return rows.select(F.col(time_col).alias("time"), *columns).orderBy("time")


def panel_close(bars_1s: DataFrame, start, end, product_id: str | None = None) -> DataFrame:
    """Close price of the 1 s bars."""
    return _series(bars_1s, "window_start", ["close"], start, end, product_id)


def panel_imbalance(imbalance: DataFrame, start, end, product_id: str | None = None) -> DataFrame:
    return _series(imbalance, "window_start", ["avg_imbalance"], start, end, product_id)


def panel_imbalance_bands(
    imbalance: DataFrame, start, end, product_id: str | None = None
) -> DataFrame:
    """The imbalance series with the colour of its threshold band."""
    series = panel_imbalance(imbalance, start, end, product_id)
    return series.withColumn("band", imbalance_band(F.col("avg_imbalance")))


def panel_spread(spread: DataFrame, start, end, symbol: str | None = None) -> DataFrame:
    return _series(spread, "ts", ["spread", "rolling_mean"], start, end, symbol=symbol)


def panel_zscore(spread: DataFrame, start, end, symbol: str | None = None) -> DataFrame:
    return _series(spread, "ts", ["z_score"], start, end, symbol=symbol)


def panel_peg(alerts: DataFrame, start, end) -> DataFrame:
    return _series(alerts, "ts", ["usdc_usd", "deviation"], start, end)
