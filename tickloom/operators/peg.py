"""Stablecoin peg drift: a stateless filter over oracle prices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.prices import fixed_point, peg_deviation, peg_severity
from tickloom.settings import PEG_THRESHOLD


def peg_alerts(oracle: DataFrame, threshold: float = PEG_THRESHOLD) -> DataFrame:
    """One alert per price further than ``threshold`` from 1.0. No shuffle; batch or stream."""
    return (
        oracle.withColumn("usdc_usd", fixed_point(F.col("price_raw"), F.col("expo")))
        .withColumn("deviation", peg_deviation(F.col("usdc_usd")))
        .where(F.col("deviation") > threshold)
        .select(
            "publish_time",
            "feed_id",
            "usdc_usd",
            "deviation",
            peg_severity(F.col("deviation")).alias("severity"),
        )
    )


def severity_counts(alerts: DataFrame) -> DataFrame:
    return alerts.groupBy("severity").agg(F.count("*").alias("alerts"))
