"""Column expressions on feed text: number parsing, sides, topic names, timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how timestamps are written in JSON results.
JSON_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
JSON_OPTIONS = {"timestampFormat": JSON_TIME_FORMAT, "timestampNTZFormat": JSON_TIME_FORMAT}
# Readers accept any number of decimals up to six, or none.
JSON_READ_OPTIONS = {name: "yyyy-MM-dd HH:mm:ss[.SSSSSS]" for name in JSON_OPTIONS}


def number(text: Column) -> Column:
    """Text to DOUBLE, NULL when it is no number.

    Spark also reads a type suffix (``1d``, ``2.5F``); the feeds never mean that by it.
    """
    return F.when(~text.rlike(r"[0-9.][dDfF]\s*$"), text.try_cast("double"))


def integer(text: Column) -> Column:
    """Text to BIGINT, NULL when it is no whole number."""
    return text.try_cast("bigint")


def trade_side(side: Column) -> Column:
    return F.when(side.isin("BUY", "SELL"), side).otherwise(F.lit("UNKNOWN"))


def product_slug(product_id: Column) -> Column:
    """``SOL-USDT`` to ``sol_usdt``."""
    return F.replace(F.lower(product_id), F.lit("-"), F.lit("_"))


def trades_topic(product_id: Column) -> Column:
    return F.concat(F.lit("coinbase."), product_slug(product_id), F.lit(".trades"))


def ticker_topic(product_id: Column) -> Column:
    return F.concat(F.lit("coinbase."), product_slug(product_id), F.lit(".ticker"))


def iso_time(text: Column) -> Column:
    """ISO-8601 text to TIMESTAMP, NULL when it does not parse."""
    return text.try_cast("timestamp")
