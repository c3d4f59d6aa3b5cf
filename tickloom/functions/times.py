"""Column expressions on event time. They accept TIMESTAMP and TIMESTAMP_NTZ alike."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F


def epoch_micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def epoch_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def epoch_seconds(ts: Column) -> Column:
    """Whole seconds, rounded down."""
    return F.unix_seconds(ts.cast("timestamp"))


def to_millis(ts: Column) -> Column:
    """TIMESTAMP cut to milliseconds, the precision of the stored tables."""
    return F.date_trunc("millisecond", ts)


def day_number(ts: Column) -> Column:
    """``20240105`` as INT, the day in UTC whatever the session's zone: the partition column."""
    micros, day_us = epoch_micros(ts), F.lit(86_400_000_000)
    days = F.call_function("div", micros - F.pmod(micros, day_us), day_us)
    day = F.date_from_unix_date(days.cast("int"))
    return F.year(day) * 10_000 + F.month(day) * 100 + F.dayofmonth(day)


def instant(bound: datetime | str) -> Column:
    """A literal TIMESTAMP; text and times without a zone are read as UTC."""
    at = datetime.fromisoformat(bound) if isinstance(bound, str) else bound
    at = at if at.tzinfo else at.replace(tzinfo=timezone.utc)
    micros = (at - datetime(1970, 1, 1, tzinfo=timezone.utc)) // timedelta(microseconds=1)
    return F.timestamp_micros(F.lit(micros))


def window_bounds() -> list[Column]:
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]
