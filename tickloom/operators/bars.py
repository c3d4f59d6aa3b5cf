"""OHLCV bars over tumbling windows."""

from __future__ import annotations

from collections.abc import Collection, Mapping
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.times import epoch_micros, window_bounds
from tickloom.settings import BAR_SIZES


def bars(
    trades: DataFrame,
    size_s: int,
    *,
    time_col: str = "time",
    id_col: str = "trade_id",
    id_bits: int | None = None,
) -> DataFrame:
    """Open, high, low, close, volume and count per product and window.

    Open and close follow event time, ties by trade id, so the result does not depend on the order
    in which shuffled rows arrive. One shuffle on (product, window), after a partial aggregate.

    Time and id are packed into one number, so that Spark aggregates by hash; a pair would make it
    sort the rows first. Ids of any kind take a DECIMAL. When the ids are known to be whole numbers
    of at most ``id_bits`` bits, a BIGINT holds both, which is faster; an id that breaks the promise
    fails the job. Works on batch and streaming input alike. Windows too long to pack their times
    beside the ids are built from one-second bars, which batch input alone allows.
    """
    packable = id_bits is not None and _fits(1, id_bits)
    if packable and not _fits(size_s, id_bits) and not trades.isStreaming:
        sizes = {"fine": 1, "asked": size_s}
        options = {"time_col": time_col, "id_col": id_col, "id_bits": id_bits}
        return bars_by_size(trades, sizes, only=("asked",), **options).drop("bar")
    if id_bits is None:
        order = _wide_order(trades, size_s, time_col, id_col)
    else:
        order = _packed_order(size_s, time_col, id_col, id_bits)
    return (
        trades.groupBy("product_id", F.window(time_col, f"{size_s} seconds"))
        .agg(
            F.min_by("price", order).alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", order).alias("close"),
            F.sum("size").alias("volume"),
            F.count("*").alias("trade_count"),
        )
        .select(*window_bounds(), *_BAR_COLUMNS)
    )


_BAR_COLUMNS = ("product_id", "open", "high", "low", "close", "volume", "trade_count")


def _wide_order(trades: DataFrame, size_s: int, time_col: str, id_col: str) -> Column:
    """Time and id of any width in one DECIMAL, which Spark can aggregate by hash.

    Ids that are whole numbers, as text or not, follow their value. Others come before them and
    follow a hash of their text; which of two trades of one instant comes first then says nothing,
    but it is the same in every run.
    """
    at = epoch_micros(F.col(time_col))
    offset = F.pmod(at, F.lit(size_s * 1_000_000)).cast("decimal(18,0)")
    trade_id, half = F.col(id_col), F.lit(Decimal(1 << 63))
    by_value = trade_id.try_cast("bigint").cast("decimal(20,0)") + half + F.lit(Decimal(1 << 64))
    by_text = F.xxhash64(trade_id.cast("string")).cast("decimal(20,0)") + half
    return offset * F.lit(Decimal(1 << 66)) + F.coalesce(by_value, by_text)


def _fits(size_s: int, id_bits: int) -> bool:
    return (size_s * 1_000_000).bit_length() + id_bits <= 63


def _packed_order(size_s: int, time_col: str, id_col: str, id_bits: int) -> Column:
    window_us = size_s * 1_000_000
    if not _fits(size_s, id_bits):
        raise ValueError(f"{size_s} s windows leave {63 - window_us.bit_length()} bits for ids")
    trade_id = F.col(id_col).cast("bigint")
    offset = F.pmod(epoch_micros(F.col(time_col)), F.lit(window_us))
    fits = (trade_id >= 0) & (trade_id < 1 << id_bits)
    too_wide = F.raise_error(F.lit(f"trade id needs more than {id_bits} bits")).cast("bigint")
    return F.when(fits, F.shiftleft(offset, id_bits).bitwiseOR(trade_id)).otherwise(too_wide)


def bars_by_size(
    trades: DataFrame,
    sizes: Mapping[str, int] = BAR_SIZES,
    *,
    only: Collection[str] | None = None,
    **options,
) -> DataFrame:
    """Bars of all sizes in one table, labelled in ``bar``, from one pass over the trades.

    ``only`` names the sizes to return, all if it is left out.

    Trades are aggregated to the smallest size only. Each of those bars then counts into one window
    per size, so the second aggregate and its shuffle see bars, never trades. The smallest size
    must divide the others. Write it with ``partitionBy("bar")`` to feed several outputs at once.

    On a stream, whose ``time_col`` needs a watermark, the source is read once as well: a closed
    bar of the smallest size is folded into the open bars of the others, which are the state of
    the second aggregate. Every bar appears once the watermark passes its own end.
    """
    finest = min(sizes.values())
    if any(size_s % finest for size_s in sizes.values()):
        raise ValueError(f"{finest} s does not divide every size of {dict(sizes)}")
    start_us = epoch_micros(F.col("window_start"))
    slots = []
    for label, size_s in sizes.items():
        if only is not None and label not in only:
            continue
        first = start_us - F.pmod(start_us, F.lit(size_s * 1_000_000))
        slots.append(F.struct(
            F.lit(label).alias("bar"),
            F.timestamp_micros(first).alias("start"),
            F.timestamp_micros(first + size_s * 1_000_000).alias("end"),
        ))
    fine = bars(trades, finest, **options)
    kind = fine.schema["window_start"].dataType
    rows = fine.withColumn("slot", F.explode(F.array(*slots)))
    window = F.struct("slot.start", "slot.end")
    if trades.isStreaming:
        # the windows carry the trades' watermark on, by which the second aggregate closes them
        marked = _watermark(trades, options.get("time_col", "time"))
        window = window.alias("window", metadata=marked)
    else:
        window = window.alias("window")
    # Fine bars of a product never share a start, so the start alone orders open and close.
    return (
        rows.select("*", "slot.bar", window)
        .groupBy("bar", "window", "product_id")
        .agg(
            F.min_by("open", "window_start").alias("open"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.max_by("close", "window_start").alias("close"),
            F.sum("volume").alias("volume"),
            F.sum("trade_count").alias("trade_count"),
        )
        .select(
            "bar",
            F.col("window.start").cast(kind).alias("window_start"),
            F.col("window.end").cast(kind).alias("window_end"),
            *_BAR_COLUMNS,
        )
    )


def _watermark(trades: DataFrame, time_col: str) -> dict:
    """What ``withWatermark`` has noted on a stream's time column."""
    marked = trades.schema[time_col].metadata
    if not marked:
        raise ValueError(f"bars of several sizes need a watermark on {time_col}")
    return marked
