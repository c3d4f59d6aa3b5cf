"""Rolling statistics over the last N rows of a key, in parallel within one hot key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.session import stage

# Rows per block; the N-1 rows copied from the block before are its overhead.
BLOCK_ROWS = 8192


def number_rows(
    df: DataFrame, key: str, order: Sequence[str], copies: str | None = None
) -> DataFrame:
    """Adds ``_n``: 0, 1, 2, ... per key in ``order``, without gathering a key in one task.

    A range sort spreads the rows evenly whatever the key or time distribution; each partition
    then holds a run of consecutive rows, and the row counts of the runs before it (a table of at
    most partitions + keys rows) give its offset. The sorted rows are staged because the offsets
    must refer to exactly that placement. ``key`` must not be NULL.

    With ``copies`` a row stands for that many equal rows and ``_n`` is the number of the first.
    """
    order_cols = [key, *order]
    placed = stage(
        df.repartitionByRange(*order_cols)
        .sortWithinPartitions(*order_cols)
        .withColumn("_id", F.monotonically_increasing_id()),
        "sorted",
    ).withColumn("_run", F.shiftright("_id", 33))
    before = Window.partitionBy(key).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        placed.groupBy(key, "_run")
        .agg(
            F.min("_id").alias("_first"),
            (F.count("*") if copies is None else F.sum(copies)).alias("_rows"),
        )
        .withColumn("_offset", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
        .drop("_rows")
    )
    if copies is None:
        in_run: Column = F.col("_id") - F.col("_first")
    else:
        earlier = Window.partitionBy(key, "_run").orderBy("_id")
        total = F.sum(copies).over(earlier.rowsBetween(Window.unboundedPreceding, -1))
        in_run = F.coalesce(total, F.lit(0))
    return (
        placed.join(stage(runs, "runs"), [key, "_run"])
        .withColumn("_n", F.col("_offset") + in_run)
        .drop("_id", "_run", "_first", "_offset")
    )


def rolling_stats(
    df: DataFrame,
    *,
    key: str,
    order: Sequence[str],
    value: str,
    rows: int,
    copies: str | None = None,
    block_rows: int = BLOCK_ROWS,
    few: bool = False,
) -> DataFrame:
    """Adds rolling_mean, rolling_std (population) and sample_count over the last ``rows`` rows.

    Rows are cut into blocks of ``block_rows``. A row also goes to the later blocks whose first
    frames reach back to it, which makes every frame complete; those copies are dropped again.
    Exact for any block size. ``order`` must rank the rows of a key; rows that tie on all of it
    must be interchangeable.

    ``copies`` names a column with the number of equal rows a row stands for: such a group is
    unfolded only inside the blocks it covers, so a mass of copies spreads like any other rows.

    ``few`` says that all rows of a key fit one task easily, as those of a micro-batch do: one
    shuffle then numbers and frames them, and nothing is staged. It does not go with ``copies``.
    """
    if few:
        place = Window.partitionBy(key).orderBy(*order)
        numbered = df.withColumns({"_n": F.row_number().over(place) - 1, "_block": F.lit(0)})
        return _frame_stats(numbered, key, value, rows).drop("_n", "_block")
    halo = rows - 1
    count = F.lit(1) if copies is None else F.col(copies)
    last = F.col("_n") + count - 1
    blocks = F.sequence(_div(F.col("_n"), block_rows), _div(last + halo, block_rows))
    spread = (
        number_rows(df, key, order, copies)
        .withColumn("_block", F.explode(blocks))
        .repartition(key, "_block")
    )
    start = F.col("_block") * block_rows
    if copies is not None:
        positions = F.sequence(
            F.greatest("_n", start - halo), F.least(last, start + (block_rows - 1))
        )
        spread = spread.withColumn("_n", F.explode(positions)).drop(copies)
    return (
        _frame_stats(spread, key, value, rows)
        .where((F.col("_n") >= start) & (F.col("_n") < start + block_rows))
        .drop("_n", "_block")
    )


def _frame_stats(df: DataFrame, key: str, value: str, rows: int) -> DataFrame:
    """Mean, deviation and count of the last ``rows`` rows at constant cost per row.

    Rows fall into groups of ``rows``. A frame is the head of the row's own group plus the tail of
    the group before it, and both grow by one row at a time, so no frame is added up anew. The two
    parts are merged by the pairwise variance formula, which never subtracts large sums.
    """
    in_group = Window.partitionBy(key, "_block", "_group")
    growing = (Window.unboundedPreceding, 0)
    parts = {
        "tail": in_group.orderBy(F.col("_n").desc()).rowsBetween(*growing),
        "head": in_group.orderBy("_n").rowsBetween(*growing),
    }
    x = F.col(value)
    for name, frame in parts.items():
        stats = {"n": F.count("*"), "mean": F.avg(x), "var": F.var_pop(x)}
        if name == "tail":
            df = df.withColumn("_group", _div(F.col("_n"), rows))
        for stat, aggregate in stats.items():
            df = df.withColumn(f"_{name}_{stat}", aggregate.over(frame))
    before = Window.partitionBy(key, "_block").orderBy("_group", "_n")
    whole = F.col("_head_n") == rows
    for stat in ("n", "mean", "var"):
        lagged = F.lag(f"_tail_{stat}", rows - 1).over(before)
        df = df.withColumn(f"_tail_{stat}", lagged)
    tail_n = F.when(whole, F.lit(0)).otherwise(F.coalesce("_tail_n", F.lit(0)))
    shift = F.when(tail_n > 0, F.col("_tail_mean") - F.col("_head_mean")).otherwise(F.lit(0.0))
    count = F.col("_head_n") + tail_n
    share = tail_n / count
    variance = (
        F.col("_head_var") * (1 - share)
        + F.coalesce("_tail_var", F.lit(0.0)) * share
        + shift * shift * share * (1 - share)
    )
    return (
        df.withColumn("rolling_mean", F.col("_head_mean") + shift * share)
        .withColumn("rolling_std", F.sqrt(variance))
        .withColumn("sample_count", count)
        .drop("_group", *[f"_{part}_{stat}" for part in parts for stat in ("n", "mean", "var")])
    )


def _div(number: Column, by: int) -> Column:
    return F.call_function("div", number, F.lit(by))
