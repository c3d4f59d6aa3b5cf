"""Exchange mid price against oracle price: spread and rolling z-score."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.functions.prices import fixed_point, mid_price, z_score
from tickloom.functions.times import epoch_millis
from tickloom.operators.asof import asof_join
from tickloom.operators.rolling import BLOCK_ROWS, rolling_stats
from tickloom.session import stage
from tickloom.settings import MAX_AGE_S, ZSCORE_ROWS


def decode_oracle(oracle: DataFrame) -> DataFrame:
    """Adds ``pyth_price`` from mantissa and exponent."""
    return oracle.withColumn("pyth_price", fixed_point(F.col("price_raw"), F.col("expo")))


def spreads(
    ticks: DataFrame,
    oracle: DataFrame,
    *,
    tick_id: Sequence[str] = (),
    oracle_id: Sequence[str] = (),
    max_age_s: int | None = MAX_AGE_S,
    slots_per_s: int | None = None,
) -> DataFrame:
    """symbol, ts, tick ids, coinbase_mid, pyth_price, spread for ticks with a fresh oracle price.

    Both inputs carry ``symbol`` and ``ts``; ticks also best_bid and best_ask, the oracle also
    price_raw and expo. Without a ``tick_id`` equal quotes of one instant are folded into one row
    with their number in ``copies``, before anything is shuffled by symbol.
    """
    priced = decode_oracle(oracle).select("symbol", "ts", *oracle_id, "pyth_price")
    mid = mid_price(F.col("best_bid"), F.col("best_ask")).alias("coinbase_mid")
    quoted = ticks.select("symbol", "ts", *tick_id, mid)
    if not tick_id:
        quoted = quoted.groupBy(*quoted.columns).agg(F.count("*").alias("copies"))
    return (
        asof_join(
            quoted,
            priced,
            carry=["pyth_price"],
            order=oracle_id,
            max_age_s=max_age_s,
            slots_per_s=slots_per_s,
        )
        .withColumn("spread", F.col("coinbase_mid") - F.col("pyth_price"))
        .drop("oracle_ts")
    )


def with_z_score(
    df: DataFrame,
    *,
    tick_id: Sequence[str] = (),
    rows: int = ZSCORE_ROWS,
    arrival: Sequence[str] = (),
    block_rows: int = BLOCK_ROWS,
    few: bool = False,
) -> DataFrame:
    """Adds the rolling statistics of ``spread`` per symbol and the z-score of each row.

    Rows follow event time, within the ``arrival`` columns if there are any. ``few`` is for
    micro-batches whose rows fit one task, see ``rolling_stats``.
    """
    # Rows that tie on all of these have equal output, so their order cannot matter.
    stats = rolling_stats(
        df,
        key="symbol",
        order=[*arrival, "ts", *tick_id, "spread", "coinbase_mid"],
        value="spread",
        rows=rows,
        copies="copies" if "copies" in df.columns else None,
        block_rows=block_rows,
        few=few,
    )
    inputs = ("spread", "rolling_mean", "rolling_std", "sample_count", "coinbase_mid")
    score = z_score(*[F.col(c) for c in inputs])
    return stats.withColumn("z_score", score)


def spread_signal(
    ticks: DataFrame,
    oracle: DataFrame,
    *,
    tick_id: Sequence[str] = (),
    oracle_id: Sequence[str] = (),
    max_age_s: int = MAX_AGE_S,
    rows: int = ZSCORE_ROWS,
    slots_per_s: int | None = None,
) -> DataFrame:
    """The whole analytic, unrounded: as-of join with staleness limit, then rolling z-score.

    ``tick_id`` names columns that identify a tick; leave it out if there are none. The joined rows
    are staged, as the range sort that numbers them reads its input twice, and so are the numbered
    ones; both jobs run at once, see ``tickloom.session.staging``.
    """
    joined = spreads(
        ticks,
        oracle,
        tick_id=tick_id,
        oracle_id=oracle_id,
        max_age_s=max_age_s,
        slots_per_s=slots_per_s,
    )
    return with_z_score(stage(joined, "joined"), tick_id=tick_id, rows=rows)


def spread_records(signal: DataFrame, *, with_symbol: bool = False) -> DataFrame:
    """The published record: event time in milliseconds, 6 decimals, 4 for the z-score.

    It was made for one symbol; ``with_symbol`` puts the symbol beside its eight fields.
    """
    rounded = [
        F.round(c, 6).alias(c)
        for c in ("coinbase_mid", "pyth_price", "spread", "rolling_mean", "rolling_std")
    ]
    return signal.select(
        epoch_millis(F.col("ts")).alias("ts_ms"),
        *rounded,
        F.round("z_score", 4).alias("z_score"),
        "sample_count",
        *(["symbol"] if with_symbol else []),
    )
