"""The spread analytic on streams, micro-batch by micro-batch.

Ticks and prices come in one stream. What later micro-batches need is kept by pieces of time: a
micro-batch adds pieces, reads those that the ticks it scores can reach, and drops whole pieces once
they have passed. Nothing that is kept is written again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions.times import epoch_micros
from tickloom.operators.spread import spreads, with_z_score
from tickloom.schemas import struct
from tickloom.session import staging
from tickloom.settings import MAX_AGE_S, ZSCORE_ROWS
from tickloom.streaming.folders import (
    add_pieces,
    drop_older,
    drop_pieces,
    newest_before,
    read_note,
    read_pieces,
    within,
    write_note,
    written,
)

SCORED = struct(
    "symbol string, ts timestamp, coinbase_mid double, pyth_price double, spread double, "
    "rolling_mean double, rolling_std double, sample_count bigint, z_score double"
)
MISSED = struct("symbol string, ts timestamp, best_bid double, best_ask double")

PIECE_S = 600
FEW = 200_000  # rows of a micro-batch up to which one task may score all those of a symbol
_SECOND = 1_000_000
_EVER = (-(1 << 62), 1 << 62)

Publish = Callable[[DataFrame], None]


def held_spread(
    ticks: DataFrame,
    oracle: DataFrame,
    path: str,
    *,
    tick_id: Sequence[str],
    oracle_id: Sequence[str] = (),
    max_age_s: int = MAX_AGE_S,
    rows: int = ZSCORE_ROWS,
    lateness_s: int = 10,
    publish: Publish | None = None,
    slots_per_s: int | None = None,
    piece_s: int = PIECE_S,
) -> DataStreamWriter:
    """Scores a tick once no earlier price or tick is expected; gives what the batch job gives.

    The watermark is the time of the newest tick or of the newest price, whichever is older, less
    ``lateness_s``. Ticks beyond it are held back; a micro-batch scores those that the watermark
    has passed since the one before. A tick behind the watermark on arrival is kept in the table
    that ``missed`` reads and not scored; a price behind it still serves ticks that are held back.
    ``tick_id`` must be unique (Kafka: partition and offset).

    Scored rows are stored below ``path``, see ``scored``. All folders of a batch are overwritten by
    its id, so a repeated batch leaves no duplicates. ``publish`` also gets the scored rows of each
    batch, at least once, to send them on. Start the writer with a checkpoint location and a
    trigger, one path per checkpoint.
    """
    feed = _feed(ticks, oracle, tick_id, oracle_id)
    reach = (max_age_s + 1) * _SECOND

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = _write(batch, f"{path}/staged/batch_id={batch_id}")
        clocks = read_note(spark, f"{path}/clocks", batch_id)
        seen, now = _look(arrived, clocks)
        if not seen:
            return
        old = clocks.get("watermark")
        begun = "tick" in now and "price" in now
        new = min(now["tick"], now["price"]) - lateness_s * _SECOND if begun else None
        if old is not None:
            new = max(old, new)
            drop_pieces(spark, f"{path}/held", batch_id, old - reach, piece_s)
        start = _EVER[0] if old is None else old
        stop = _EVER[0] if new is None else new
        if seen.get("first_tick", _EVER[1]) <= start:
            late = arrived.where("_tick").where(within("ts", (_EVER[0], start)))
            _write(late.select(*_quote(tick_id)), f"{path}/missed/batch_id={batch_id}")
        least = F.when(F.col("_tick"), stop).otherwise(max(stop - reach, _EVER[0]))
        later = arrived.where(epoch_micros(F.col("ts")) > least)
        add_pieces(later, f"{path}/held", batch_id, piece_s, "ts")
        if stop > start:
            bounds = (max(start - reach, _EVER[0]), stop)
            held = read_pieces(spark, f"{path}/held", arrived.schema, batch_id, bounds, piece_s, "ts")
            known = arrived.where(within("ts", bounds)).unionByName(held)
            ready = known.where("_tick").where(within("ts", (start, stop)))
            joined = _joined(ready, known, path, batch_id, tick_id=tick_id, oracle_id=oracle_id,
                             max_age_s=max_age_s, slots_per_s=slots_per_s)
            _score(joined, path, batch_id, tick_id, rows, publish)
        note = now if new is None else now | {"watermark": new}
        write_note(spark, f"{path}/clocks", batch_id, note)
        drop_older(spark, f"{path}/staged", batch_id, keep=1)

    return feed.writeStream.foreachBatch(score)


def live_spread(
    ticks: DataFrame,
    oracle: DataFrame,
    path: str,
    *,
    tick_id: Sequence[str],
    oracle_id: Sequence[str] = (),
    max_age_s: int = MAX_AGE_S,
    rows: int = ZSCORE_ROWS,
    publish: Publish | None = None,
    slots_per_s: int | None = None,
    slack_s: int = 60,
    piece_s: int = PIECE_S,
) -> DataStreamWriter:
    """The whole analytic without a watermark: a tick is scored in the micro-batch it arrives in.

    For live use, where an answer now matters more than the same answer on a replay. A tick sees
    the oracle prices of its own and earlier micro-batches; a price that arrives later than that
    does not change it. Rolling windows follow arrival: by micro-batch, then by time.

    Prices expire by the clock of the feed that lags: a piece of time is dropped when it is
    ``slack_s`` older than it could matter to the newest tick or to the newest price, whichever is
    older. So a tick feed may lag by any time and in any number of files. Only a tick that comes
    more than ``slack_s`` behind the newest one may find its prices gone; if it gets no price then,
    it is kept in the table that ``missed`` reads, not lost unseen.
    """
    feed = _feed(ticks, oracle, tick_id, oracle_id)
    reach = (max_age_s + 1) * _SECOND
    slack = slack_s * _SECOND

    def score(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        arrived = _write(batch, f"{path}/staged/batch_id={batch_id}")
        clocks = read_note(spark, f"{path}/clocks", batch_id)
        seen, now = _look(arrived, clocks)
        if not seen:
            return
        both = "tick" in clocks and "price" in clocks
        horizon = min(clocks["tick"], clocks["price"]) if both else _EVER[0]
        passed = max(horizon - slack - reach, _EVER[0])
        drop_pieces(spark, f"{path}/prices", batch_id, passed, piece_s)
        if "first_price" in seen:
            recent = (max(passed, _EVER[0]), _EVER[1])
            prices = arrived.where("NOT _tick").where(within("ts", recent))
            add_pieces(prices, f"{path}/prices", batch_id, piece_s, "ts")
        if "first_tick" in seen:
            bounds = (seen["first_tick"] - reach, seen["last_tick"])
            kept = read_pieces(
                spark, f"{path}/prices", arrived.schema, batch_id, bounds, piece_s, "ts"
            )
            known = arrived.where("NOT _tick").unionByName(kept)
            ready = arrived.where("_tick")
            joined = _joined(ready, known, path, batch_id, tick_id=tick_id, oracle_id=oracle_id,
                             max_age_s=max_age_s, slots_per_s=slots_per_s)
            if seen["first_tick"] < horizon - slack:
                late = ready.where(within("ts", (_EVER[0], horizon - slack - 1)))
                name = ["symbol", "ts", *tick_id]
                unpriced = late.join(joined.select(*name), name, "left_anti")
                _write(unpriced.select(*_quote(tick_id)), f"{path}/missed/batch_id={batch_id}")
            _score(joined, path, batch_id, tick_id, rows, publish)
        write_note(spark, f"{path}/clocks", batch_id, now)
        drop_older(spark, f"{path}/staged", batch_id, keep=1)

    return feed.writeStream.foreachBatch(score)


def _feed(
    ticks: DataFrame, oracle: DataFrame, tick_id: Sequence[str], oracle_id: Sequence[str]
) -> DataFrame:
    """Both feeds as one, told apart by ``_tick``."""
    quotes = ticks.select(F.lit(True).alias("_tick"), *_quote(tick_id))
    prices = oracle.select(
        F.lit(False).alias("_tick"), "symbol", "ts", *oracle_id, "price_raw", "expo"
    )
    return quotes.unionByName(prices, allowMissingColumns=True)


def _quote(tick_id: Sequence[str]) -> list[str]:
    return ["symbol", "ts", *tick_id, "best_bid", "best_ask"]


def _look(arrived: DataFrame, clocks: dict) -> tuple[dict, dict]:
    """First and last times of a batch's ticks and prices, and the clocks after it."""
    at = epoch_micros(F.col("ts"))
    kinds = {"tick": F.col("_tick"), "price": ~F.col("_tick")}
    ends = {"first": F.min, "last": F.max}
    found = arrived.agg(
        *(f(F.when(is_kind, at)).alias(f"{end}_{kind}")
          for kind, is_kind in kinds.items() for end, f in ends.items())
    ).first().asDict()
    seen = {name: value for name, value in found.items() if value is not None}
    now = {
        kind: max(seen.get(f"last_{kind}", _EVER[0]), clocks.get(kind, _EVER[0]))
        for kind in kinds
        if f"last_{kind}" in seen or kind in clocks
    }
    return seen, now


def _joined(
    ready: DataFrame, known: DataFrame, path: str, batch_id: int, *, oracle_id: Sequence[str], **how
) -> DataFrame:
    """The spreads of some ticks; ``known`` holds the prices they may see."""
    prices = known.where("NOT _tick").select("symbol", "ts", *oracle_id, "price_raw", "expo")
    joined = spreads(ready, prices, oracle_id=oracle_id, **how)
    rows = _write(joined, f"{path}/joined/batch_id={batch_id}")
    drop_older(ready.sparkSession, f"{path}/joined", batch_id, keep=1)
    return rows


def scored(spark: SparkSession, path: str) -> DataFrame:
    """All scored rows; none, without the ticks' own ids, before the first batch is scored."""
    return written(spark, f"{path}/scored", SCORED, known=False)


def missed(spark: SparkSession, path: str) -> DataFrame:
    """Ticks that came so late that they were not scored, or that prices of their time were gone."""
    return written(spark, f"{path}/missed", MISSED, known=False)


_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"


def _score(
    fresh: DataFrame,
    path: str,
    batch_id: int,
    tick_id: Sequence[str],
    rows: int,
    publish: Publish | None,
) -> None:
    """Scores the spreads of a batch after the tail of the batches before it; keeps the new tail.

    Batches come in time order, so a batch needs only the last ``rows - 1`` rows per symbol of those
    before it, a small table.
    """
    spark = fresh.sparkSession
    known = fresh.withColumn("_batch", F.lit(batch_id).cast("bigint"))
    tail_id = newest_before(spark, f"{path}/tail", batch_id)
    if tail_id is not None:
        known = known.unionByName(spark.read.parquet(f"{path}/tail/batch_id={tail_id}"))
    is_new = F.col("_batch") == batch_id
    few = fresh.count() <= FEW  # from the files' footers
    with staging(spark):
        signal = with_z_score(known, tick_id=tick_id, rows=rows, arrival=["_batch"], few=few)
        new = _write(signal.where(is_new).drop("_batch"), f"{path}/scored/batch_id={batch_id}")
    order = ("_batch", "ts", *tick_id, "spread", "coinbase_mid")
    latest = Window.partitionBy("symbol").orderBy(*[F.col(c).desc() for c in order])
    tail = known.withColumn("_rank", F.row_number().over(latest)).where(
        F.col("_rank") <= max(rows - 1, 1)
    )
    before = spark.conf.get(_LIMIT)
    # Up to this threshold Spark keeps only the first rows of a group before it shuffles them.
    spark.conf.set(_LIMIT, max(1000, rows))
    try:
        _write(tail.drop("_rank"), f"{path}/tail/batch_id={batch_id}")
    finally:
        spark.conf.set(_LIMIT, before)
    drop_older(spark, f"{path}/tail", batch_id, keep=2)
    if publish is not None:
        publish(new)


def _write(df: DataFrame, path: str) -> DataFrame:
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
