"""As-of join: every tick with the latest oracle update at or before it.

The oracle history is cut at the bounds of short time slots into validity intervals, so that the
lookup becomes an ordinary equi-join on (symbol, slot) in which at most one interval matches a
tick. Ticks are shuffled once and never sorted by time. Nothing depends on how many ticks share a
symbol or a slot: Spark splits a hot join partition (adaptive skew join) or broadcasts the oracle
side when its measured size allows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import epoch_micros

# Seconds of oracle history that are put in order together.
CHUNK_S = 60


def asof_join(
    ticks: DataFrame,
    oracle: DataFrame,
    *,
    key: str = "symbol",
    tick_time: str = "ts",
    oracle_time: str = "ts",
    carry: Sequence[str],
    order: Sequence[str] = (),
    max_age_s: int | None = None,
    slots_per_s: int | None = None,
) -> DataFrame:
    """Ticks plus the oracle's ``carry`` columns and its time as ``oracle_ts``.

    An oracle update at the tick's own instant counts as before it. Updates at one instant are
    ranked by ``order``, then by the carried values, the last one wins. Ticks without an oracle
    price are dropped, and with ``max_age_s`` also those whose price is more whole seconds old.

    A tick is compared with the updates of its slot. The width of slots follows the oracle: one that
    updates u times in a second of the time it covers gets about u slots a second, so that slots
    hold a few updates each and updates are copied to a few slots each. The counts are approximate
    and change nothing in the result. ``slots_per_s`` (a divisor of 1,000,000) fixes the width.
    """
    if slots_per_s is None:
        slot_us = _slot_width(oracle, key, oracle_time, max_age_s)
    elif 1_000_000 % slots_per_s:
        raise ValueError(f"{slots_per_s} slots do not divide a second into whole microseconds")
    else:
        slot_us = F.lit(1_000_000 // slots_per_s)
    updates = _one_update_per_instant(oracle, key, oracle_time, carry, order)
    at = epoch_micros(F.col(tick_time))
    if max_age_s is None:
        tick_slots = ticks.select(key, _whole(at, slot_us).alias("_slot")).distinct()
        intervals = _unbounded_intervals(updates, tick_slots, key, slot_us)
    else:
        intervals = _bounded_intervals(updates, key, max_age_s, slot_us)
    return (
        ticks.withColumn("_at", at)
        .withColumn("_slot", _whole(F.col("_at"), slot_us))
        .join(intervals.select(key, "_slot", "_from", "_to", "_update"), [key, "_slot"])
        .where((F.col("_at") >= F.col("_from")) & (F.col("_at") < F.col("_to")))
        .select(*ticks.columns, "_update.oracle_ts", *[F.col(f"_update.{c}") for c in carry])
    )


def _whole(micros: Column, unit: Column | int) -> Column:
    """Whole units since the epoch, rounded down."""
    unit = F.lit(unit) if isinstance(unit, int) else unit
    return F.call_function("div", micros - F.pmod(micros, unit), unit)


# Slots a second that divide it into whole microseconds.
WIDTHS = (1, 2, 5, 10, 20, 50, 100, 200, 500, 1000, 2000, 5000, 10_000)


def _slot_width(oracle: DataFrame, key: str, oracle_time: str, max_age_s: int | None) -> Column:
    """Microseconds of a slot, as a scalar subquery over the oracle.

    Instants with an update, over the seconds that they cover: each block of the age limit's length
    that has an update counts in full.
    """
    at = epoch_micros(F.col(oracle_time))
    block_s = 1 if max_age_s is None else max_age_s + 1
    instants = F.approx_count_distinct(F.xxhash64(key, at))
    blocks = F.approx_count_distinct(F.xxhash64(key, _whole(at, block_s * 1_000_000)))
    density = instants / F.greatest(blocks * block_s, F.lit(1))
    width = F.lit(1_000_000 // WIDTHS[-1])
    for fewer, slots in reversed(list(zip((0, *WIDTHS), WIDTHS))):
        width = F.when(density <= (fewer + slots) / 2 + 0.5, 1_000_000 // slots).otherwise(width)
    return oracle.agg(width.cast("bigint").alias("slot_us")).scalar()


def _one_update_per_instant(oracle, key, oracle_time, carry, order) -> DataFrame:
    """Columns key, _from (micros) and _update: at most 10^6 rows per key and second."""
    update = F.struct(F.col(oracle_time).alias("oracle_ts"), *carry)
    rank = [F.col(c).alias(f"rank{i}") for i, c in enumerate(order)]
    return (
        oracle.withColumn("_from", epoch_micros(F.col(oracle_time)))
        .groupBy(key, "_from")
        .agg(F.max(F.struct(*rank, update.alias("update"))).alias("_best"))
        .select(key, "_from", F.col("_best.update").alias("_update"))
    )


def _bounded_intervals(
    updates: DataFrame, key: str, max_age_s: int, slot_us: Column
) -> DataFrame:
    """Each update from its instant to the next one or to its age limit, once per slot it reaches.

    The next update matters only within the age limit, so updates are ordered in chunks of time,
    each of which also sees the first seconds of the chunk after it.
    """
    second = _whole(F.col("_from"), 1_000_000)
    size = max(CHUNK_S, max_age_s + 1)
    chunk = _whole(second, size)
    opens_chunk = F.pmod(second, F.lit(size)) <= max_age_s
    chunks = F.when(opens_chunk, F.array(chunk - 1, chunk)).otherwise(F.array(chunk))
    in_chunk = Window.partitionBy(key, "_chunk").orderBy("_from")
    expiry = (second + (max_age_s + 1)) * 1_000_000
    slots = F.sequence(_whole(F.col("_from"), slot_us), _whole(F.col("_to") - 1, slot_us))
    return (
        updates.withColumn("_chunk", F.explode(chunks))
        .withColumn("_next", F.lead("_from").over(in_chunk))
        .where(F.col("_chunk") == chunk)
        .withColumn("_to", F.least(F.col("_next"), expiry))
        .withColumn("_slot", F.explode(slots))
    )


def _unbounded_intervals(
    updates: DataFrame, tick_slots: DataFrame, key: str, slot_us: Column
) -> DataFrame:
    """The updates of each slot, and before them the last update of any earlier slot.

    Only slots that hold ticks get such an earlier update. It is filled forward in two levels:
    slots within an hour, hours within a key. A group holds at most an hour's slots or, per year
    of data, 8,784 hours, however many ticks there are.
    """
    hour = _whole(F.col("_slot"), F.call_function("div", F.lit(3_600_000_000), slot_us))
    updates = updates.withColumn("_slot", _whole(F.col("_from"), slot_us))
    slots = (
        updates.select(key, "_slot", F.struct("_from", "_update").alias("_last"))
        .unionByName(tick_slots.withColumn("_ticked", F.lit(True)), allowMissingColumns=True)
        .groupBy(key, "_slot")
        .agg(F.max("_last").alias("_last"), F.max("_ticked").alias("_ticked"))
        .withColumn("_hour", hour)
    )
    before = (Window.unboundedPreceding, -1)
    in_hour = Window.partitionBy(key, "_hour").orderBy("_slot").rowsBetween(*before)
    over_hours = Window.partitionBy(key).orderBy("_hour").rowsBetween(*before)
    hours = (
        slots.groupBy(key, "_hour")
        .agg(F.max("_last").alias("_last"))
        .select(key, "_hour", F.max("_last").over(over_hours).alias("_hour_carry"))
    )
    earlier = (
        slots.withColumn("_carry", F.max("_last").over(in_hour))
        .where("_ticked")
        .join(hours, [key, "_hour"])
        .select(key, "_slot", F.coalesce("_carry", "_hour_carry").alias("_last"))
        .where(F.col("_last").isNotNull())
        .select(key, "_slot", "_last._from", "_last._update")
    )
    # The hour changes nothing about the groups, but keeps this shuffle from doubling as the
    # join's: adaptive execution splits a hot join partition only right after a shuffle of its own.
    in_slot = Window.partitionBy(key, hour, "_slot").orderBy("_from")
    end = (F.col("_slot") + 1) * slot_us
    return updates.unionByName(earlier.select(*updates.columns)).withColumn(
        "_to", F.coalesce(F.lead("_from").over(in_slot), end)
    )
