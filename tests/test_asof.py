"""As-of join against brute force, with ties, gaps, stale prices and a hot second."""

import random
from bisect import bisect_right

import pytest
from pyspark.sql import functions as F

from tickloom.operators.asof import (
    _bounded_intervals,
    _one_update_per_instant,
    _slot_width,
    asof_join,
)

BASE = 1_700_000_000_000_000


def tables(spark, ticks, oracle):
    ts = F.timestamp_micros("us").alias("ts")
    t = spark.createDataFrame(ticks, "symbol string, us bigint, tick_id bigint")
    o = spark.createDataFrame(oracle, "symbol string, us bigint, update_id bigint, price double")
    return t.select("symbol", ts, "tick_id"), o.select("symbol", ts, "update_id", "price")


def joined(spark, ticks, oracle, max_age_s, slots_per_s=1):
    t, o = tables(spark, ticks, oracle)
    got = asof_join(
        t,
        o,
        carry=["update_id", "price"],
        order=["update_id"],
        max_age_s=max_age_s,
        slots_per_s=slots_per_s,
    ).collect()
    assert len({r.tick_id for r in got}) == len(got)
    return {r.tick_id: r.update_id for r in got}


def brute_force(ticks, oracle, max_age_s):
    result = {}
    for symbol in {s for s, *_ in ticks}:
        updates = sorted((us, i) for s, us, i, _ in oracle if s == symbol)
        times = [us for us, _ in updates]
        for s, us, tick in ticks:
            at = bisect_right(times, us) - 1
            if s != symbol or at < 0:
                continue
            if max_age_s is None or us // 10**6 - times[at] // 10**6 <= max_age_s:
                result[tick] = updates[at][1]
    return result


@pytest.mark.parametrize("max_age_s", [None, 0, 1, 10, 75])
@pytest.mark.parametrize("slots_per_s", [1, 8, None])
def test_equals_brute_force(spark, max_age_s, slots_per_s):
    rng = random.Random(slots_per_s or 3)

    def instant():
        # Coarse steps make ties; a third falls in one second, some at one instant.
        pick = rng.random()
        if pick < 0.1:
            return BASE + 50_000_000
        if pick < 0.35:
            return BASE + 50_000_000 + rng.randrange(10) * 100_000
        return BASE + rng.randrange(4000) * 250_000

    ticks = [(rng.choice("AAB"), instant(), i) for i in range(500)]
    oracle = [(rng.choice("AB"), instant(), i, rng.random()) for i in range(60)]
    got = joined(spark, ticks, oracle, max_age_s, slots_per_s)
    assert got == brute_force(ticks, oracle, max_age_s)


def test_times_before_the_epoch(spark):
    oracle = [("A", -1_500_000, 1, 1.0), ("A", -100, 2, 1.0)]
    assert joined(spark, [("A", -600_000, 1), ("A", 1, 2)], oracle, 1) == {1: 1, 2: 2}
    assert joined(spark, [("A", -600_000, 1), ("A", 1, 2)], oracle, None) == {1: 1, 2: 2}


def test_slots_divide_a_second(spark):
    with pytest.raises(ValueError, match="whole microseconds"):
        joined(spark, [], [], 10, slots_per_s=3)


@pytest.mark.parametrize(
    ("tick_us", "kept"),
    [(-1, False), (0, True), (10_999_999, True), (11_000_000, False)],
)
def test_staleness_counts_whole_seconds(spark, tick_us, kept):
    ticks, oracle = [("A", BASE + tick_us, 1)], [("A", BASE, 5, 1.0)]
    assert joined(spark, ticks, oracle, 10) == ({1: 5} if kept else {})


def test_last_update_of_an_instant_wins(spark):
    oracle = [("A", BASE, 2, 9.0), ("A", BASE, 3, 1.0), ("A", BASE, 1, 5.0)]
    assert joined(spark, [("A", BASE, 1)], oracle, 10) == {1: 3}


def test_other_symbols_are_not_seen(spark):
    assert joined(spark, [("A", BASE, 1)], [("B", BASE, 1, 1.0)], 10) == {}


def test_unbounded_reaches_over_hours_and_days(spark):
    day = 86_400_000_000
    ticks = [("A", BASE + 3 * day, 1), ("A", BASE + 3 * day + 7_200_000_000, 2)]
    assert joined(spark, ticks, [("A", BASE, 4, 1.0)], None) == {1: 4, 2: 4}


@pytest.mark.parametrize("max_age_s", [10, None])
@pytest.mark.parametrize("per_s, fewest, most", [(0.2, 1, 2), (1, 1, 2), (30, 20, 50), (900, 500, 2000)])
def test_slots_follow_the_oracle(spark, per_s, fewest, most, max_age_s):
    """A few updates in a slot, however many come in a second; sparse ones are not cut up."""
    oracle = spark.range(6000).select(
        F.lit("S").alias("symbol"),
        F.timestamp_micros((F.col("id") * (1_000_000 / per_s)).cast("bigint")).alias("ts"),
    )
    width = _slot_width(oracle, "symbol", "ts", max_age_s)
    found = spark.range(1).select(width.alias("us")).first()["us"]
    assert fewest <= 1_000_000 / found <= most


def test_dense_oracle_without_a_parameter(spark):
    """Of 2,000 updates a second a tick meets the few of its slot."""
    oracle = spark.range(8000).select(
        F.lit("S").alias("symbol"), F.timestamp_micros(F.col("id") * 500).alias("ts"),
        F.col("id").cast("double").alias("price"),
    )
    ticks = spark.range(500).select(
        F.lit("S").alias("symbol"), F.timestamp_micros(F.col("id") * 7919 + 3).alias("ts"),
        F.col("id"),
    )
    rows = asof_join(ticks, oracle, carry=["price"], max_age_s=10)
    got = {r["id"]: r.price for r in rows.collect()}
    assert got == {i: float((i * 7919 + 3) // 500) for i in range(500)}
    intervals = _bounded_intervals(
        _one_update_per_instant(oracle, "symbol", "ts", ["price"], []), "symbol", 10,
        _slot_width(oracle, "symbol", "ts", 10),
    )
    in_slot, copies = intervals.groupBy("_slot").count().agg(F.max("count"), F.sum("count")).first()
    assert in_slot <= 8 and copies < 4 * 8000 + 11 * 2000
