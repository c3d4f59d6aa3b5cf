"""Rolling statistics against brute force, over block sizes, hot keys and masses of copies."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.rolling import number_rows, rolling_stats


def brute_force(values, rows):
    out = []
    for i, _ in enumerate(values):
        frame = values[max(0, i - rows + 1) : i + 1]
        mean = sum(frame) / len(frame)
        std = math.sqrt(sum((x - mean) ** 2 for x in frame) / len(frame))
        out.append((mean, std, len(frame)))
    return out


def expected_by_key(data, rows):
    """data: (key, id, value); result keyed by (key, id)."""
    result = {}
    for key in {k for k, _, _ in data}:
        ordered = sorted((i, v) for k, i, v in data if k == key)
        stats = brute_force([v for _, v in ordered], rows)
        result.update({(key, i): s for (i, _), s in zip(ordered, stats)})
    return result


def hot_data(n=700):
    rng = random.Random(5)
    data = []
    for i in range(n):
        key = "HOT" if i % 3 else f"K{i % 5}"
        data.append((key, i, 1000 + rng.choice([rng.uniform(-5, 5), 2.5])))
    return data


@pytest.mark.parametrize(
    ("rows", "block_rows"), [(1, 7), (2, 1), (5, 4), (10, 64), (100, 50), (100, 8192), (100, 100)]
)
def test_equals_brute_force(spark, rows, block_rows):
    data = hot_data()
    df = spark.createDataFrame(data, "symbol string, id bigint, x double").repartition(6, "id")
    got = rolling_stats(
        df, key="symbol", order=["id"], value="x", rows=rows, block_rows=block_rows
    ).collect()
    expected = expected_by_key(data, rows)
    assert len(got) == len(data)
    for row in got:
        mean, std, count = expected[row.symbol, row.id]
        assert row.rolling_mean == pytest.approx(mean, abs=1e-9)
        assert row.rolling_std == pytest.approx(std, abs=1e-7)
        assert row.sample_count == count


def test_equal_samples_have_no_deviation(spark):
    df = spark.range(500).select(F.lit("A").alias("symbol"), "id", F.lit(0.1).alias("x"))
    got = rolling_stats(df, key="symbol", order=["id"], value="x", rows=30, block_rows=64)
    assert got.agg(F.max("rolling_std")).first()[0] < 1e-12


@pytest.mark.parametrize("block_rows", [3, 16, 1000])
def test_copies_are_unfolded(spark, block_rows):
    folded = [("A", 1, 2.0, 1), ("A", 2, 5.0, 40), ("A", 3, 1.0, 2), ("B", 1, 7.0, 3)]
    df = spark.createDataFrame(folded, "symbol string, id bigint, x double, copies bigint")
    got = rolling_stats(
        df, key="symbol", order=["id"], value="x", rows=6, copies="copies", block_rows=block_rows
    ).collect()
    for key in "AB":
        values = [x for k, _, x, copies in folded if k == key for _ in range(copies)]
        expected = sorted(brute_force(values, 6))
        mine = sorted(
            (r.rolling_mean, r.rolling_std, r.sample_count) for r in got if r.symbol == key
        )
        assert len(mine) == len(expected)
        for a, b in zip(mine, expected):
            assert a == pytest.approx(b, abs=1e-9)


def test_rows_are_numbered_without_gaps(spark):
    df = spark.createDataFrame(hot_data(), "symbol string, id bigint, x double")
    numbered = number_rows(df.repartition(7), "symbol", ["id"]).collect()
    for key in {r.symbol for r in numbered}:
        mine = sorted((r.id, r._n) for r in numbered if r.symbol == key)
        assert [n for _, n in mine] == list(range(len(mine)))
