"""Landing topics, stored tables and panels."""

import datetime as dt
import glob
import re

import pytest
from pyspark.sql import functions as F

from tickloom.plans import panels
from tickloom.schemas import BAR, PEG_ALERT, SPREAD
from tickloom.sinks.tables import TABLES, write_table
from tickloom.sinks.topics import json_messages, write_topic_files
from tickloom.sources.feeds import accepted, dead_letters
from tickloom.sources.landing import read_landing
from tickloom.sources.tables import read_table, time_range


def bars_frame(spark, n=4000):
    """Bars over five days, two products; the first product has most rows."""
    start = F.timestamp_seconds(F.lit(1_704_412_800) + F.col("id") * 108)
    numbers = {c: (F.col("id") % 50 + i).cast("double") for i, c in
               enumerate(("open", "high", "low", "close", "volume"))}
    return spark.range(n).select(
        start.alias("window_start"),
        (start + F.expr("INTERVAL 1 MINUTE")).alias("window_end"),
        F.when(F.col("id") % 7 == 0, "B").otherwise("A").alias("product_id"),
        *[v.alias(c) for c, v in numbers.items()],
        F.col("id").alias("trade_count"),
    )


def test_landing_tolerates_broken_messages(spark):
    good = ('{"publish_time": 5, "feed_id": "f", "usdc_usd": 0.9, "deviation": 0.1,'
            ' "severity": "INFO"}')
    texts = [good, '{"publish_time": 6}', '{"publish_time": 7, "extra": [1]}',
             '{"publish_time": "x"}', "{", "", "[]", '{"usdc_usd": null, "publish_time": 8}']
    landing = read_landing(spark.createDataFrame([(t,) for t in texts], "value string"), PEG_ALERT)
    rows = {r.publish_time: r for r in accepted(landing).collect()}
    assert set(rows) == {5, 6, 7, 8}
    assert (rows[5].usdc_usd, rows[6].usdc_usd, rows[8].usdc_usd) == (0.9, 0.0, 0.0)
    assert rows[6].feed_id == ""
    assert sorted(r.value for r in dead_letters(landing).collect()) == [
        "", "[]", "{", '{"publish_time": "x"}']


@pytest.mark.parametrize("fraction", ["", ".5", ".500", ".500000"])
def test_landing_reads_any_number_of_decimals(spark, fraction):
    text = '{"window_start": "2024-01-05 01:02:03%s"}' % fraction
    landing = read_landing(spark.createDataFrame([(text,)], "value string"), BAR)
    row = accepted(landing).first()
    assert row.window_start == dt.datetime(2024, 1, 5, 1, 2, 3, 500_000 if fraction else 0)


def test_topics_round_trip(spark, tmp_path):
    bars = bars_frame(spark, 50)
    path = str(tmp_path / "topics")
    write_topic_files(json_messages(bars, "analytics.sol_usd.ohlcv_1m"), path)
    topic = spark.read.text(f"{path}/topic=analytics.sol_usd.ohlcv_1m")
    back = accepted(read_landing(topic, BAR))
    assert back.exceptAll(bars).count() == 0 and bars.exceptAll(back).count() == 0


def test_projections(spark):
    spread = spark.createDataFrame([(1_700_000_000_123, *[1.0] * 6, 9)], SPREAD)
    row = TABLES["cross_source_spread"].project(spread).first()
    assert row.ts.microsecond == 123000 and "ts_ms" not in row
    peg = spark.createDataFrame([(1_700_000_000, "f", 0.9, 0.1, "INFO")], PEG_ALERT)
    assert TABLES["usdc_peg_alerts"].project(peg).first().ts.microsecond == 0
    stored = TABLES["ohlcv_1s"].project(
        bars_frame(spark, 1).withColumn(
            "window_start", F.expr("timestamp'2024-01-05 00:00:01.123456'")
        )
    )
    assert "window_end" not in stored.columns
    assert stored.first().window_start.microsecond == 123000


@pytest.fixture(scope="module")
def stored_bars(spark, tmp_path_factory):
    table, path = TABLES["ohlcv_1m"], str(tmp_path_factory.mktemp("stored") / "bars")
    write_table(table.project(bars_frame(spark)), table, path)
    return read_table(spark, table, path), path


def test_table_is_partitioned_by_day_and_sorted(spark, stored_bars):
    stored, path = stored_bars
    assert stored.count() == 4000
    days = sorted(int(re.search(r"day=(\d+)", d).group(1)) for d in glob.glob(f"{path}/day=*"))
    assert days == [20240105 + i for i in range(5)]
    for file in glob.glob(f"{path}/day=*/*.parquet"):
        keys = [(r.product_id, r.window_start) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def test_panel_reads_only_its_days(spark, stored_bars):
    stored, _ = stored_bars
    start, end = "2024-01-06 10:00:00", "2024-01-06 10:15:00"
    panel = panels.panel_close(stored, start, end, product_id="A")
    rows = panel.collect()
    expected = stored.where(
        f"product_id = 'A' AND window_start BETWEEN timestamp'{start}' AND timestamp'{end}'"
    ).orderBy("window_start").collect()
    assert [(r.time, r.close) for r in rows] == [(r.window_start, r.close) for r in expected]
    assert 0 < len(rows) < 10
    plan = panel._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: \[([^\]]*)\]", plan).group(1)
    assert "day" in filters and "20240106" in filters
    assert "product_id" in re.search(r"PushedFilters: \[([^\]]*)\]", plan).group(1)
    assert re.search(r"ReadSchema: (\S+)", plan).group(1).count(":") == 3


def test_default_range_is_a_quarter_of_an_hour():
    now = dt.datetime(2024, 1, 5, 12, tzinfo=dt.timezone.utc)
    assert panels.last_range(now) == (now - dt.timedelta(minutes=15), now)


def test_files_of_a_heavy_day_cover_disjoint_ranges(spark, tmp_path):
    table, path = TABLES["ohlcv_1s"], str(tmp_path / "bars")
    rows = spark.range(40_000).select(
        F.timestamp_seconds(F.lit(1_704_412_800) + F.pmod(F.xxhash64("id"), F.lit(80_000)))
        .alias("window_start"),
        F.concat(F.lit("P"), F.col("id") % 3).alias("product_id"),
        *[F.rand(1).alias(c) for c in ("open", "high", "low", "close", "volume")],
        F.lit(1).cast("bigint").alias("trade_count"),
    )
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    before = {name: spark.conf.get(name) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        write_table(rows, table, path, ranged=True)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    files = read_table(spark, table, path).groupBy(F.input_file_name().alias("file"))
    ends = [F.min(F.struct(*table.sort)).alias("low"), F.max(F.struct(*table.sort)).alias("high")]
    ranges = sorted((r.low, r.high) for r in files.agg(*ends).collect())
    assert len(ranges) > 8
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    product, start, end = "P1", "2024-01-05 05:00:00", "2024-01-05 05:10:00"
    hour = time_range(read_table(spark, table, path), "window_start", start, end)
    hour = hour.where(F.col("product_id") == product)
    low, high = hour.agg(F.min("window_start"), F.max("window_start")).first()
    assert hour.count() > 50
    needed = [r for r in ranges if (product, low) <= tuple(r[1]) and tuple(r[0]) <= (product, high)]
    assert len(needed) <= 2
