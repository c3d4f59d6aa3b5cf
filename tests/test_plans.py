"""Physical plans: what is scanned, shuffled and joined, and that hot keys are split."""

import re

import pytest
from pyspark.sql import functions as F

from tickloom.operators.asof import asof_join
from tickloom.operators.bars import bars, bars_by_size
from tickloom.operators.imbalance import pane_imbalance
from tickloom.operators.peg import peg_alerts
from tickloom.operators.rolling import number_rows


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def feed(spark, tmp_path_factory):
    """One wide Parquet table; two thirds of its rows share a product and a second."""
    path = str(tmp_path_factory.mktemp("feed") / "feed")
    i = F.col("id")
    hot = i % 3 > 0
    spark.range(60_000).select(
        F.when(hot, "HOT").otherwise(F.concat(F.lit("P"), (i % 40).cast("string")))
        .alias("product_id"),
        i.alias("trade_id"),
        F.timestamp_micros(
            F.lit(1_700_000_000_000_000) + F.when(hot, i % 1000).otherwise(i * 50_000)
        ).alias("time"),
        *[F.rand(n).alias(c) for n, c in enumerate(
            ("price", "size", "best_bid", "best_ask", "best_bid_quantity", "best_ask_quantity"))],
        F.lit("unused").alias("note"),
    ).repartition(8).write.parquet(path)
    return spark.read.parquet(path)


def read_columns(text):
    return set(re.findall(r"(\w+):", re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)))


def test_bars_shuffle_once_after_a_partial_aggregate(feed):
    packed = plan(bars(feed, 1, id_bits=40))
    assert packed.count("Exchange") == 1
    assert packed.count("HashAggregate") == 2 and "SortAggregate" not in packed
    assert read_columns(packed) <= {"product_id", "trade_id", "time", "price", "size"}
    assert "partial_min_by" in packed


def test_all_bar_sizes_scan_the_trades_once(feed):
    text = plan(bars_by_size(feed, id_bits=40))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 2


def test_panes_do_not_copy_ticks(feed):
    text = plan(pane_imbalance(feed, time_col="time"))
    below_pane_shuffle = text.split("Exchange")[-1]
    assert text.count("Exchange") == 2 and "Expand" not in below_pane_shuffle
    assert "note" not in read_columns(text)


def test_alerts_shuffle_nothing(spark, tmp_path):
    spark.sql(
        "SELECT 1L AS publish_time, 'f' AS feed_id, 1L AS price_raw, 0 AS expo, 'x' AS note"
    ).write.parquet(str(tmp_path / "p"))
    text = plan(peg_alerts(spark.read.parquet(str(tmp_path / "p"))))
    assert "Exchange" not in text
    assert read_columns(text) == {"publish_time", "feed_id", "price_raw", "expo"}


@pytest.mark.parametrize("max_age_s", [10, None])
def test_hot_join_partition_is_split(spark, feed, max_age_s):
    ticks = feed.select(F.col("product_id").alias("symbol"), F.col("time").alias("ts"), "trade_id")
    oracle = ticks.where("trade_id % 50 = 1").select("symbol", "ts", F.col("trade_id").alias("u"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        joined = asof_join(ticks, oracle, carry=["u"], max_age_s=max_age_s)
        rows = joined.collect()
        text = plan(joined)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert "skew=true" in text
    assert "Cartesian" not in text and "NestedLoop" not in text
    assert len(rows) > 30_000


def test_numbering_spreads_a_hot_key(spark, feed):
    df = feed.select("product_id", "time", "trade_id")
    numbered = number_rows(df, "product_id", ["time", "trade_id"])
    files = [f for f in numbered.inputFiles() if "sorted-" in f]
    sizes = [spark.read.parquet(f).count() for f in files]
    assert sum(sizes) == 60_000 and max(sizes) <= 2 * min(sizes)
