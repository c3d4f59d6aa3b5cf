"""Streams against the batch operators: many files, disorder, restarts and repeated batches."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickloom.operators.bars import bars_by_size
from tickloom.operators.imbalance import pane_imbalance
from tickloom.operators.peg import peg_alerts
from tickloom.operators.spread import spread_signal
from tickloom.sinks.tables import TABLES
from tickloom.sinks.topics import json_messages, stream_topic_files
from tickloom.sources.files import stream_parquet, stream_text
from tickloom.streaming.folders import batch_ids, drop_older
from tickloom.streaming.spread import held_spread, live_spread, missed, scored
from tickloom.streaming.store import broken, compact, store_stream, stored
from tickloom.streaming.windows import (
    bar_messages,
    peg_messages,
    rows_dropped_late,
    stream_bars,
    stream_imbalance,
    unique_trades,
)

START = 1_704_412_800


def at(seconds):
    return dt.datetime.fromtimestamp(START + seconds)


def in_files(df, path, order, files):
    """Write ``df`` as ``files`` files that a stream reads one after the other."""
    rows = df.orderBy(order).collect()
    size = -(-len(rows) // files)
    for i in range(0, len(rows), size):
        part = df.sparkSession.createDataFrame(rows[i : i + size], df.schema)
        part.coalesce(1).write.mode("append").parquet(path)
    return path


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def trades(spark, n=300):
    rng = random.Random(3)
    rows = [("AB"[rng.random() < 0.3], str(i), round(rng.uniform(1, 9), 2), 1.0 + i % 3,
             at(i * 0.4 + rng.random()), "BUY") for i in range(n)]
    rows += [("A", str(n), 1.0, 1.0, at(9999), "BUY")]
    return spark.createDataFrame(
        rows, "product_id string, trade_id string, price double, size double, time timestamp,"
        " side string")


def same(left, right):
    return left.exceptAll(right).count() == 0 and right.exceptAll(left).count() == 0


def test_bars_to_three_topics(spark, tmp_path):
    df = trades(spark)
    source = in_files(df, str(tmp_path / "in"), "time", 4)
    stream = stream_parquet(spark, source, df.schema, files_per_batch=1)
    messages = bar_messages(stream_bars(stream, lateness="5 seconds"))
    out = str(tmp_path / "out")
    query = run(stream_topic_files(messages, out, str(tmp_path / "c")), tmp_path / "c")
    assert rows_dropped_late(query) == 0
    got = spark.read.text(out)
    batch = bars_by_size(df).where(F.col("window_end") <= F.lit(at(9990)))
    topic = F.concat(F.lit("analytics.sol_usd.ohlcv_"), "bar")
    expected = json_messages(batch, topic, exclude=("bar",)).select("value", "topic")
    assert got.select("topic").distinct().count() == 3
    assert same(got.select("value", "topic"), expected)


def test_repeated_trades_can_be_dropped(spark, tmp_path):
    df = trades(spark, 40)
    source = in_files(df.union(df), str(tmp_path / "in"), "time", 2)
    stream = unique_trades(
        stream_parquet(spark, source, df.schema, files_per_batch=1), lateness="20 seconds")
    run(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    assert spark.read.parquet(str(tmp_path / "out")).count() == df.count()


def test_late_rows_are_reported(spark, tmp_path):
    df = trades(spark, 40)
    source = in_files(df, str(tmp_path / "in"), F.col("time").desc(), 4)
    stream = stream_bars(
        stream_parquet(spark, source, df.schema, files_per_batch=1), {"1s": 1}, lateness="1 second")
    query = run(
        stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    assert rows_dropped_late(query) > 0


def test_imbalance(spark, tmp_path):
    df = spark.range(301).select(
        F.lit("A").alias("product_id"),
        F.timestamp_millis(F.lit(START * 1000) + F.when(F.col("id") < 300, F.col("id") * 777)
                           .otherwise(9_999_000)).alias("received_at"),
        F.lit(1.0).alias("best_bid"), F.lit(1.5).alias("best_ask"),
        (F.col("id") % 5).cast("double").alias("best_bid_quantity"),
        (F.col("id") % 2).cast("double").alias("best_ask_quantity"),
    )
    source = in_files(df, str(tmp_path / "in"), "received_at", 3)
    stream = stream_imbalance(stream_parquet(spark, source, df.schema, files_per_batch=1))
    run(stream.writeStream.format("parquet").option("path", str(tmp_path / "out")), tmp_path / "c")
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = pane_imbalance(df).where(F.col("window_end") <= F.lit(at(9989)))

    def rounded(x):
        return x.withColumn("avg_imbalance", F.round(F.col("avg_imbalance") + 3.7e-9, 6))

    assert got.count() > 40 and same(rounded(got), rounded(batch))


def spread_feeds(spark, n=400):
    rng = random.Random(11)
    ticks = [("AB"[i % 4 == 0], at(i * 0.7), i, 100 + rng.random(), 101 + rng.random())
             for i in range(n)]
    oracle = [("AB"[i % 2], at(i * 3.1), i, int(1e10 + rng.random() * 1e8), -8)
              for i in range(n // 4)]
    # A gap without prices, and closing rows that push the watermark past everything.
    oracle = [o for o in oracle if not 100 < (o[1] - at(0)).total_seconds() < 160]
    ticks.append(("A", at(9999), n, 1.0, 1.0))
    oracle.append(("A", at(9999), n, 1, 0))
    return (
        spark.createDataFrame(ticks, "symbol string, ts timestamp, tick_id bigint,"
                              " best_bid double, best_ask double"),
        spark.createDataFrame(oracle, "symbol string, ts timestamp, update_id bigint,"
                              " price_raw bigint, expo int"),
    )


def rounded_scores(df):
    columns = ("spread", "rolling_mean", "rolling_std", "z_score")
    return df.select("symbol", "ts", "tick_id", "sample_count",
                     *[F.round(F.col(c) + 3.7e-9, 6).alias(c) for c in columns])


@pytest.fixture
def spread_case(spark, tmp_path):
    ticks, oracle = spread_feeds(spark)
    expected = spread_signal(ticks, oracle, tick_id=["tick_id"], oracle_id=["update_id"], rows=20)
    expected = rounded_scores(expected.where(F.col("ts") < F.lit(at(9000))))

    def start():
        streams = [
            stream_parquet(spark, str(tmp_path / name), df.schema, files_per_batch=1)
            for name, df in (("ticks", ticks), ("oracle", oracle))
        ]
        return held_spread(
            *streams, str(tmp_path / "out"), tick_id=["tick_id"], oracle_id=["update_id"], rows=20,
            lateness_s=30, piece_s=40)

    # Arrival is out of order by up to 20 seconds.
    jitter = F.unix_millis("ts") + F.pmod(F.xxhash64("ts"), F.lit(20_000))
    in_files(ticks, str(tmp_path / "ticks"), jitter, 4)
    in_files(oracle, str(tmp_path / "oracle"), jitter, 4)
    return start, expected, tmp_path


def test_spread_equals_batch(spark, spread_case):
    start, expected, tmp_path = spread_case
    run(start(), tmp_path / "c")
    got = rounded_scores(scored(spark, str(tmp_path / "out")))
    assert got.count() > 200 and same(got, expected)
    assert len(batch_ids(spark, str(tmp_path / "out/tail"))) <= 3
    assert missed(spark, str(tmp_path / "out")).count() == 0
    # what lies behind the watermark and the reach of a price is not kept
    kept = {int(f.name.split("=")[1]) * 40 - START for f in tmp_path.glob("out/held/*/piece=*")}
    assert min(kept) > 100


def test_spread_survives_a_failed_batch(spark, spread_case, monkeypatch):
    from tickloom.streaming import spread as module

    start, expected, tmp_path = spread_case
    real, calls = module._write, []

    def failing(df, path):
        calls.append(path)
        if "/tail/" in path and sum("/tail/" in c for c in calls) == 2:
            raise RuntimeError("lost between output and tail")
        return real(df, path)

    monkeypatch.setattr(module, "_write", failing)
    with pytest.raises(Exception, match="lost between"):
        run(start(), tmp_path / "c")
    monkeypatch.setattr(module, "_write", real)
    run(start(), tmp_path / "c")
    assert same(rounded_scores(scored(spark, str(tmp_path / "out"))), expected)


def live(spark, tmp_path, ticks, oracle):
    streams = [
        stream_parquet(spark, str(tmp_path / name), df.schema, files_per_batch=1)
        for name, df in (("ticks", ticks), ("oracle", oracle))
    ]
    writer = live_spread(
        *streams, str(tmp_path / "out"), tick_id=["tick_id"], oracle_id=["update_id"], rows=20,
        piece_s=30, slack_s=20)
    run(writer, tmp_path / "c")
    return scored(spark, str(tmp_path / "out"))


def test_live_spread_equals_batch_when_nothing_is_late(spark, tmp_path):
    ticks, oracle = spread_feeds(spark)
    # Files are cut at the same moments, so prices come with the ticks they serve.
    for cut in range(5):
        for name, df in (("ticks", ticks), ("oracle", oracle)):
            second = F.least((F.col("ts").cast("double") - START) / 60, F.lit(4.0))
            part = df.where(F.floor(second) == cut)
            part.coalesce(1).write.mode("append").parquet(str(tmp_path / name))
    got = live(spark, tmp_path, ticks, oracle)
    batch = spread_signal(ticks, oracle, tick_id=["tick_id"], oracle_id=["update_id"], rows=20)
    kept = {int(f.name.split("=")[1]) * 30 - START for f in tmp_path.glob("out/prices/*/piece=*")}
    assert min(kept) >= 120  # earlier prices have passed and are gone
    assert same(rounded_scores(got), rounded_scores(batch))


def test_live_spread_does_not_wait_for_late_prices(spark, tmp_path):
    ticks, oracle = spread_feeds(spark)
    first = ticks.where("tick_id < 50")
    first.coalesce(1).write.parquet(str(tmp_path / "ticks"))
    oracle.where("ts < timestamp_seconds(%d)" % START).coalesce(1).write.parquet(
        str(tmp_path / "oracle"))
    ticks.where("tick_id >= 50").coalesce(1).write.mode("append").parquet(str(tmp_path / "ticks"))
    oracle.coalesce(1).write.mode("append").parquet(str(tmp_path / "oracle"))
    got = live(spark, tmp_path, ticks, oracle)
    assert got.agg(F.min("tick_id")).first()[0] >= 50


def alerts(spark):
    return spark.range(90).select(
        (F.lit(START) + F.col("id") * 3000).alias("publish_time"), F.lit("f").alias("feed_id"),
        (F.lit(100_000_000) + F.col("id") * 20_000).alias("price_raw"), F.lit(-8).alias("expo"))


def test_alerts_stream_into_their_table(spark, tmp_path):
    prices = alerts(spark)
    source = in_files(prices, str(tmp_path / "in"), "publish_time", 3)
    stream = stream_parquet(spark, source, prices.schema, files_per_batch=1)
    topics = str(tmp_path / "topics")
    run(stream_topic_files(peg_messages(stream), topics, str(tmp_path / "c")), tmp_path / "c")
    topic = f"{topics}/topic=alerts.usdc_peg"
    spark.createDataFrame([("{broken",)], "value string").write.mode("append").text(topic)

    table, path = TABLES["usdc_peg_alerts"], str(tmp_path / "stored")
    writer = store_stream(stream_text(spark, topic, files_per_batch=1), table, path)
    run(writer, tmp_path / "c2")
    expected = table.project(peg_alerts(prices))
    assert same(stored(spark, table, path).drop("day"), expected)
    assert stored(spark, table, path).select("day").distinct().count() == 4
    assert [r.value for r in broken(spark, path).collect()] == ["{broken"]
    # Without its checkpoint the job repeats every batch; overwriting leaves no duplicates.
    run(store_stream(stream_text(spark, topic, files_per_batch=1), table, path), tmp_path / "c3")
    assert same(stored(spark, table, path).drop("day"), expected)


def test_stored_batches_are_merged_by_day(spark, tmp_path):
    prices = alerts(spark)
    source = in_files(prices, str(tmp_path / "in"), "publish_time", 6)
    stream = stream_parquet(spark, source, prices.schema, files_per_batch=1)
    topics, topic = str(tmp_path / "topics"), str(tmp_path / "topics/topic=alerts.usdc_peg")
    run(stream_topic_files(peg_messages(stream), topics, str(tmp_path / "c")), tmp_path / "c")
    table, path = TABLES["usdc_peg_alerts"], str(tmp_path / "stored")
    run(store_stream(stream_text(spark, topic, files_per_batch=1), table, path), tmp_path / "c2")
    expected = table.project(peg_alerts(prices))
    batches = batch_ids(spark, f"{path}/rows")
    assert len(batches) > 4
    for keep in (3, 2, 2, 0):
        compact(spark, table, path, keep)
        assert batch_ids(spark, f"{path}/rows") == batches[len(batches) - keep :]
        assert batch_ids(spark, f"{path}/manifest")[-1] == batches[len(batches) - keep - 1]
        assert same(stored(spark, table, path).drop("day"), expected)
    # folders of an unfinished attempt are not read
    stored(spark, table, path).drop("day").write.parquet(f"{path}/rows/batch_id=999")
    (tmp_path / "stored/rows/batch_id=999/_SUCCESS").unlink()
    assert same(stored(spark, table, path).drop("day"), expected)


def test_merging_leaves_other_days_alone(spark, tmp_path):
    """Rows of one day come in six batches, then another day's: the first is not written again."""
    table, path = TABLES["usdc_peg_alerts"], str(tmp_path / "stored")
    topic, checkpoint = str(tmp_path / "topic"), tmp_path / "c"
    prices = peg_alerts(alerts(spark)).withColumn(
        "day", F.floor((F.col("publish_time") - START) / 86_400)
    )

    def arrive(day):
        rows = prices.where(F.col("day") == day).drop("day")
        for part in (rows.where("publish_time % 2 = 0"), rows.where("publish_time % 2 = 1")):
            messages = json_messages(part, "alerts.usdc_peg", key="feed_id").select("value")
            messages.coalesce(1).write.mode("append").text(topic)
        run(store_stream(stream_text(spark, topic, files_per_batch=1), table, path), checkpoint)
        compact(spark, table, path, keep=0)

    def files():
        return {
            (f.parent.parent.name, f.parent.name, f.name, f.stat().st_mtime_ns)
            for f in (tmp_path / "stored/merged").rglob("*.parquet")
        }

    arrive(0)
    before = files()
    arrive(2)
    assert before and before < files()  # another day: only added to
    arrive(0)
    now = files()
    kept = {f for f in before if f in now}
    assert kept == before  # replaced folders stay for one more merge
    again = table.project(peg_alerts(alerts(spark)).where(
        F.floor((F.col("publish_time") - START) / 86_400).isin(0, 2)))
    day_0 = table.project(prices.where("day = 0").drop("day"))
    assert same(stored(spark, table, path).drop("day"), again.unionAll(day_0))
    arrive(1)
    assert not any(f in files() for f in before)


def test_old_batch_folders_are_dropped(spark, tmp_path):
    for i in (1, 2, 5, 9):
        spark.range(1).write.parquet(f"{tmp_path}/batch_id={i}")
    assert batch_ids(spark, str(tmp_path)) == [1, 2, 5, 9]
    drop_older(spark, str(tmp_path), 9, keep=2)
    assert batch_ids(spark, str(tmp_path)) == [2, 5, 9]
