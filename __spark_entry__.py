"""Queries of this repository and, for each, the SQL that states its result.

Every query covers the whole ``events`` table. Averages are compared after ``round(x + 3.7e-9, 6)``
on both sides: means of two-decimal values often lie exactly on a rounding tie, where the order of
a sum decides the last digit. The library's own records round plainly.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom.functions import framing
from tickloom.operators.asof import asof_join
from tickloom.operators.bars import bars, bars_by_size
from tickloom.operators.imbalance import pane_imbalance
from tickloom.operators.peg import peg_alerts, severity_counts
from tickloom.operators.spread import decode_oracle, spread_records, spread_signal
from tickloom.plans import event_feeds as feeds
from tickloom.plans import panels
from tickloom.schemas import BAR, PEG_ALERT
from tickloom.session import stage, work_dir
from tickloom.settings import BAR_SIZES, SOL_USD_FEED, USDC_USD_FEED, Settings
from tickloom.sinks.tables import TABLES, write_table
from tickloom.sinks.topics import json_messages, routed_ticker, routed_trades
from tickloom.sources.feeds import (
    MESSAGE,
    accepted,
    dead_letters,
    known_feeds,
    letters,
    read_oracle,
    read_ticker,
    read_trades,
)
from tickloom.sources.files import stream_topic_text
from tickloom.sources.landing import read_landing
from tickloom.sources.tables import read_table
from tickloom.streaming.spread import held_spread, live_spread, scored
from tickloom.streaming.store import compact, store_stream, stored
from tickloom.streaming.windows import bar_messages, stream_bars, stream_imbalance

Query = Callable[[SparkSession, str], DataFrame]

NUDGE = 3.7e-9
SCHEMA_ID = 100_003
ID_BITS = 43  # event ids are dense row numbers; 1 s windows leave room for 8.8e12 of them
RANGE = ("1970-01-01 00:00:00", "2099-12-31 23:59:59")  # covers every row


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return feeds.events(spark, sf_dir)


def _stream(
    spark: SparkSession, sf_dir: str, close: bool = True, arrival: bool = False
) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return feeds.stream_events(spark, sf_dir, close, arrival)


def _plain_times(df: DataFrame) -> DataFrame:
    """Instants as zone-free timestamps, the form the SQL side compares."""
    return df.select(
        *[
            F.col(f.name).cast("timestamp_ntz").alias(f.name)
            if f.dataType.simpleString() == "timestamp"
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _rounded(name: str, digits: int = 6) -> Column:
    return F.round(F.col(name) + NUDGE, digits).alias(name)


def _run(writer: DataStreamWriter, name: str) -> None:
    """Run a stream over everything that is there, with one state partition per core."""
    spark = SparkSession.active()
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism)
    try:
        writer = writer.option("checkpointLocation", work_dir(spark, f"checkpoint-{name}"))
        writer.trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def _run_to_table(df: DataFrame, name: str) -> DataFrame:
    path = work_dir(df.sparkSession, name)
    _run(df.writeStream.format("parquet").option("path", path), name)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Bars


def _bars(size_s: int, id_bits: int | None = None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        trades = feeds.trades(_events(spark, sf_dir))
        return _plain_times(bars(trades, size_s, id_bits=id_bits))

    return query


def _all_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feeds.trades(_events(spark, sf_dir))
    return _plain_times(bars_by_size(trades, id_bits=ID_BITS))


def _ranked_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars of trades whose ids are text, so that time and id stay a pair."""
    trades = feeds.trades(_events(spark, sf_dir))
    return _plain_times(bars(trades.withColumn("trade_id", F.col("trade_id").cast("string")), 10))


# Imbalance and peg


def _quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return feeds.ticker(_events(spark, sf_dir)).withColumnRenamed("ts", "received_at")


AVERAGES = ("avg_imbalance", "avg_spread", "avg_bid_qty", "avg_ask_qty")


def _averages(imbalance: DataFrame) -> DataFrame:
    return _plain_times(imbalance).select(
        "window_start", "window_end", "product_id", *map(_rounded, AVERAGES), "tick_count"
    )


def _imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _averages(pane_imbalance(_quotes(spark, sf_dir)))


def _peg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return peg_alerts(feeds.peg_prices(_events(spark, sf_dir)))


def _peg_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return severity_counts(_peg(spark, sf_dir))


# As-of join and spread


def _asof(max_age_s: int | None) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ev = _events(spark, sf_dir)
        joined = asof_join(
            feeds.ticker(ev).select("symbol", "ts", "tick_id"),
            decode_oracle(feeds.oracle(ev)),
            carry=["update_id", "pyth_price"],
            order=["update_id"],
            max_age_s=max_age_s,
        )
        return _plain_times(joined.select("tick_id", "ts", "update_id", "oracle_ts", "pyth_price"))

    return query


def _signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    return spread_signal(
        feeds.ticker(ev), feeds.oracle(ev), tick_id=["tick_id"], oracle_id=["update_id"]
    )


SPREAD_VALUES = ("coinbase_mid", "pyth_price", "spread", "rolling_mean", "rolling_std")


def _scores(signal: DataFrame, *columns: str) -> DataFrame:
    millis = F.unix_millis("ts").alias("ts_ms")
    values = [*map(_rounded, SPREAD_VALUES), _rounded("z_score", 4)]
    return signal.select(*columns, "tick_id", millis, *values, "sample_count")


def _spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scores(_signal(spark, sf_dir))


TINY = 1e-10  # brings the prices to about 1e-8


def _spread_tiny(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytic on very small prices; its results are scaled up again."""
    ev = _events(spark, sf_dir)
    quotes = ("best_bid", "best_ask")
    ticks = feeds.ticker(ev).withColumns({c: F.col(c) * TINY for c in quotes})
    oracle = feeds.oracle(ev).withColumn("expo", F.col("expo") - 10)
    signal = spread_signal(ticks, oracle, tick_id=["tick_id"], oracle_id=["update_id"])
    return _scores(signal.withColumns({c: F.col(c) / TINY for c in SPREAD_VALUES}))


def _spread_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    signal = spread_signal(
        feeds.several_symbols(feeds.ticker(ev)),
        feeds.several_symbols(feeds.oracle(ev)),
        tick_id=["tick_id"],
        oracle_id=["update_id"],
    )
    return _scores(signal, "symbol")


def _spread_without_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The record as published, from quotes that carry no id."""
    ev = _events(spark, sf_dir)
    signal = spread_signal(feeds.ticker(ev), feeds.oracle(ev), oracle_id=["update_id"])
    return spread_records(_nudged(signal))


def _nudged(signal: DataFrame) -> DataFrame:
    shifted = {name: F.col(name) + NUDGE for name in (*SPREAD_VALUES, "z_score")}
    return signal.withColumns(shifted)


# Feed messages


def _trade_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(accepted(read_trades(feeds.trade_messages(_events(spark, sf_dir)))))


def _trade_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(read_trades(feeds.trade_messages(_events(spark, sf_dir))))


def _trade_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the letters of messages with several trades say, by place and reason."""
    raw = feeds.trade_batches(_events(spark, sf_dir)).withColumn(MESSAGE, F.col("event_id"))
    each = letters(read_trades(raw)).select(F.inline("records"))
    return each.groupBy("index", "reason").agg(F.count("*").alias("records"))


def _trade_letter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One letter per message, however many of its trades are unreadable."""
    raw = feeds.trade_batches(_events(spark, sf_dir)).withColumn(MESSAGE, F.col("event_id"))
    sizes = letters(read_trades(raw)).select(F.size("records").alias("unreadable"))
    return sizes.groupBy("unreadable").agg(F.count("*").alias("messages"))


def _ticker_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = feeds.ticker_messages(_events(spark, sf_dir))
    return _plain_times(accepted(read_ticker(raw, received_at=F.col("ts"))))


def _ticker_stamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quotes by product and whether the moment of their reading is their ``received_at``."""
    quotes = accepted(read_ticker(feeds.ticker_messages(_events(spark, sf_dir))))
    away = F.abs(F.unix_seconds("received_at") - F.unix_seconds(F.current_timestamp()))
    return quotes.groupBy("product_id", (away < 3600).alias("stamped_now")).agg(
        F.count("*").alias("quotes")
    )


def _oracle_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = feeds.oracle_lines(_events(spark, sf_dir), [SOL_USD_FEED, USDC_USD_FEED])
    return known_feeds(accepted(read_oracle(lines)), Settings().feed_topics)


def _framing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Message bytes through the registry's frame and back; every fourth value has no frame."""
    ev = _events(spark, sf_dir)
    body = F.encode(F.col("props"), "UTF-8")
    framed_by_id = framing.framed(body, SCHEMA_ID)
    value = F.when(F.col("event_id") % 4 == 0, body).otherwise(framed_by_id)
    raw = spark.read.schema(feeds.EVENTS).parquet(f"{sf_dir}/events.parquet")
    sent = raw.select("event_id", value.alias("value"))
    return sent.select(
        "event_id",
        framing.frame_id(F.col("value")).alias("schema_id"),
        F.decode(framing.unframed(F.col("value")), "UTF-8").alias("body"),
    )


def _topic_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    ticker = routed_ticker(accepted(read_ticker(feeds.ticker_messages(ev))))
    trades = routed_trades(accepted(read_trades(feeds.trade_messages(ev))))
    routed = ticker.select("topic", "product_id").unionByName(trades.select("topic", "product_id"))
    return routed.groupBy("topic", "product_id").agg(F.count("*").alias("messages"))


# Topics, stored tables, panels


def _bars_through_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feeds.trades(_events(spark, sf_dir))
    messages = json_messages(bars(trades, 60), "analytics.sol_usd.ohlcv_1m")
    return _plain_times(accepted(read_landing(messages, BAR)))


def _alert_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every alert as a message, and a broken one for every event with k = 7."""
    prices = feeds.peg_prices(_events(spark, sf_dir))
    broken = feeds.events(spark, sf_dir).where("k = 7").select(
        F.concat(F.lit('{"publish_time": "at '), "event_id", F.lit('"}')).alias("value")
    )
    alerts = json_messages(peg_alerts(prices), "alerts.usdc_peg", key="feed_id")
    return alerts.select("value").unionByName(broken)


def _landing_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return accepted(read_landing(_alert_messages(spark, sf_dir), PEG_ALERT))


def _landing_dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dead_letters(read_landing(_alert_messages(spark, sf_dir), PEG_ALERT))


def _store(records: DataFrame, name: str) -> DataFrame:
    """Records through their JSON topic into the stored table, which is then read."""
    table = TABLES[name]
    landing = accepted(read_landing(json_messages(records, name), table.landing))
    path = work_dir(records.sparkSession, name)
    write_table(table.project(landing), table, path)
    return read_table(records.sparkSession, table, path)


def _stored_bars(size_s: int, name: str) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        trades = feeds.trades(_events(spark, sf_dir))
        return _plain_times(_store(bars(trades, size_s, id_bits=ID_BITS), name))

    return query


def _panel_close(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feeds.trades(_events(spark, sf_dir))
    table = _store(bars(trades, 1, id_bits=ID_BITS), "ohlcv_1s")
    return _plain_times(panels.panel_close(table, *RANGE))


def _stored_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = {name: F.col(name) + NUDGE for name in AVERAGES}
    return _store(pane_imbalance(_quotes(spark, sf_dir)).withColumns(shifted), "imbalance")


def _panel_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = panels.panel_imbalance(_stored_imbalance(spark, sf_dir), *RANGE)
    return _plain_times(panel.withColumn("avg_imbalance", F.round("avg_imbalance", 6)))


def _panel_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _stored_imbalance(spark, sf_dir)
    panel = panels.panel_imbalance_bands(table, *RANGE)
    return _plain_times(panel.withColumn("avg_imbalance", F.round("avg_imbalance", 6)))


def _panel_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _store(spread_records(_nudged(_signal(spark, sf_dir))), "cross_source_spread")
    return _plain_times(panels.panel_spread(table, *RANGE))


FAR_ZONE = "America/New_York"
NIGHT = ("1970-07-17 22:30:00", "1970-07-18 01:45:00")  # part of the shifted feed, over midnight


def _later(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events 15 hours later, so that they lie on both sides of midnight."""
    return _events(spark, sf_dir).withColumn("ts", F.col("ts") + F.expr("INTERVAL 15 HOURS"))


def _far_away(spark: SparkSession, make: Callable[[], DataFrame]) -> DataFrame:
    """What ``make`` gives in a session of another zone."""
    spark.conf.set("spark.sql.session.timeZone", FAR_ZONE)
    try:
        rows = stage(make(), "far-away")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return _plain_times(rows)


def _panel_close_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A night's bars, stored in one zone and read in another."""
    bars_1s = bars(feeds.trades(_later(spark, sf_dir)), 1, id_bits=ID_BITS)
    table = _store(bars_1s, "ohlcv_1s")
    return _far_away(spark, lambda: panels.panel_close(table, *NIGHT))


def _panel_spread_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A night's spreads, written and read in another zone than the events'."""
    ev = _later(spark, sf_dir)
    signal = spread_signal(
        feeds.ticker(ev), feeds.oracle(ev), tick_id=["tick_id"], oracle_id=["update_id"]
    )
    records = stage(spread_records(_nudged(signal)), "records")
    return _far_away(
        spark, lambda: panels.panel_spread(_store(records, "cross_source_spread"), *NIGHT)
    )


def _panel_spread_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several symbols in one stored table, of which the panel shows the hot one."""
    ev = _events(spark, sf_dir)
    signal = spread_signal(
        feeds.several_symbols(feeds.ticker(ev)),
        feeds.several_symbols(feeds.oracle(ev)),
        tick_id=["tick_id"],
        oracle_id=["update_id"],
    )
    records = spread_records(_nudged(signal), with_symbol=True)
    table = _store(records, "cross_source_spread")
    return _plain_times(panels.panel_spread(table, *RANGE, symbol="HOT"))


def _panel_zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = _store(spread_records(_nudged(_signal(spark, sf_dir))), "cross_source_spread")
    return _plain_times(panels.panel_zscore(table, *RANGE))


def _panel_peg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _plain_times(panels.panel_peg(_store(_peg(spark, sf_dir), "usdc_peg_alerts"), *RANGE))


# Streams


def _stream_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feeds.trades(_stream(spark, sf_dir))
    return _plain_times(_run_to_table(stream_bars(trades), "bars"))


def _stream_minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = feeds.trades(_stream(spark, sf_dir))
    closed = _run_to_table(stream_bars(trades, {"1m": 60}), "bars-1m")
    return _plain_times(closed.drop("bar"))


def _stream_bars_by_arrival(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars by the time at which the file of a trade arrived; the given trades come in one file.

    The closing rows come in a file of their own, written now, whose time closes the others' bars.
    """
    stream = _stream(spark, sf_dir, arrival=True)
    trades = feeds.trades(stream).withColumn("time", F.col("arrived_at"))
    closed = _run_to_table(stream_bars(trades, {"1s": 1}, lateness="0 seconds"), "bars-arrival")
    return closed.drop("bar", "window_start", "window_end")


def _stream_imbalance(spark: SparkSession, sf_dir: str) -> DataFrame:
    quotes = feeds.ticker(_stream(spark, sf_dir)).withColumnRenamed("ts", "received_at")
    return _averages(_run_to_table(stream_imbalance(quotes), "imbalance"))


def _stream_peg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run_to_table(peg_alerts(feeds.peg_prices(_stream(spark, sf_dir))), "peg")


def _stream_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = {"tick_id": ["tick_id"], "oracle_id": ["update_id"]}
    ticks, oracle = (f(_stream(spark, sf_dir)) for f in (feeds.ticker, feeds.oracle))
    path = work_dir(spark, "spread")
    _run(held_spread(ticks, oracle, path, **ids), "spread")
    return _scores(scored(spark, path))


def _live_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = {"tick_id": ["tick_id"], "oracle_id": ["update_id"]}
    ticks, oracle = (f(_stream(spark, sf_dir, close=False)) for f in (feeds.ticker, feeds.oracle))
    path = work_dir(spark, "live")
    _run(live_spread(ticks, oracle, path, **ids), "live")
    return _scores(scored(spark, path))


def _lagging_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All prices at once, and the ticks in six later files, one to a micro-batch."""
    ev = _events(spark, sf_dir)
    ticks, oracle = feeds.ticker(ev), feeds.oracle(ev)
    path, sources = work_dir(spark, "lagging"), work_dir(spark, "feeds")
    oracle.write.parquet(f"{sources}/oracle")
    at = F.unix_micros("ts")
    lo, hi = ticks.agg(F.min(at), F.max(at)).first()
    piece = F.floor((at - lo) * 6 / (hi - lo + 1))
    cut = stage(ticks.withColumn("piece", piece), "cut")
    files = 4  # of a piece, which are one micro-batch
    for number in range(6):
        rows = cut.where(F.col("piece") == number).drop("piece")
        rows.repartition(files).write.mode("append").parquet(f"{sources}/ticks")
    streams = [
        spark.readStream.schema(df.schema).option("maxFilesPerTrigger", most).parquet(folder)
        for df, most, folder in (
            (ticks, files, f"{sources}/ticks"),
            (oracle, 10_000, f"{sources}/oracle"),
        )
    ]
    _run(live_spread(*streams, path, tick_id=["tick_id"], oracle_id=["update_id"]), "lagging")
    return _scores(scored(spark, path))


def _stream_to_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades stream to bar topics; the 1 m topic then streams into its stored table."""
    trades = feeds.trades(_stream(spark, sf_dir))
    messages = bar_messages(stream_bars(trades, {"10s": 10, "1m": 60}))
    topics, path = work_dir(spark, "topics"), work_dir(spark, "stored")
    writer = messages.select("value", "topic").writeStream.format("text").partitionBy("topic")
    _run(writer.option("path", topics), "topics")
    topic = stream_topic_text(spark, topics, "analytics.sol_usd.ohlcv_1m")
    _run(store_stream(topic, TABLES["ohlcv_1m"], path), "stored")
    compact(spark, TABLES["ohlcv_1m"], path, keep=0)
    return _plain_times(stored(spark, TABLES["ohlcv_1m"], path))


def entry(spark: SparkSession) -> DataFrame:
    """Flagship query: exchange mid against oracle price with a rolling z-score."""
    return _spread(spark, "/root/testdata/sf0.001")


def reference_queries() -> dict[str, Query]:
    return {
        "ohlcv_1s": _bars(1, ID_BITS),
        "ohlcv_10s": _bars(10, ID_BITS),
        "ohlcv_1m": _bars(60, ID_BITS),
        "ohlcv_10s_text_ids": _ranked_bars,
        "ohlcv_all_sizes": _all_bars,
        "imbalance_hop": _imbalance,
        "peg_alerts": _peg,
        "peg_severity_counts": _peg_counts,
        "asof_latest": _asof(None),
        "asof_stale_filtered": _asof(10),
        "spread_zscore": _spread,
        "spread_zscore_tiny": _spread_tiny,
        "spread_zscore_by_symbol": _spread_by_symbol,
        "spread_zscore_without_ids": _spread_without_ids,
        "trades_normalised": _trade_feed,
        "trades_dead_letters": _trade_dead_letters,
        "trades_letters": _trade_letters,
        "trades_letters_by_size": _trade_letter_counts,
        "ticker_normalised": _ticker_feed,
        "ticker_stamps": _ticker_stamps,
        "oracle_normalised": _oracle_feed,
        "topic_routing": _topic_routing,
        "json_round_trip": _bars_through_json,
        "landing_alerts": _landing_alerts,
        "landing_dead_letters": _landing_dead_letters,
        "avro_framing": _framing,
        "stored_ohlcv_1s": _stored_bars(1, "ohlcv_1s"),
        "stored_ohlcv_10s": _stored_bars(10, "ohlcv_10s"),
        "stored_ohlcv_1m": _stored_bars(60, "ohlcv_1m"),
        "panel_close": _panel_close,
        "panel_imbalance": _panel_imbalance,
        "panel_imbalance_bands": _panel_bands,
        "panel_close_range": _panel_close_range,
        "panel_spread_range": _panel_spread_range,
        "panel_spread_by_symbol": _panel_spread_by_symbol,
        "panel_spread": _panel_spread,
        "panel_zscore": _panel_zscore,
        "panel_peg": _panel_peg,
        "stream_ohlcv_1m": _stream_minute_bars,
        "stream_ohlcv_all_sizes": _stream_bars,
        "stream_ohlcv_by_arrival": _stream_bars_by_arrival,
        "stream_imbalance_hop": _stream_imbalance,
        "stream_peg_alerts": _stream_peg,
        "stream_spread_zscore": _stream_spread,
        "stream_spread_live": _live_spread,
        "stream_spread_lagging": _lagging_spread,
        "stream_to_stored_ohlcv_1m": _stream_to_store,
    }


_FX = """
WITH fx AS (
  SELECT event_id, user_id, event_type, value,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         make_timestamp(epoch_us(ts) // 100) AS ts
  FROM events)"""


def _bars_sql(size_s: int, extra: str = "") -> str:
    return f"""
  SELECT {extra}time_bucket(INTERVAL '{size_s} seconds', ts) AS window_start,
         time_bucket(INTERVAL '{size_s} seconds', ts) + INTERVAL '{size_s} seconds' AS window_end,
         event_type AS product_id,
         arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
         arg_max(value, (ts, event_id)) AS close,
         sum(CAST(k AS DOUBLE)) AS volume, count(*) AS trade_count
  FROM fx GROUP BY ALL"""


_ALL_BARS = _FX + " UNION ALL ".join(
    _bars_sql(size_s, f"'{label}' AS bar, ") for label, size_s in BAR_SIZES.items()
)

_IMBALANCE = _FX + """,
q AS (
  SELECT event_type AS product_id, ts, 2 * k / 1000.0 AS w,
         (100 + value + k / 1000.0) - (100 + value - k / 1000.0) AS width,
         CAST(k AS DOUBLE) AS b, CAST(user_id % 50 AS DOUBLE) AS a
  FROM fx WHERE event_type <> 'purchase'),
h AS (
  SELECT time_bucket(INTERVAL '5 seconds', ts) - i * INTERVAL '5 seconds' AS window_start, q.*
  FROM q, range(6) AS r(i)),
imb AS (
  SELECT window_start, window_start + INTERVAL '30 seconds' AS window_end, product_id,
         round(avg(CASE WHEN b + a > 0 THEN (b - a) / (b + a) ELSE 0.0 END) + 3.7e-9, 6)
           AS avg_imbalance,
         round(avg(width) + 3.7e-9, 6) AS avg_spread,
         round(avg(b) + 3.7e-9, 6) AS avg_bid_qty,
         round(avg(a) + 3.7e-9, 6) AS avg_ask_qty,
         count(*) AS tick_count
  FROM h GROUP BY window_start, product_id)"""

_PEG = _FX + """,
d AS (
  SELECT epoch_us(ts) // 1000000 AS publish_time, event_type AS feed_id,
         CAST(100000000 + (k - 50) * 30000 AS DOUBLE) * pow(10.0, -8) AS usdc_usd
  FROM fx),
peg AS (
  SELECT publish_time, feed_id, usdc_usd, abs(1.0 - usdc_usd) AS deviation,
         CASE WHEN abs(1.0 - usdc_usd) > 0.01 THEN 'CRITICAL'
              WHEN abs(1.0 - usdc_usd) > 0.005 THEN 'WARNING' ELSE 'INFO' END AS severity
  FROM d WHERE abs(1.0 - usdc_usd) > 0.001)"""


def _spread_ctes(symbol: str) -> str:
    return _FX + f""",
t AS (
  SELECT {symbol} AS symbol, ts, event_id AS tick_id,
         ((100 + value - k / 1000.0) + (100 + value + k / 1000.0)) / 2.0 AS coinbase_mid
  FROM fx WHERE event_type <> 'purchase'),
o AS (
  SELECT {symbol} AS symbol, ts, max(event_id) AS update_id,
         arg_max(CAST(CAST(round((100 + value) * 1e8) AS BIGINT) AS DOUBLE) * pow(10.0, -8),
                 event_id) AS pyth_price
  FROM fx WHERE event_type = 'purchase' GROUP BY ALL),
j AS (
  SELECT t.*, o.update_id, o.ts AS oracle_ts, o.pyth_price
  FROM t ASOF JOIN o ON t.symbol = o.symbol AND t.ts >= o.ts),
fresh AS (
  SELECT *, coinbase_mid - pyth_price AS spread FROM j
  WHERE epoch_us(ts) // 1000000 - epoch_us(oracle_ts) // 1000000 <= 10),
s AS (
  SELECT *, avg(spread) OVER w AS rolling_mean, stddev_pop(spread) OVER w AS rolling_std,
         count(*) OVER w AS sample_count
  FROM fresh
  WINDOW w AS (PARTITION BY symbol ORDER BY ts, tick_id ROWS BETWEEN 99 PRECEDING AND CURRENT ROW)),
z AS (
  SELECT *, CASE WHEN sample_count >= 2 AND rolling_std > abs(coinbase_mid) * 1e-13
                 THEN (spread - rolling_mean) / rolling_std ELSE 0.0 END AS z_score
  FROM s),
scores AS (
  SELECT symbol, tick_id, epoch_us(ts) // 1000 AS ts_ms,
         round(coinbase_mid + 3.7e-9, 6) AS coinbase_mid,
         round(pyth_price + 3.7e-9, 6) AS pyth_price,
         round(spread + 3.7e-9, 6) + 0.0 AS spread,  -- no negative zero
         round(rolling_mean + 3.7e-9, 6) + 0.0 AS rolling_mean,
         round(rolling_std + 3.7e-9, 6) AS rolling_std,
         round(z_score + 3.7e-9, 4) + 0.0 AS z_score,
         sample_count
  FROM z)"""


_ONE = _spread_ctes("'SOL-USD'")
_MANY = _spread_ctes("CASE WHEN k % 3 = 0 THEN 'HOT' ELSE 'S' || CAST(k % 7 AS VARCHAR) END")
_ASOF_COLUMNS = "tick_id, ts, update_id, oracle_ts, pyth_price"

_TRADE_FEED = _FX + """
SELECT event_type AS product_id, CAST(event_id AS VARCHAR) AS trade_id, value AS price,
       CAST(k AS DOUBLE) AS size, ts AS time,
       CASE k % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'UNKNOWN' END AS side
FROM fx WHERE k <> 7 AND k <> 13 AND k % 10 <> 0"""

_TICKER_FEED = _FX + """
SELECT p AS product_id, value + shift AS price, value + shift AS best_bid,
       value + shift + 1 AS best_ask, CAST(k AS DOUBLE) AS best_bid_quantity,
       CAST(user_id % 50 AS DOUBLE) AS best_ask_quantity,
       CASE WHEN k % 4 > 1 THEN CAST(k AS DOUBLE) END AS volume_24_h,
       value AS low_24_h, CAST(NULL AS DOUBLE) AS high_24_h,
       CAST(NULL AS DOUBLE) AS price_percent_chg_24_h, ts AS received_at
FROM fx, (VALUES ('SOL-USD', 0), ('SOL-USDT', 2)) AS products(p, shift)"""

_ORACLE_FEED = _FX + f"""
SELECT CASE k % 3 WHEN 0 THEN '{SOL_USD_FEED}' ELSE '{USDC_USD_FEED}' END AS feed_id,
       CAST(trunc(value * 100) AS BIGINT) AS price_raw, k AS conf_raw, -2 AS expo,
       epoch_us(ts) // 1000000 AS publish_time,
       CAST(trunc(value * 100) AS BIGINT) + 1 AS ema_price_raw, k AS ema_conf_raw,
       CASE k % 3 WHEN 0 THEN 'pyth.sol_usd.prices' ELSE 'pyth.usdc_usd.prices' END AS topic
FROM fx WHERE k <> 9 AND k % 3 <> 2"""

_ROUTING = _FX + """
SELECT 'coinbase.' || replace(lower(p), '-', '_') || '.ticker' AS topic, p AS product_id,
       count(*) AS messages
FROM fx, (VALUES ('SOL-USD'), ('SOL-USDT')) AS products(p) GROUP BY ALL
UNION ALL
SELECT 'coinbase.' || event_type || '.trades', event_type, count(*)
FROM fx WHERE k <> 7 AND k <> 13 AND k % 10 <> 0 GROUP BY ALL"""

_LATER = _FX.replace("// 100) AS ts", "// 100) + INTERVAL 15 HOURS AS ts")
_NIGHT = f"BETWEEN TIMESTAMP '{NIGHT[0]}' AND TIMESTAMP '{NIGHT[1]}'"
_FRAMING = f"""
SELECT event_id, CASE WHEN event_id % 4 <> 0 THEN CAST({SCHEMA_ID} AS BIGINT) END AS schema_id,
       CASE WHEN event_id % 4 <> 0 THEN props END AS body
FROM events"""


def _stored_sql(size_s: int) -> str:
    return f"""{_FX}, b AS ({_bars_sql(size_s)})
SELECT window_start, product_id, open, high, low, close, volume, trade_count,
       CAST(strftime(window_start, '%Y%m%d') AS INTEGER) AS day
FROM b"""


_BANDS = _IMBALANCE + """
SELECT window_start AS time, avg_imbalance,
       CASE WHEN avg_imbalance >= 0.5 THEN 'yellow' WHEN avg_imbalance >= 0.2 THEN 'green'
            WHEN avg_imbalance >= -0.2 THEN 'yellow' ELSE 'red' END AS band
FROM imb"""


def reference_sql() -> dict[str, str]:
    """SQL that states the result of each of ``reference_queries``."""
    scores = ", ".join(["tick_id", "ts_ms", *SPREAD_VALUES, "z_score", "sample_count"])
    sql = {
        "ohlcv_1s": _FX + _bars_sql(1),
        "ohlcv_10s": _FX + _bars_sql(10),
        "ohlcv_1m": _FX + _bars_sql(60),
        "ohlcv_all_sizes": _ALL_BARS,
        "imbalance_hop": _IMBALANCE + " SELECT * FROM imb",
        "peg_alerts": _PEG + " SELECT * FROM peg",
        "peg_severity_counts": _PEG + " SELECT severity, count(*) AS alerts FROM peg GROUP BY ALL",
        "asof_latest": _ONE + f" SELECT {_ASOF_COLUMNS} FROM j",
        "asof_stale_filtered": _ONE + f" SELECT {_ASOF_COLUMNS} FROM fresh",
        "spread_zscore": _ONE + f" SELECT {scores} FROM scores",
        "spread_zscore_by_symbol": _MANY + " SELECT * FROM scores",
        "spread_zscore_without_ids": _ONE.replace(
            "ORDER BY ts, tick_id", "ORDER BY ts, spread, coinbase_mid"
        )
        + " SELECT * EXCLUDE (symbol, tick_id) FROM scores",
        "trades_normalised": _TRADE_FEED,
        "trades_dead_letters": _FX
        + " SELECT '{broken ' || CAST(event_id AS VARCHAR) AS value FROM fx WHERE k = 7",
        "trades_letters": _FX + """
            SELECT '' AS index, 'no message of this feed' AS reason, count(*) AS records
            FROM fx WHERE k = 7 HAVING count(*) > 0
            UNION ALL SELECT '0.1', 'no readable price', count(*)
            FROM fx WHERE k <> 7 AND k % 5 = 1 HAVING count(*) > 0
            UNION ALL SELECT '0.2', 'no readable size', count(*)
            FROM fx WHERE k <> 7 AND k % 7 = 2 HAVING count(*) > 0""",
        "trades_letters_by_size": _FX + """,
            bad AS (SELECT CASE WHEN k = 7 THEN 1
                                ELSE CAST(k % 5 = 1 AS INT) + CAST(k % 7 = 2 AS INT) END AS n FROM fx)
            SELECT n AS unreadable, count(*) AS messages FROM bad WHERE n > 0 GROUP BY n""",
        "stream_ohlcv_by_arrival": _FX + """
            SELECT event_type AS product_id, arg_min(value, event_id) AS open, max(value) AS high,
                   min(value) AS low, arg_max(value, event_id) AS close,
                   sum(CAST(k AS DOUBLE)) AS volume, count(*) AS trade_count
            FROM fx GROUP BY event_type""",
        "ticker_normalised": _TICKER_FEED,
        "ticker_stamps": _FX + """
            SELECT p AS product_id, true AS stamped_now, count(*) AS quotes
            FROM fx, (VALUES ('SOL-USD'), ('SOL-USDT')) AS products(p) GROUP BY p""",
        "oracle_normalised": _ORACLE_FEED,
        "topic_routing": _ROUTING,
        "landing_dead_letters": _FX
        + """ SELECT '{"publish_time": "at ' || CAST(event_id AS VARCHAR) || '"}' AS value
              FROM fx WHERE k = 7""",
        "avro_framing": _FRAMING,
        "stored_ohlcv_1s": _stored_sql(1),
        "stored_ohlcv_10s": _stored_sql(10),
        "stored_ohlcv_1m": _stored_sql(60),
        "spread_zscore_tiny": _ONE + f" SELECT {scores} FROM scores",
        "panel_close_range": f"""{_LATER}, b AS ({_bars_sql(1)})
            SELECT window_start AS time, close FROM b WHERE window_start {_NIGHT}""",
        "panel_spread_range": _ONE.replace(_FX, _LATER)
        + f""" SELECT make_timestamp(ts_ms * 1000) AS time, spread, rolling_mean FROM scores
              WHERE make_timestamp(ts_ms * 1000) {_NIGHT}""",
        "panel_spread_by_symbol": _MANY
        + """ SELECT make_timestamp(ts_ms * 1000) AS time, spread, rolling_mean FROM scores
              WHERE symbol = 'HOT'""",
        "panel_close": f"{_FX}, b AS ({_bars_sql(1)}) SELECT window_start AS time, close FROM b",
        "panel_imbalance": _IMBALANCE + " SELECT window_start AS time, avg_imbalance FROM imb",
        "panel_imbalance_bands": _BANDS,
        "panel_spread": _ONE
        + " SELECT make_timestamp(ts_ms * 1000) AS time, spread, rolling_mean FROM scores",
        "panel_zscore": _ONE + " SELECT make_timestamp(ts_ms * 1000) AS time, z_score FROM scores",
        "panel_peg": _PEG
        + " SELECT make_timestamp(publish_time * 1000000) AS time, usdc_usd, deviation FROM peg",
    }
    same = {
        "ohlcv_10s_text_ids": "ohlcv_10s",
        "json_round_trip": "ohlcv_1m",
        "landing_alerts": "peg_alerts",
        "stream_ohlcv_1m": "ohlcv_1m",
        "stream_ohlcv_all_sizes": "ohlcv_all_sizes",
        "stream_imbalance_hop": "imbalance_hop",
        "stream_peg_alerts": "peg_alerts",
        "stream_spread_zscore": "spread_zscore",
        "stream_spread_live": "spread_zscore",
        "stream_spread_lagging": "spread_zscore",
        "stream_to_stored_ohlcv_1m": "stored_ohlcv_1m",
    }
    return sql | {name: sql[twin] for name, twin in same.items()}


# Training-data operators: a part that may be absent


def _training_data() -> tuple[dict[str, Query], dict[str, str]]:
    try:
        import corpus_pipeline
        from tickloom.llm.queries import QUERIES, SQL
    except ImportError as missing:  # the part itself, or a package that only it needs
        warnings.warn(f"without the training-data queries: {missing}", stacklevel=2)
        return {}, {}
    sql = {"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}
    return QUERIES | {"pipeline": corpus_pipeline.run}, SQL | sql


def queries() -> dict[str, Query]:
    return reference_queries() | _training_data()[0]


def oracle_sql() -> dict[str, str]:
    return reference_sql() | _training_data()[1]
