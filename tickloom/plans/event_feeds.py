"""Market feeds derived from a generic ``events`` table, for benchmarks and checks.

Events lie minutes apart; their time is compressed 100 times so that second-sized windows fill.
Every view covers the whole table and is a projection, so it scales with it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.schemas import struct
from tickloom.session import work_dir
from tickloom.sources.files import stream_parquet

SYMBOL = "SOL-USD"
ORACLE_EVENT = "purchase"

EVENTS = struct(
    "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
    "props string"
)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_feed_time(spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet"))


def stream_events(
    spark: SparkSession, sf_dir: str, close: bool = True, arrival: bool = False
) -> DataFrame:
    """The same rows as a stream, closed by two rows a month later, one tick and one price.

    Append mode keeps windows open until the watermark passes them; the closing rows push it past
    all real ones, and are themselves never emitted. The pattern lets the path be one file or a
    directory. ``arrival`` adds the time of a row's file as ``arrived_at``.
    """

    def read(path: str) -> DataFrame:
        rows = stream_parquet(spark, path, EVENTS)
        if not arrival:
            return rows
        return rows.select("*", F.col("_metadata.file_modification_time").alias("arrived_at"))

    stream = read(f"{sf_dir}/events.parque[t]")
    if not close:
        return with_feed_time(stream)
    raw = spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    end = raw.agg(F.max("ts").alias("ts"), F.max("event_id").alias("event_id"))
    kinds = F.array(F.lit(ORACLE_EVENT), F.lit("view"))
    closing = end.select(
        (F.col("event_id") + 1).alias("event_id"),
        (F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("ts"),
        F.lit(0).cast("bigint").alias("user_id"),
        F.explode(kinds).alias("event_type"),
        F.lit(0.0).alias("value"),
        F.lit('{"k": 50}').alias("props"),
    )
    path = work_dir(spark, "closing")
    closing.write.parquet(path)
    return with_feed_time(stream.unionByName(read(path)))


def with_feed_time(raw: DataFrame) -> DataFrame:
    """event_id, user_id, event_type, value, k (from the props text) and the compressed ts."""
    return raw.select(
        "event_id",
        "user_id",
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("bigint").alias("k"),
        F.expr("timestamp_micros(unix_micros(cast(ts AS timestamp)) div 100)").alias("ts"),
        *(c for c in raw.columns if c == "arrived_at"),
    )


def trades(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_type").alias("product_id"),
        F.col("event_id").alias("trade_id"),
        F.col("value").alias("price"),
        F.col("k").cast("double").alias("size"),
        F.col("ts").alias("time"),
        F.when(F.col("k") % 3 == 0, "BUY").when(F.col("k") % 3 == 1, "SELL").otherwise("HOLD")
        .alias("side"),
        *(c for c in ev.columns if c == "arrived_at"),
    )


def several_symbols(feed: DataFrame) -> DataFrame:
    """The feed over several symbols, one of which has a third of the rows and more."""
    k = F.col("k")
    name = F.when(k % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), (k % 7).cast("string")))
    return feed.withColumn("symbol", name)


def ticker(ev: DataFrame) -> DataFrame:
    width = F.col("k") / 1000.0
    return ev.where(F.col("event_type") != ORACLE_EVENT).select(
        F.lit(SYMBOL).alias("symbol"),
        "k",
        F.col("event_id").alias("tick_id"),
        F.col("ts"),
        F.col("event_type").alias("product_id"),
        F.col("value").alias("price"),
        (100 + F.col("value") - width).alias("best_bid"),
        (100 + F.col("value") + width).alias("best_ask"),
        F.col("k").cast("double").alias("best_bid_quantity"),
        (F.col("user_id") % 50).cast("double").alias("best_ask_quantity"),
    )


def oracle(ev: DataFrame) -> DataFrame:
    return ev.where(F.col("event_type") == ORACLE_EVENT).select(
        F.lit(SYMBOL).alias("symbol"),
        "k",
        F.col("event_id").alias("update_id"),
        F.col("ts"),
        F.round((100 + F.col("value")) * 1e8).cast("bigint").alias("price_raw"),
        F.lit(-8).alias("expo"),
    )


def peg_prices(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.unix_seconds("ts").alias("publish_time"),
        F.col("event_type").alias("feed_id"),
        F.col("event_id"),
        (100_000_000 + (F.col("k") - 50) * 30_000).alias("price_raw"),
        F.lit(-8).alias("expo"),
    )


def trade_messages(ev: DataFrame) -> DataFrame:
    """One raw trade message per event, with the irregularities a live feed has."""
    k = F.col("k")
    trade = F.struct(
        F.col("event_type").alias("product_id"),
        F.col("event_id").cast("string").alias("trade_id"),
        F.col("value").cast("string").alias("price"),
        k.cast("string").alias("size"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
        F.when(k % 3 == 0, "BUY").when(k % 3 == 1, "SELL").when(k % 6 == 2, "HOLD").alias("side"),
    )
    event = F.struct(
        F.when(k % 10 == 0, "snapshot").otherwise("update").alias("type"),
        F.array(trade).alias("trades"),
    )
    channel = F.when(k == 13, "heartbeats").otherwise("market_trades").alias("channel")
    text = F.to_json(F.struct(channel, F.array(event).alias("events")))
    return _messages(ev, F.when(k == 7, F.concat(F.lit("{broken "), "event_id")).otherwise(text))


def trade_batches(ev: DataFrame) -> DataFrame:
    """One raw message per event with three trades, some of which cannot be read."""
    k = F.col("k")

    def trade(number: int, price: Column, size: Column):
        return F.struct(
            F.col("event_type").alias("product_id"),
            (F.col("event_id") * 3 + number).cast("string").alias("trade_id"),
            price.alias("price"),
            size.alias("size"),
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("time"),
            F.lit("BUY").alias("side"),
        )

    price, size = F.col("value").cast("string"), k.cast("string")
    trades = F.array(
        trade(0, price, size),
        trade(1, F.when(k % 5 == 1, "dear").otherwise(price), size),
        trade(2, price, F.when(k % 7 != 2, size)),
    )
    event = F.struct(F.lit("update").alias("type"), trades.alias("trades"))
    channel = F.lit("market_trades").alias("channel")
    text = F.to_json(F.struct(channel, F.array(event).alias("events")))
    broken = F.concat(F.lit("{broken "), "event_id")
    return _messages(ev, F.when(k == 7, broken).otherwise(text), "event_id")


def ticker_messages(ev: DataFrame) -> DataFrame:
    """One raw ticker message per event with a quote for each of two products."""
    k = F.col("k")

    def quote(product: str, shift: int):
        return F.struct(
            F.lit(product).alias("product_id"),
            (F.col("value") + shift).cast("string").alias("price"),
            (F.col("value") + shift).cast("string").alias("best_bid"),
            (F.col("value") + shift + 1).cast("string").alias("best_ask"),
            k.cast("string").alias("best_bid_quantity"),
            (F.col("user_id") % 50).cast("string").alias("best_ask_quantity"),
            F.when(k % 4 == 0, "n/a").when(k % 4 > 1, k.cast("string")).alias("volume_24_h"),
            F.col("value").cast("string").alias("low_24_h"),
        )

    quotes = F.array(quote("SOL-USD", 0), quote("SOL-USDT", 2)).alias("tickers")
    event = F.struct(F.when(k % 10 == 0, "snapshot").otherwise("update").alias("type"), quotes)
    text = F.to_json(F.struct(F.lit("ticker").alias("channel"), F.array(event).alias("events")))
    return _messages(ev, text, "ts")


def oracle_lines(ev: DataFrame, feed_ids: list[str]) -> DataFrame:
    """One event-stream line per event: prices of known and unknown feeds, and comments."""
    k = F.col("k")
    feed = F.when(k % 3 == 0, feed_ids[0]).when(k % 3 == 1, feed_ids[1]).otherwise("unknown")
    raw = (F.col("value") * 100).cast("bigint")
    price = F.struct(
        feed.alias("id"),
        F.struct(
            raw.cast("string").alias("price"),
            k.cast("string").alias("conf"),
            F.lit(-2).alias("expo"),
            F.unix_seconds("ts").alias("publish_time"),
        ).alias("price"),
        F.struct((raw + 1).cast("string").alias("price"), k.cast("string").alias("conf"))
        .alias("ema_price"),
    )
    text = F.concat(F.lit("data: "), F.to_json(F.struct(F.array(price).alias("parsed"))))
    return _messages(ev, F.when(k == 9, ": keep-alive").otherwise(text))


def _messages(ev: DataFrame, text: Column, *columns: str) -> DataFrame:
    """Rows with the text in ``value``, exploded so that readers find it ready, as in a file."""
    return ev.select(*columns, F.explode(F.array(text)).alias("value"))
