"""Raw feed messages (one text per row, column ``value``) to typed records.

Each reader returns the typed columns plus ``_source`` (the message text), ``_ok``, ``_index`` (the
record's place in its message) and ``_reason`` (why it could not be read). Good records of a message
are kept and a bad one never stops the job: ``accepted`` gives the records, ``dead_letters`` the texts
that could not be read. All are stateless projections, so they run on batch and streaming input alike
and shuffle nothing. If the raw rows number their messages in MESSAGE, ``letters`` gives one letter
for each message.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.text import integer, iso_time, number, trade_side

_CORRUPT = "_corrupt"
MESSAGE = "_message"
_NOTES = ("_ok", "_source", "_index", "_reason", MESSAGE)


def read_trades(raw: DataFrame) -> DataFrame:
    """Trade messages to trades; the replayed ``snapshot`` events are skipped."""
    messages = _messages(raw, F.col("value"), schemas.TRADES_ENVELOPE, channel="market_trades")
    live = F.col("event").isNotNull() & ~F.col("event.type").eqNullSafe("snapshot")
    events = _each(messages, "m.events", "event").where(F.col("_broken") | live)
    columns = [
        F.col("r.product_id"),
        F.col("r.trade_id"),
        number(F.col("r.price")).alias("price"),
        number(F.col("r.size")).alias("size"),
        iso_time(F.col("r.time")).alias("time"),
        trade_side(F.col("r.side")).alias("side"),
    ]
    required = ["product_id", "trade_id", "price", "size", "time"]
    return _typed(_each(events, "event.trades", "r"), columns, required)


def read_ticker(raw: DataFrame, received_at: Column | None = None) -> DataFrame:
    """Ticker messages to quotes, snapshots included; unreadable 24 h statistics become NULL.

    ``received_at`` is an expression over the raw rows for replays; the default is now.
    """
    stamp = F.current_timestamp() if received_at is None else received_at
    messages = _messages(
        raw.withColumn("_received_at", stamp), F.col("value"), schemas.TICKER_ENVELOPE, "ticker"
    )
    quotes = _each(_each(messages, "m.events", "event"), "event.tickers", "r")
    required = ["price", "best_bid", "best_ask", "best_bid_quantity", "best_ask_quantity"]
    optional = list(schemas.OPTIONAL_TICKER_FIELDS)
    columns = [F.col("r.product_id")]
    columns += [number(F.col(f"r.{name}")).alias(name) for name in required + optional]
    columns.append(F.col("_received_at").alias("received_at"))
    return _typed(quotes, columns, ["product_id", *required])


def read_oracle(raw: DataFrame) -> DataFrame:
    """Event-stream lines to oracle prices; comment and heartbeat lines are skipped."""
    line = F.trim("value")
    payload = F.trim(F.substring(line, F.lit(len("data:") + 1), F.length(line)))
    messages = _messages(raw.where(line.startswith("data:")), payload, schemas.ORACLE_ENVELOPE)
    columns = [
        F.col("r.id").alias("feed_id"),
        integer(F.col("r.price.price")).alias("price_raw"),
        integer(F.col("r.price.conf")).alias("conf_raw"),
        F.col("r.price.expo").try_cast("int").alias("expo"),
        integer(F.col("r.price.publish_time")).alias("publish_time"),
        integer(F.col("r.ema_price.price")).alias("ema_price_raw"),
        integer(F.col("r.ema_price.conf")).alias("ema_conf_raw"),
    ]
    return _typed(_each(messages, "m.parsed", "r"), columns, schemas.ORACLE.fieldNames())


def accepted(records: DataFrame) -> DataFrame:
    return records.where("_ok").drop(*_NOTES)


def dead_letters(records: DataFrame) -> DataFrame:
    """The message text of every record that could not be read."""
    return records.where("NOT _ok").select(F.col("_source").alias("value"))


def letters(records: DataFrame) -> DataFrame:
    """One letter per message with unreadable records: its text, their places and the reasons.

    For batches whose messages are numbered. Only unreadable records are shuffled; a group is one
    message.
    """
    record = F.struct(F.col("_index").alias("index"), F.col("_reason").alias("reason"))
    return (
        records.where("NOT _ok")
        .groupBy(MESSAGE, F.col("_source").alias("value"))
        .agg(F.sort_array(F.collect_list(record)).alias("records"))
        .drop(MESSAGE)
    )


def known_feeds(oracle: DataFrame, feed_topics: Mapping[str, str]) -> DataFrame:
    """Oracle prices of the followed feeds with their ``topic``; other feeds are dropped.

    The feed table is the settings' own short list, so broadcasting it is safe at any data size.
    """
    feeds = oracle.sparkSession.createDataFrame(
        list(feed_topics.items()), "feed_id string, topic string"
    )
    return oracle.join(F.broadcast(feeds), "feed_id")


def priced_products(oracle: DataFrame, feed_products: Mapping[str, str]) -> DataFrame:
    """Oracle prices with the ``symbol`` of the product they price; other feeds are dropped."""
    products = oracle.sparkSession.createDataFrame(
        list(feed_products.items()), "feed_id string, symbol string"
    )
    return oracle.join(F.broadcast(products), "feed_id")


def _messages(
    raw: DataFrame, text: Column, envelope: str, channel: str | None = None
) -> DataFrame:
    """Parsed messages in ``m``, and ``_broken`` where the text is no message of that shape."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    parsed = F.from_json(text, f"{envelope}, {_CORRUPT} string", options)
    broken = F.col("m").isNull() | F.col(f"m.{_CORRUPT}").isNotNull() | (F.trim("value") == "")
    # A generator, unlike a projection, is not copied into every expression that reads ``m``:
    # each message is parsed once.
    messages = (
        raw.withColumn("_source", F.col("value"))
        .withColumn("m", F.explode(F.array(parsed)))
        .withColumn("_broken", broken)
        .withColumn("_index", F.lit(""))
    )
    if channel is None:
        return messages
    return messages.where(F.col("_broken") | (F.col("m.channel") == channel))


def _each(rows: DataFrame, path: str, name: str) -> DataFrame:
    """One row per element of a list; a broken message stays as one row without an element."""
    healthy = F.when(~F.col("_broken"), F.col(path))
    each = rows.select("*", F.posexplode_outer(healthy).alias("_at", name))
    before = F.when(F.col("_index") != "", F.col("_index"))
    index = F.concat_ws(".", before, F.col("_at"))
    found = each.where(F.col("_broken") | F.col(name).isNotNull())
    return found.withColumn("_index", index).drop("_at")


def _typed(records: DataFrame, columns: Sequence[Column], required: Sequence[str]) -> DataFrame:
    numbered = [MESSAGE] if MESSAGE in records.columns else []
    typed = records.select(*columns, "_source", "_broken", "_index", *numbered)
    ok = ~F.col("_broken")
    for name in required:
        ok = ok & F.col(name).isNotNull()
    missing = F.concat_ws(", ", *(F.when(F.col(n).isNull(), F.lit(n)) for n in required))
    reason = F.when(F.col("_broken"), F.lit("no message of this feed")).otherwise(
        F.concat(F.lit("no readable "), missing)
    )
    return typed.withColumns({"_ok": ok, "_reason": F.when(~ok, reason)}).drop("_broken")
