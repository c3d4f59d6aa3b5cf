"""Raw messages to typed records, and typed records to routed messages."""

import json

import pytest
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.settings import SOL_USD_FEED, USDC_USD_FEED, Settings
from tickloom.sinks.topics import json_messages, routed_ticker, routed_trades
from tickloom.sources.feeds import (
    accepted,
    dead_letters,
    known_feeds,
    read_oracle,
    read_ticker,
    read_trades,
)
from tickloom.sources.kafka import topic_options


def lines(spark, *texts):
    return spark.createDataFrame([(t if isinstance(t, str) else json.dumps(t),) for t in texts],
                                 "value string")


TRADE = {"product_id": "SOL-USD", "trade_id": "7", "price": "86.5", "size": "0.25",
         "time": "2024-01-05T10:00:00.123456Z", "side": "SELL"}


def trade_message(*trades, kind="update", channel="market_trades"):
    return {"channel": channel, "events": [{"type": kind, "trades": list(trades)}]}


def test_trades(spark):
    raw = lines(
        spark,
        trade_message(TRADE, TRADE | {"trade_id": "8", "side": "HOLD"}),
        trade_message({k: v for k, v in TRADE.items() if k != "side"} | {"trade_id": "9"}),
        trade_message(TRADE | {"trade_id": "snap"}, kind="snapshot"),
        trade_message(TRADE | {"trade_id": "beat"}, channel="heartbeats"),
        {"channel": "market_trades"},
        {"channel": "market_trades", "events": [{"type": "update"}]},
        {"type": "subscribed"},
    )
    records = read_trades(raw)
    got = {r.trade_id: r for r in accepted(records).collect()}
    assert set(got) == {"7", "8", "9"}
    assert (got["7"].price, got["7"].size, got["7"].side) == (86.5, 0.25, "SELL")
    assert got["7"].time.microsecond == 123456
    assert got["8"].side == got["9"].side == "UNKNOWN"
    assert dead_letters(records).count() == 0
    assert accepted(records).columns == schemas.TRADE.names


def test_one_bad_trade_does_not_stop_the_others(spark):
    bad = TRADE | {"trade_id": "bad", "price": "many"}
    records = read_trades(lines(spark, trade_message(TRADE, bad), "{broken", "", "[1]"))
    assert [r.trade_id for r in accepted(records).collect()] == ["7"]
    assert sorted(r.value for r in dead_letters(records).collect())[:2] == ["", "[1]"]
    assert dead_letters(records).count() == 4


QUOTE = {"product_id": "SOL-USDT", "price": "86", "best_bid": "85.9", "best_ask": "86.1",
         "best_bid_quantity": "4", "best_ask_quantity": "0", "volume_24_h": "12.5",
         "low_24_h": "n/a"}


def test_ticker(spark):
    message = {"channel": "ticker", "events": [{"type": "snapshot", "tickers": [QUOTE, QUOTE]}]}
    records = read_ticker(lines(spark, message, message | {"channel": "status"}))
    got = accepted(records).collect()
    assert len(got) == 2 and accepted(records).columns == schemas.TICKER.names
    assert (got[0].best_bid, got[0].best_ask_quantity) == (85.9, 0.0)
    assert (got[0].volume_24_h, got[0].low_24_h, got[0].high_24_h) == (12.5, None, None)
    assert got[0].received_at is not None


def price(feed):
    return {"id": feed, "price": {"price": "8624000000", "conf": "5", "expo": -8,
                                  "publish_time": 1_700_000_000},
            "ema_price": {"price": "8600000000", "conf": "6"}}


def test_oracle(spark):
    payload = json.dumps({"parsed": [price(SOL_USD_FEED), price(USDC_USD_FEED), price("other")]})
    good = [f"data:{payload}", f"  data: {payload} "]
    raw = lines(spark, *good, ":keep-alive", "event: x", "data: {")
    records = read_oracle(raw)
    prices = accepted(records)
    assert prices.count() == 6 and prices.columns == schemas.ORACLE.names
    assert prices.first().price_raw == 8_624_000_000 and prices.first().ema_conf_raw == 6
    assert [r.value for r in dead_letters(records).collect()] == ["data: {"]
    routed = known_feeds(prices, Settings().feed_topics).groupBy("topic").count().collect()
    assert {r.topic: r["count"] for r in routed} == {
        "pyth.sol_usd.prices": 2, "pyth.usdc_usd.prices": 2}


def test_routing(spark):
    products = spark.createDataFrame([("SOL-USD",), ("SOL-USDT",)], "product_id string")
    assert {r.topic for r in routed_ticker(products).collect()} == {
        "coinbase.sol_usd.ticker", "coinbase.sol_usdt.ticker"}
    assert routed_trades(products).first().topic == "coinbase.sol_usd.trades"


def test_json_messages_keep_nulls_and_time_format(spark):
    df = spark.sql(
        "SELECT timestamp'2024-01-05 01:02:03.5' AS t, CAST(null AS double) AS x, 'k' AS k"
    )
    row = json_messages(df, "topic.a", key="k").first()
    assert (row.key, row.topic) == ("k", "topic.a")
    assert json.loads(row.value) == {"t": "2024-01-05 01:02:03.500000", "x": None, "k": "k"}


@pytest.mark.parametrize("record", ["trade", "ticker", "oracle"])
def test_avro_schema_describes_the_record(record):
    avro = json.loads(schemas.avro_schema(record))
    assert [f["name"] for f in avro["fields"]] == schemas.RECORDS[record].names


def test_avro_schema_details():
    fields = {f["name"]: f for f in json.loads(schemas.avro_schema("ticker"))["fields"]}
    assert fields["low_24_h"] == {"name": "low_24_h", "type": ["null", "double"], "default": None}
    assert fields["received_at"]["type"] == "string"
    side = json.loads(schemas.avro_schema("trade"))["fields"][-1]
    assert side["type"]["symbols"] == ["BUY", "SELL", "UNKNOWN"] and side["default"] == "UNKNOWN"


def test_reader_schema_skips_other_fields():
    fields = json.loads(schemas.avro_schema("ticker", ["best_bid", "best_ask"]))["fields"]
    assert [f["name"] for f in fields] == ["best_bid", "best_ask"]


def test_topic_options():
    options = topic_options("host:1", "t", start="earliest", group="g")
    assert options["startingOffsets"] == "earliest" and options["subscribe"] == "t"
    assert topic_options("host:1", "t")["startingOffsets"] == "latest"


def test_settings_from_env():
    settings = Settings.from_env({"ZSCORE_WINDOW": "50", "PYTH_FEED_SOL_USD": "abc"})
    assert settings.zscore_rows == 50 and settings.max_age_s == 10
    assert settings.feed_topics["abc"] == "pyth.sol_usd.prices"


def test_each_message_is_parsed_once(spark, tmp_path):
    path = str(tmp_path / "raw")
    lines(spark, trade_message(TRADE)).write.text(path)
    plan = accepted(read_trades(spark.read.text(path)))._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("from_json") == 1


def test_readers_are_stateless(spark):
    raw = lines(spark, trade_message(TRADE)).withColumn("ts", F.current_timestamp())
    for reader in (read_trades, read_ticker, read_oracle):
        plan = accepted(reader(raw))._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
