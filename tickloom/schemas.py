"""Record layouts: raw envelopes, typed inputs, results, and their Avro descriptions."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import types as T


_TYPES = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "timestamp": T.TimestampType(),
    "timestamp_ntz": T.TimestampNTZType(),
}


def struct(columns: str) -> T.StructType:
    """Layout from ``"name type, name type"``; needs no running session, unlike a DDL string."""
    pairs = (column.split() for column in columns.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Fixed values, from here to the result records: names and types of fields on the wire, which the
# feeds and the topics prescribe.

# Typed input records.
TRADE = struct(
    "product_id string, trade_id string, price double, size double, time timestamp, side string"
)
TICKER = struct(
    "product_id string, price double, best_bid double, best_ask double, "
    "best_bid_quantity double, best_ask_quantity double, volume_24_h double, low_24_h double, "
    "high_24_h double, price_percent_chg_24_h double, received_at timestamp"
)
ORACLE = struct(
    "feed_id string, price_raw bigint, conf_raw bigint, expo int, publish_time bigint, "
    "ema_price_raw bigint, ema_conf_raw bigint"
)

# Raw envelopes. Numbers stay text here; the normalisers parse them.
TRADES_ENVELOPE = (
    "channel string, events array<struct<type string, trades array<struct<"
    "product_id string, trade_id string, price string, size string, time string, side string>>>>"
)
TICKER_ENVELOPE = (
    "channel string, events array<struct<tickers array<struct<"
    "product_id string, price string, best_bid string, best_ask string, "
    "best_bid_quantity string, best_ask_quantity string, volume_24_h string, low_24_h string, "
    "high_24_h string, price_percent_chg_24_h string>>>>"
)
ORACLE_ENVELOPE = (
    "parsed array<struct<id string, "
    "price struct<price string, conf string, expo string, publish_time string>, "
    "ema_price struct<price string, conf string>>>"
)

# Result records as they travel on the analytics topics.
BAR = struct(
    "window_start timestamp, window_end timestamp, product_id string, open double, high double, "
    "low double, close double, volume double, trade_count bigint"
)
IMBALANCE = struct(
    "window_start timestamp, window_end timestamp, product_id string, avg_imbalance double, "
    "avg_spread double, avg_bid_qty double, avg_ask_qty double, tick_count bigint"
)
SPREAD = struct(
    "ts_ms bigint, coinbase_mid double, pyth_price double, spread double, rolling_mean double, "
    "rolling_std double, z_score double, sample_count bigint"
)
SPREAD_BY_SYMBOL = struct(
    "ts_ms bigint, coinbase_mid double, pyth_price double, spread double, rolling_mean double, "
    "rolling_std double, z_score double, sample_count bigint, symbol string"
)
PEG_ALERT = struct(
    "publish_time bigint, feed_id string, usdc_usd double, deviation double, severity string"
)

_AVRO_TYPES = {
    "string": "string",
    "double": "double",
    "bigint": "long",
    "int": "int",
    "timestamp": "string",  # ISO-8601 text on the wire
}

# Avro record names, and the side enum.
AVRO_NAMESPACE = "com.pipeline"
AVRO_NAMES = {"trade": "TradeEvent", "ticker": "TickerEvent", "oracle": "PythPriceEvent"}
SIDES = ("BUY", "SELL", "UNKNOWN")
OPTIONAL_TICKER_FIELDS = ("volume_24_h", "low_24_h", "high_24_h", "price_percent_chg_24_h")

RECORDS = {"trade": TRADE, "ticker": TICKER, "oracle": ORACLE}


def avro_schema(record: str, columns: Sequence[str] = ()) -> str:
    """Avro description of a typed record, derived from its Spark layout.

    With ``columns`` it describes only those fields: a reader schema that skips the others.
    """
    fields = []
    for f in RECORDS[record].fields:
        if columns and f.name not in columns:
            continue
        avro: dict = {"name": f.name, "type": _AVRO_TYPES[f.dataType.simpleString()]}
        if record == "trade" and f.name == "side":
            avro["type"] = {"type": "enum", "name": "TradeSide", "symbols": list(SIDES)}
            avro["default"] = "UNKNOWN"
        elif record == "ticker" and f.name in OPTIONAL_TICKER_FIELDS:
            avro["type"] = ["null", avro["type"]]
            avro["default"] = None
        fields.append(avro)
    return json.dumps(
        {
            "type": "record",
            "name": AVRO_NAMES[record],
            "namespace": AVRO_NAMESPACE,
            "fields": fields,
        }
    )
