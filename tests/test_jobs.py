"""The jobs end to end on files: raw messages, typed records, topics, stored tables."""

import json

import pytest

from tickloom.plans import jobs
from tickloom.settings import SOL_USD_FEED, USDC_USD_FEED, Settings
from tickloom.sinks.tables import TABLES
from tickloom.streaming.ingest import dead_letters_of
from tickloom.streaming.store import stored


def iso(second):
    return f"2024-01-05T00:{second // 60:02d}:{second % 60:02d}.000000Z"


def raw_messages(folder):
    """A minute of trades and prices; the last message closes all windows."""
    seconds = [*range(0, 120, 2), 3000]
    trades = [
        {"channel": "market_trades", "events": [{"type": "update", "trades": [
            {"product_id": "SOL-USD", "trade_id": str(s), "price": str(80 + s % 7), "size": "1",
             "time": iso(s), "side": "BUY"}]}]}
        for s in seconds
    ]
    prices = [
        "data:" + json.dumps({"parsed": [
            {"id": feed, "price": {"price": str(raw), "conf": "1", "expo": -8,
                                   "publish_time": 1_704_412_800 + s},
             "ema_price": {"price": "1", "conf": "1"}}
            for feed, raw in ((SOL_USD_FEED, 8_000_000_000), (USDC_USD_FEED, 102_000_000))]})
        for s in seconds
    ]
    texts = {"trades": [*map(json.dumps, trades), "{broken"], "oracle": [":ping", *prices],
             "ticker": ['{"channel": "status"}']}
    for feed, lines in texts.items():
        (folder / feed).mkdir(parents=True)
        (folder / feed / "part.txt").write_text("\n".join(lines))
    return seconds


def run(spark, tmp_path, job, *options, files="files"):
    work = str(tmp_path / "work" / job)
    args = jobs.parse([job, "--work", work, "--files", str(tmp_path / files), "--once", *options])
    for query in jobs.start(spark, args, Settings()):
        query.awaitTermination()
    return work


def topic(spark, tmp_path, job, name, files="files"):
    lines = spark.read.text(str(tmp_path / files / "topics" / job / f"topic={name}")).collect()
    return [json.loads(r.value) for r in lines]


def test_jobs_from_raw_messages_to_tables(spark, tmp_path):
    seconds = raw_messages(tmp_path / "raw")
    work = run(spark, tmp_path, "ingest", "--raw", str(tmp_path / "raw"))
    assert spark.read.parquet(str(tmp_path / "files/trades")).count() == len(seconds)
    letters = dead_letters_of(spark, f"{work}/trades").collect()
    assert [(r.value, r.records[0].reason) for r in letters] == [
        ("{broken", "no message of this feed")
    ]

    run(spark, tmp_path, "bars")
    minute = topic(spark, tmp_path, "bars", "analytics.sol_usd.ohlcv_1m")
    assert sorted(b["trade_count"] for b in minute) == [30, 30]
    assert len(topic(spark, tmp_path, "bars", "analytics.sol_usd.ohlcv_1s")) == 60

    run(spark, tmp_path, "peg")
    alerts = topic(spark, tmp_path, "peg", "alerts.usdc_peg")
    assert len(alerts) == len(seconds) and {a["severity"] for a in alerts} == {"CRITICAL"}

    # Quotes are stamped when they are received; these carry times that fit the prices.
    spark.read.parquet(str(tmp_path / "files/oracle")).write.parquet(str(tmp_path / "more/oracle"))
    spark.sql(
        "SELECT 'SOL-USD' AS product_id, 80D AS price, 79D + id % 3 AS best_bid, 82D AS best_ask,"
        " 2D AS best_bid_quantity, 1D AS best_ask_quantity, timestamp_seconds(1704412800 + id)"
        " AS received_at FROM (SELECT explode(sequence(0, 118)) AS id UNION ALL SELECT 3000)"
    ).write.parquet(str(tmp_path / "more/ticker"))
    run(spark, tmp_path, "imbalance", files="more")
    hops = topic(spark, tmp_path, "imbalance", "analytics.sol_usd.imbalance", files="more")
    assert {round(h["avg_imbalance"], 6) for h in hops} == {0.333333}

    run(spark, tmp_path, "spread", files="more")
    scores = topic(spark, tmp_path, "spread", "analytics.sol.cross_source_spread", files="more")
    assert len(scores) == 119 and max(s["sample_count"] for s in scores) == 100
    assert {s["pyth_price"] for s in scores} == {80.0}

    work = run(spark, tmp_path, "store", "--tables", "ohlcv_1m")
    assert stored(spark, TABLES["ohlcv_1m"], f"{work}/ohlcv_1m").count() == 2
    work = run(spark, tmp_path, "store", "--tables", "cross_source_spread", files="more")
    assert stored(
        spark, TABLES["cross_source_spread"], f"{work}/cross_source_spread"
    ).count() == len(scores)


def test_unknown_jobs_are_refused():
    with pytest.raises(SystemExit):
        jobs.parse(["nothing", "--work", "x"])
