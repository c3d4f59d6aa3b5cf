"""Jobs of several queries: late rows over their life, failures, letters, arrival time."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tickloom.plans import jobs
from tickloom.settings import Settings
from tickloom.sources.feeds import MESSAGE, accepted, letters, read_oracle, read_ticker, read_trades
from tickloom.sources.files import stream_parquet, stream_text
from tickloom.streaming.ingest import add_once, dead_letters_of, ingest_stream, read_added
from tickloom.streaming.running import LateRows, await_all, late_rows
from tickloom.streaming.windows import stream_bars

START = 1_704_412_800
TRADES = "product_id string, trade_id string, price double, size double, time timestamp, side string"


def trade(second, number):
    at = dt.datetime.fromtimestamp(START + second)
    return ("A", str(number), 1.0, 1.0, at, "BUY")


def test_late_rows_of_many_micro_batches(spark, tmp_path):
    """Every batch moves on by 10 s and brings rows that are behind; no report is kept that long."""
    source, batches, late = str(tmp_path / "in"), 104, 0
    for i in range(batches):
        rows = [trade(10 * i + 5, 10 * i)]
        behind = i % 3 if i > 1 else 0
        rows += [trade(10 * i - 35 - j, 10 * i + 1 + j) for j in range(behind)]
        late += behind
        part = spark.createDataFrame(rows, TRADES).coalesce(1)
        part.write.mode("append").parquet(source)
    files = stream_parquet(spark, source, spark.createDataFrame([], TRADES).schema, 1)
    listener = LateRows(spark, str(tmp_path / "late"))
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    spark.streams.addListener(listener)
    try:
        bars = stream_bars(files, {"1s": 1}, lateness="1 second")
        writer = bars.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c"))
        query = writer.trigger(availableNow=True).start()
        listener.only = {str(query.id)}
        await_all(spark, [query])
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        assert len(query.recentProgress) <= 100
    finally:
        spark.streams.removeListener(listener)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    found = late_rows(spark, str(tmp_path / "late")).collect()
    assert sum(r.dropped for r in found) == late > 90
    assert {r["query"] for r in found} == {str(query.id)}
    assert late_rows(spark, str(tmp_path / "nothing")).count() == 0


def endless(spark, tmp_path, name, column):
    folder = tmp_path / name
    folder.mkdir()
    (folder / "a.txt").write_text("one")
    rows = stream_text(spark, str(folder)).select(column.alias("value"))
    writer = rows.writeStream.format("noop").option("checkpointLocation", str(tmp_path / f"c-{name}"))
    return writer.trigger(processingTime="100 milliseconds").start()


def test_a_failing_query_stops_the_others(spark, tmp_path):
    healthy = endless(spark, tmp_path, "healthy", F.col("value"))
    failing = endless(spark, tmp_path, "failing", F.raise_error(F.concat(F.lit("broke on "), "value")))
    with pytest.raises(Exception, match="broke on one"):
        await_all(spark, [healthy, failing])
    assert not healthy.isActive and not failing.isActive
    await_all(spark, [])


def test_queries_that_end_one_after_the_other(spark, tmp_path):
    queries = []
    for name, files in (("short", 1), ("long", 6)):
        folder = tmp_path / name
        folder.mkdir()
        for i in range(files):
            (folder / f"{i}.txt").write_text(f"{name} {i}")
        rows = stream_text(spark, str(folder), files_per_batch=1)
        writer = rows.writeStream.format("parquet").option("path", str(tmp_path / f"out-{name}"))
        writer = writer.option("checkpointLocation", str(tmp_path / f"c-{name}"))
        queries.append(writer.trigger(availableNow=True).start())
    await_all(spark, queries)
    assert spark.read.parquet(str(tmp_path / "out-long")).count() == 6


def message(*trades, channel="market_trades"):
    return json.dumps({"channel": channel, "events": [{"type": "update", "trades": list(trades)}]})


def one(number, **changes):
    record = {"product_id": "SOL-USD", "trade_id": str(number), "price": "80", "size": "1",
              "time": "2024-01-05T00:00:00Z", "side": "BUY"}
    return record | changes


MESSAGES = [
    message(one(1), one(2, price="dear"), one(3), one(4, size=None, time="noon")),
    "{broken",
    message(one(5)),
    "{broken",
    message(one(6, price="x")),
    message(one(7, price="x"), channel="heartbeats"),
]


def test_letters(spark):
    raw = spark.createDataFrame([(m, i) for i, m in enumerate(MESSAGES)], f"value string, {MESSAGE} int")
    records = read_trades(raw)
    found = sorted((r.value, [(x["index"], x.reason) for x in r.records]) for r in letters(records).collect())
    broken = ("{broken", [("", "no message of this feed")])
    assert found == sorted([
        (MESSAGES[0], [("0.1", "no readable price"), ("0.3", "no readable size, time")]),
        broken,
        broken,
        (MESSAGES[4], [("0.0", "no readable price")]),
    ])
    assert sorted(r.trade_id for r in accepted(records).collect()) == ["1", "3", "5"]
    oracle = [json.dumps({"parsed": [{"id": "a", "price": {"price": "x"}}]})]
    raw = spark.createDataFrame([(f"data: {m}", 0) for m in oracle], raw.schema)
    assert [x["index"] for r in letters(read_oracle(raw)).collect() for x in r.records] == ["0"]
    assert letters(read_ticker(raw.where("false"))).collect() == []


def test_messages_are_read_once(spark, tmp_path):
    folder, out = tmp_path / "raw", str(tmp_path / "typed")
    folder.mkdir()
    for i, m in enumerate(MESSAGES):
        (folder / f"{i}.txt").write_text(m)

    def ingest(checkpoint):
        writer = ingest_stream(
            stream_text(spark, str(folder), 2), read_trades, str(tmp_path / "work"),
            lambda rows, batch_id: add_once(rows, out, batch_id),
        )
        writer = writer.option("checkpointLocation", str(tmp_path / checkpoint))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()
        return query

    query = ingest("c")
    assert sum(p.numInputRows for p in query.recentProgress) == len(MESSAGES)
    schema = accepted(read_trades(spark.createDataFrame([], "value string"))).schema
    first = sorted(r.trade_id for r in read_added(spark, out, schema).collect())
    assert first == ["1", "3", "5"]
    assert dead_letters_of(spark, str(tmp_path / "work")).count() == 4
    files = {f: f.stat().st_mtime_ns for f in (tmp_path / "typed").rglob("*.parquet")}
    ingest("c2")  # every batch again: the typed rows stay the same files, no letter comes twice
    assert files == {f: f.stat().st_mtime_ns for f in (tmp_path / "typed").rglob("*.parquet")}
    assert dead_letters_of(spark, str(tmp_path / "work")).count() == 4


def test_bars_by_arrival(spark, tmp_path):
    """Event times years apart that arrived together make one bar."""
    rows = [trade(0, 1), trade(90_000_000, 2), trade(5, 3)]
    folder = tmp_path / "files/trades"
    spark.createDataFrame(rows, TRADES).coalesce(1).write.parquet(str(folder))
    closing = tmp_path / "closing"
    spark.createDataFrame([trade(0, 4)], TRADES).coalesce(1).write.parquet(str(closing))
    import os

    for where, second in ((folder, START), (closing, START + 3600)):
        for f in where.glob("*.parquet"):
            os.utime(f, (second, second))
            if where is closing:
                (folder / f"z-{f.name}").symlink_to(f)
    args = jobs.parse(["bars", "--work", str(tmp_path / "work"), "--files", str(tmp_path / "files"),
                       "--once", "--arrival-time"])
    await_all(spark, jobs.start(spark, args, Settings()))
    lines = spark.read.text(str(tmp_path / "files/topics/bars/topic=analytics.sol_usd.ohlcv_1m"))
    assert [json.loads(r.value)["trade_count"] for r in lines.collect()] == [3]
