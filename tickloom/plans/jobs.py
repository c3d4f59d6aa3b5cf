"""The streaming jobs as commands.

    spark-submit --packages <kafka and avro packages> run_job.py bars --work /shared/bars

Jobs read and write Kafka topics. With ``--files DIR`` they read typed Parquet files from
``DIR/trades``, ``DIR/ticker`` and ``DIR/oracle`` instead, and write text files under
``DIR/topics/<job>/topic=<name>``. Each job keeps its offsets and state below ``--work``.
"""

from __future__ import annotations

import argparse
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tickloom import schemas, settings
from tickloom.operators.spread import spread_records
from tickloom.session import build_session
from tickloom.settings import Settings
from tickloom.sinks.tables import TABLES
from tickloom.sinks.topics import (
    avro_messages,
    json_messages,
    routed_ticker,
    routed_trades,
    stream_kafka,
    stream_topic_files,
    write_kafka,
    write_topic_files,
)
from tickloom.sources.feeds import (
    accepted,
    dead_letters,
    known_feeds,
    priced_products,
    read_oracle,
    read_ticker,
    read_trades,
)
from tickloom.sources.files import stream_parquet, stream_text, stream_topic_text
from tickloom.sources.kafka import decode_avro, stream_topic
from tickloom.streaming.ingest import add_once, ingest_stream
from tickloom.streaming.running import LateRows, await_all
from tickloom.streaming.spread import held_spread, live_spread
from tickloom.streaming.store import compact, store_stream
from tickloom.streaming.windows import (
    bar_messages,
    imbalance_messages,
    peg_messages,
    stream_bars,
    stream_imbalance,
)

STORED_TOPICS = {
    **{f"ohlcv_{label}": settings.BARS_TOPIC.format(label=label) for label in settings.BAR_SIZES},
    "cross_source_spread": settings.SPREAD_TOPIC,
    "imbalance": settings.IMBALANCE_TOPIC,
    "usdc_peg_alerts": settings.PEG_TOPIC,
}
TOPIC_JOBS = {
    **{settings.BARS_TOPIC.format(label=label): "bars" for label in settings.BAR_SIZES},
    settings.SPREAD_TOPIC: "spread",
    settings.IMBALANCE_TOPIC: "imbalance",
    settings.PEG_TOPIC: "peg",
}
EVENT_TIME = {"trade": "time", "ticker": "received_at", "oracle": "publish_time"}
AVRO = {"trades": ("trade", "product_id"), "ticker": ("ticker", "product_id"),
        "oracle": ("oracle", "feed_id")}
QUOTE = ["product_id", "best_bid", "best_ask"]
PRICE = ["feed_id", "price_raw", "expo"]
JOBS = ("bars", "imbalance", "spread", "peg", "store", "ingest", "compact")


class Topics:
    """Where typed records come from and messages go: Kafka, or files below a directory."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace, config: Settings):
        self.spark, self.args, self.config = spark, args, config
        self.folder = f"{args.files}/topics/{args.job}"
        self.undecodable: list[DataStreamWriter] = []  # queries beside the job's own

    def records(self, record: str, topic: str, columns: Sequence[str]) -> DataFrame:
        """``columns`` with ``event_time`` and the unique ``partition`` and ``offset``."""
        time_col = EVENT_TIME[record]
        columns = [*columns, time_col]
        if self.args.files:
            folder = "trades" if record == "trade" else record
            path = f"{self.args.files}/{folder}"
            rows = stream_parquet(self.spark, path, schemas.RECORDS[record]).select(
                *columns,
                F.col("_metadata.file_path").alias("partition"),
                F.col("_metadata.row_index").alias("offset"),
                # the nearest that a file has to the time at which a broker got a message
                F.col("_metadata.file_modification_time").alias("arrived_at"),
            )
        else:
            servers = self.config.bootstrap_servers
            raw = stream_topic(
                self.spark, servers, topic, start=self.args.start, group=self.args.group
            )
            decoded = decode_avro(raw, record, columns, self.args.writer_schema.get(record))
            rows = accepted(decoded)
            letters = dead_letters(decoded).writeStream.format("parquet")
            self.undecodable.append(
                letters.option("path", f"{self.args.work}/undecodable/{record}").option(
                    "checkpointLocation", f"{self.args.work}/checkpoint/undecodable-{record}"
                )
            )
        if self.args.arrival_time:
            return rows.withColumn("event_time", F.col("arrived_at"))
        at = F.col(time_col)
        return rows.withColumn(
            "event_time", F.timestamp_seconds(at) if time_col == "publish_time" else at
        )

    def text(self, topic: str) -> DataFrame:
        if self.args.files:
            return stream_topic_text(
                self.spark, f"{self.args.files}/topics/{TOPIC_JOBS[topic]}", topic
            )
        return stream_topic(
            self.spark, self.config.bootstrap_servers, topic, start=self.args.start
        )

    def write(self, messages: DataFrame, checkpoint: str) -> DataStreamWriter:
        if self.args.files:
            return stream_topic_files(messages, self.folder, checkpoint)
        return stream_kafka(messages, self.config.bootstrap_servers, checkpoint)

    def publish(self, messages: DataFrame) -> None:
        if self.args.files:
            write_topic_files(messages, self.folder)
        else:
            write_kafka(messages, self.config.bootstrap_servers)


def writers(
    spark: SparkSession, args: argparse.Namespace, config: Settings
) -> list[DataStreamWriter]:
    """The job's queries, ready to start; on Kafka also those that keep undecodable messages."""
    topics = Topics(spark, args, config)
    return _own_writers(spark, topics, args, config) + topics.undecodable


def _own_writers(
    spark: SparkSession, topics: Topics, args: argparse.Namespace, config: Settings
) -> list[DataStreamWriter]:
    checkpoint = f"{args.work}/checkpoint"
    if args.job == "bars":
        columns = ["product_id", "trade_id", "price", "size"]
        trades = topics.records("trade", settings.TRADES_TOPIC, columns)
        bars = stream_bars(trades, lateness=args.lateness, time_col="event_time")
        return [topics.write(bar_messages(bars), checkpoint)]
    if args.job == "imbalance":
        columns = [*QUOTE, "best_bid_quantity", "best_ask_quantity"]
        ticks = topics.records("ticker", settings.TICKER_TOPIC, columns)
        rows = stream_imbalance(ticks, lateness=args.lateness, time_col="event_time")
        return [topics.write(imbalance_messages(rows), checkpoint)]
    if args.job == "peg":
        prices = topics.records("oracle", settings.USDC_ORACLE_TOPIC, PRICE)
        if args.files:  # one folder holds the prices of all feeds; a topic holds one feed's
            feeds = [f for f, t in config.feed_topics.items() if t == settings.USDC_ORACLE_TOPIC]
            prices = prices.where(F.col("feed_id").isin(feeds))
        return [topics.write(peg_messages(prices, config.peg_threshold), checkpoint)]
    if args.job == "spread":
        return [_spread(topics, args, config).option("checkpointLocation", checkpoint)]
    if args.job == "store":
        return [
            store_stream(topics.text(topic), TABLES[name], f"{args.work}/{name}")
            .option("checkpointLocation", f"{checkpoint}/{name}")
            for name, topic in STORED_TOPICS.items()
            if name in args.tables
        ]
    return _ingest(spark, topics, args, config)


def _spread(topics: Topics, args: argparse.Namespace, config: Settings) -> DataStreamWriter:
    ticks = topics.records("ticker", settings.TICKER_TOPIC, QUOTE).select(
        F.col("product_id").alias("symbol"),
        F.col("event_time").alias("ts"),
        "partition",
        "offset",
        "best_bid",
        "best_ask",
    )
    oracle = priced_products(
        topics.records("oracle", settings.SOL_ORACLE_TOPIC, PRICE), config.feed_products
    ).withColumnRenamed("event_time", "ts")
    message_id = ["partition", "offset"]

    def publish(scored: DataFrame) -> None:
        topics.publish(json_messages(spread_records(scored, with_symbol=True), settings.SPREAD_TOPIC))

    path = f"{args.work}/spread"
    options = {
        "tick_id": message_id, "oracle_id": message_id, "max_age_s": config.max_age_s,
        "rows": config.zscore_rows, "publish": publish, "slots_per_s": args.slots_per_s,
    }
    if args.live:
        return live_spread(ticks, oracle, path, slack_s=args.slack_s, **options)
    return held_spread(ticks, oracle, path, lateness_s=_seconds(args.lateness), **options)


def _seconds(interval: str) -> int:
    """Whole seconds of an interval such as '10 seconds' or '1 minute', rounded up."""
    spark = SparkSession.active()
    micros = spark.sql(
        "SELECT unix_micros(TIMESTAMP_LTZ '2000-01-01 00:00:00Z' + CAST(:interval AS INTERVAL))"
        " - unix_micros(TIMESTAMP_LTZ '2000-01-01 00:00:00Z')",
        args={"interval": interval},
    ).first()[0]
    return -(-micros // 1_000_000)


def _ingest(
    spark: SparkSession, topics: Topics, args: argparse.Namespace, config: Settings
) -> list[DataStreamWriter]:
    """Captured raw messages in ``--raw DIR/<feed>`` to typed records, the rest to dead letters.

    One query per feed reads and parses each message once.
    """
    readers = {"trades": read_trades, "ticker": read_ticker, "oracle": read_oracle}

    def to_files(feed: str) -> Callable[[DataFrame, int], None]:
        return lambda typed, batch_id: add_once(_routed(feed, typed, config).drop("topic"),
                                                f"{args.files}/{feed}", batch_id)

    def to_kafka(feed: str) -> Callable[[DataFrame, int], None]:
        record, key = AVRO[feed]
        return lambda typed, _: topics.publish(
            _avro(_routed(feed, typed, config), record, key, args)
        )

    queries = []
    for feed, read in readers.items():
        publish = to_files(feed) if args.files else to_kafka(feed)
        raw = stream_text(spark, f"{args.raw}/{feed}")
        writer = ingest_stream(raw, read, f"{args.work}/{feed}", publish)
        queries.append(writer.option("checkpointLocation", f"{args.work}/checkpoint/{feed}"))
    return queries


def _routed(feed: str, typed: DataFrame, config: Settings) -> DataFrame:
    """Records with the ``topic`` they belong to; prices of feeds that are not followed are dropped."""
    if feed == "oracle":
        return known_feeds(typed, config.feed_topics)
    return routed_ticker(typed) if feed == "ticker" else routed_trades(typed)


def _avro(routed: DataFrame, record: str, key: str, args: argparse.Namespace) -> DataFrame:
    return avro_messages(routed, record, F.col("topic"), key, args.schema_ids[record])


def parse(argv: Sequence[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--work", required=True, help="shared folder for state and results")
    parser.add_argument("--files", help="use files below this folder instead of Kafka")
    parser.add_argument("--raw", help="folder of captured raw messages, for ingest")
    parser.add_argument(
        "--schema-ids", type=json.loads, default={"trade": 1, "ticker": 2, "oracle": 3},
        help="ingest to Kafka: the registry's schema ids as JSON, by record",
    )
    parser.add_argument("--start", default="latest", choices=("latest", "earliest"))
    parser.add_argument("--lateness", default="10 seconds", help="watermark delay")
    parser.add_argument(
        "--arrival-time", action="store_true",
        help="event time is when a message arrived: Kafka's time, or that of its file",
    )
    parser.add_argument("--group", help="Kafka consumer group, a label only")
    parser.add_argument(
        "--writer-schema", type=json.loads, default={},
        help="Avro schemas that values were written with, as JSON by record",
    )
    parser.add_argument(
        "--live", action="store_true", help="spread: score ticks as they arrive, no watermark"
    )
    parser.add_argument(
        "--slots-per-s", type=int, help="spread: slots of the oracle's history, else as it needs"
    )
    parser.add_argument(
        "--slack-s", type=int, default=60,
        help="spread --live: how far a tick may lie behind the newest and surely find its price",
    )
    parser.add_argument("--tables", nargs="+", default=list(STORED_TOPICS), help="for store and compact")
    parser.add_argument("--every", help="interval of the micro-batches, such as '1 minute'")
    parser.add_argument("--once", action="store_true", help="handle what is there, then stop")
    return parser.parse_args(argv)


def start(
    spark: SparkSession, args: argparse.Namespace, config: Settings | None = None
) -> list[StreamingQuery]:
    """Start the job's queries and return at once; ``late_rows`` below ``--work`` counts what they drop."""
    ready = writers(spark, args, config or Settings.from_env())
    if args.once:
        ready = [writer.trigger(availableNow=True) for writer in ready]
    elif args.every:
        ready = [writer.trigger(processingTime=args.every) for writer in ready]
    listener = LateRows(spark, f"{args.work}/late_rows")
    spark.streams.addListener(listener)
    queries = [writer.start() for writer in ready]
    listener.only = {str(query.id) for query in queries}
    return queries


def main(argv: Sequence[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"tickloom-{args.job}")
    if args.job == "compact":  # a batch job, to be run now and then
        for name in args.tables:
            compact(spark, TABLES[name], f"{args.work}/{name}")
        return
    await_all(spark, start(spark, args))
