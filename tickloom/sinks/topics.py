"""Results as messages: JSON or Avro values with key and topic columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from tickloom import schemas
from tickloom.functions.framing import framed
from tickloom.functions.text import JSON_OPTIONS, ticker_topic, trades_topic


def json_messages(
    df: DataFrame, topic: str | Column, key: str | None = None, exclude: tuple[str, ...] = ()
) -> DataFrame:
    """Columns ``key``, ``value`` (JSON text of the row) and ``topic``; NULL fields are kept."""
    fields = [c for c in df.columns if c not in exclude]
    return df.select(
        (F.lit(None) if key is None else F.col(key)).cast("string").alias("key"),
        F.to_json(F.struct(*fields), JSON_OPTIONS | {"ignoreNullFields": "false"}).alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
    )


def avro_messages(
    df: DataFrame, record: str, topic: str | Column, key: str, schema_id: int
) -> DataFrame:
    """Key, framed Avro value and topic of typed events. Needs Spark's Avro package.

    ``schema_id`` is the id under which the registry knows the record's schema.
    """
    from pyspark.sql.avro.functions import to_avro

    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
    fields = [
        F.date_format(f.name, iso).alias(f.name)
        if f.dataType.simpleString() == "timestamp"
        else F.col(f.name)
        for f in schemas.RECORDS[record].fields
    ]
    return df.select(
        F.col(key).alias("key"),
        framed(to_avro(F.struct(*fields), schemas.avro_schema(record)), schema_id).alias("value"),
        (F.lit(topic) if isinstance(topic, str) else topic).alias("topic"),
    )


def routed_trades(trades: DataFrame) -> DataFrame:
    """Trades with the topic of their product."""
    return trades.withColumn("topic", trades_topic(F.col("product_id")))


def routed_ticker(ticker: DataFrame) -> DataFrame:
    """Quotes with the topic of their product."""
    return ticker.withColumn("topic", ticker_topic(F.col("product_id")))


def write_kafka(messages: DataFrame, bootstrap_servers: str, linger_ms: int = 5) -> None:
    """Append a batch of messages to their topics."""
    messages.write.format("kafka").options(**_kafka(bootstrap_servers, linger_ms)).save()


def stream_kafka(
    messages: DataFrame, bootstrap_servers: str, checkpoint: str, linger_ms: int = 5
) -> DataStreamWriter:
    """Writer to the topics, at least once; start it with the trigger of your choice."""
    writer = messages.writeStream.format("kafka").option("checkpointLocation", checkpoint)
    return writer.options(**_kafka(bootstrap_servers, linger_ms))


def write_topic_files(messages: DataFrame, path: str) -> None:
    """Append messages to text files under ``topic=<name>/``, the file form of the topics."""
    messages.select("value", "topic").write.partitionBy("topic").mode("append").text(path)


def stream_topic_files(messages: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Writer to ``topic=<name>/`` text files, exactly once."""
    return (
        messages.select("value", "topic")
        .writeStream.format("text")
        .partitionBy("topic")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def _kafka(bootstrap_servers: str, linger_ms: int) -> dict[str, str]:
    return {"kafka.bootstrap.servers": bootstrap_servers, "kafka.linger.ms": str(linger_ms)}
