"""Kafka topics as sources. Needs Spark's Kafka (and for Avro its Avro) package on the classpath.

Neither package is present where this repository is tested, so these thin wrappers are not run
there; everything behind them takes plain DataFrames.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom import schemas
from tickloom.functions.framing import unframed
from tickloom.functions.text import iso_time

_ISO_FIELDS = {"trade": "time", "ticker": "received_at"}


def topic_options(
    bootstrap_servers: str, topic: str, *, start: str = "latest", group: str | None = None
) -> dict[str, str]:
    """Reader options; live jobs start at ``latest``, replays at ``earliest``.

    Every query keeps its own offsets in its checkpoint; ``group`` only labels the consumer.
    """
    options = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group is not None:
        options["kafka.group.id"] = group
    return options


def stream_topic(spark: SparkSession, bootstrap_servers: str, topic: str, **options) -> DataFrame:
    reader = spark.readStream.format("kafka")
    return reader.options(**topic_options(bootstrap_servers, topic, **options)).load()


def replay_topic(spark: SparkSession, bootstrap_servers: str, topic: str) -> DataFrame:
    """The whole retained topic as a batch."""
    options = topic_options(bootstrap_servers, topic, start="earliest")
    return spark.read.format("kafka").options(**options).load()


def decode_avro(
    messages: DataFrame,
    record: str,
    columns: Sequence[str] = (),
    writer_schema: str | None = None,
) -> DataFrame:
    """Registry-framed Avro values to typed columns; with ``columns`` only those are decoded.

    ``arrived_at`` is the Kafka timestamp, for jobs that want arrival time as event time;
    ``partition`` and ``offset`` identify the message. ``writer_schema`` is the Avro text the
    values were written with, where it has gained fields since. A value that is not framed or does
    not decode gives a row with ``_ok`` false and its bytes in ``_source``, see
    ``tickloom.sources.feeds.accepted`` and ``dead_letters``.
    """
    from pyspark.sql.avro.functions import from_avro

    reader = {"mode": "PERMISSIVE"}
    if columns or writer_schema:
        reader["avroSchema"] = schemas.avro_schema(record, columns)
    written = writer_schema or schemas.avro_schema(record)
    names = [f.name for f in schemas.RECORDS[record].fields if not columns or f.name in columns]
    required = [n for n in names if n not in schemas.OPTIONAL_TICKER_FIELDS]
    ok = F.col("r").isNotNull()
    for name in required:  # a value that does not decode has no fields
        ok = ok & F.col(f"r.{name}").isNotNull()
    decoded = messages.select(
        F.col("timestamp").alias("arrived_at"),
        "partition",
        "offset",
        F.col("value").alias("_source"),
        from_avro(unframed(F.col("value")), written, reader).alias("r"),
    ).select("arrived_at", "partition", "offset", "r.*", "_source", ok.alias("_ok"))
    iso = _ISO_FIELDS.get(record)
    return decoded.withColumn(iso, iso_time(F.col(iso))) if iso in decoded.columns else decoded
