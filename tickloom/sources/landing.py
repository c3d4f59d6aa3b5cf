"""JSON results read back from an analytics topic, tolerating broken messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.text import JSON_READ_OPTIONS

_CORRUPT = "_corrupt"


def read_landing(topic: DataFrame, schema: T.StructType) -> DataFrame:
    """Typed rows of a JSON topic (column ``value``) plus ``_source`` and ``_ok``.

    Fields that a message omits or sets to null take the stored type's default (0, empty text, the
    epoch), as the stored tables hold no NULLs. A message that is no JSON object, or has a value
    that does not fit its type, is not ok.
    """
    value = F.col("value").cast("string")
    fields = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, **JSON_READ_OPTIONS}
    # Exploded, so that the message is parsed once however many columns read it.
    parsed = topic.select(value.alias("_source")).withColumn(
        "m", F.explode(F.array(F.from_json("_source", fields, options)))
    )
    ok = (
        F.col("m").isNotNull() & F.col(f"m.{_CORRUPT}").isNull() & (F.trim("_source") != "")
    )
    columns = [
        F.coalesce(F.col("m")[f.name], _default(f.dataType)).alias(f.name)
        for f in schema.fields
    ]
    return parsed.select(*columns, "_source", F.coalesce(ok, F.lit(False)).alias("_ok"))


def _default(data_type: T.DataType) -> Column:
    if isinstance(data_type, T.StringType):
        return F.lit("")
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return F.timestamp_seconds(F.lit(0)).cast(data_type)
    return F.lit(0).cast(data_type)
