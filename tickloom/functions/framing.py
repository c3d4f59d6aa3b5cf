"""Registry framing of message bytes: a zero byte, a four-byte schema id, then the body."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: one magic byte and four bytes of schema id.
HEADER_BYTES = 5


def framed(body: Column, schema_id: int) -> Column:
    """BINARY body behind its header; the id is written big-endian."""
    header = bytes([0]) + schema_id.to_bytes(4, "big")
    return F.concat(F.lit(bytearray(header)), body)


def is_framed(value: Column) -> Column:
    return (F.length(value) >= HEADER_BYTES) & (F.hex(F.substring(value, 1, 1)) == "00")


def frame_id(value: Column) -> Column:
    """The schema id of a framed value as BIGINT, null for any other value."""
    return F.when(is_framed(value), F.conv(F.hex(F.substring(value, 2, 4)), 16, 10).cast("bigint"))


def unframed(value: Column) -> Column:
    """The body of a framed value, null for any other value."""
    rest = F.substring(value, F.lit(HEADER_BYTES + 1), F.length(value))
    return F.when(is_framed(value), rest)
