"""Sharding by a permutation-filled lookup table, in DataFrame operations alone.

Each shard has an order of preference over the slots of a prime-sized table: it starts at an offset
and goes on in steps, both hashed from its name. The shards take turns; whose turn it is claims its
most preferred free slot, until the table is full. A row's slot is a hash of its key, its shard the
owner of the slot. Shards own equally many slots but for one, and when a shard goes most slots of
the others stay theirs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import col, stage

SHARDS = 20
SLOTS = 2039  # a prime, about a hundred times the shards


def shard_names(count: int = SHARDS) -> list[str]:
    return [f"shard-{i:02d}" for i in range(count)]


def _number(text: Column) -> Column:
    """60 bits of an MD5 sum as a BIGINT."""
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def lookup_table(spark: SparkSession, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """One row whose ``owner`` is an array: the shard's number for every slot. It is written once.

    ``slots`` is a prime and bounds the array. The claims are folded one after the other over
    arrays; each looks over the table once.
    """
    if slots < 2 or any(slots % n == 0 for n in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"the table's size must be a prime, not {slots}")
    if not 0 < len(shards) <= slots or len(set(shards)) < len(shards):
        raise ValueError("give one to as many shards as there are slots, each once")
    names = F.array(*map(F.lit, shards))
    offset = F.transform(names, lambda s: F.pmod(_number(F.concat(s, F.lit(":offset"))), F.lit(slots)))
    skip = F.transform(names, lambda s: F.pmod(_number(F.concat(s, F.lit(":skip"))), F.lit(slots - 1)) + 1)
    orders = spark.range(1).select(
        offset.alias("offset"),
        skip.alias("skip"),
        F.sequence(F.lit(0), F.lit(slots - 1)).alias("turns"),
    )
    orders = stage(orders, "shard-orders")  # else the optimiser hashes the names at every claim

    def claim(owner: Column, turn: Column) -> Column:
        shard = F.pmod(turn, F.lit(len(shards)))
        start, step = F.get("offset", shard), F.get("skip", shard)
        preferred = F.transform("turns", lambda j: F.pmod(start + j * step, F.lit(slots)))
        slot = F.get(F.filter(preferred, lambda s: F.get(owner, s.cast("int")) < 0), F.lit(0))
        # as the variable of a lambda the slot is looked for once, not for every element
        claimed = F.transform(
            F.array(slot),
            lambda s: F.transform(owner, lambda o, i: F.when(i == s, shard).otherwise(o)),
        )
        return F.get(claimed, F.lit(0))

    free = F.array_repeat(F.lit(-1), slots)
    return stage(orders.select(F.aggregate("turns", free, claim).alias("owner")), "lookup-table")


def assign(
    rows: DataFrame,
    shards: list[str],
    slots: int = SLOTS,
    key_col: str = "doc_id",
    text_col: str = "text",
    slot_col: str = "slot",
    shard_col: str = "shard",
) -> DataFrame:
    """``rows`` with the slot and the shard of each row.

    A row goes by its key as text; one without a key by its text, one without either by the empty
    text. Equal keys share a slot. Nothing is shuffled: the lookup table, ``slots`` numbers, is
    handed to all tasks. Columns that already have the names of the new ones are replaced, others
    are carried along; an empty table stays empty.
    """
    built = lookup_table(rows.sparkSession, shards, slots)
    key = F.coalesce(col(key_col).cast("string"), col(text_col).cast("string"), F.lit(""))
    slot = F.pmod(_number(key), F.lit(slots)).cast("int")
    owner = F.get(built.scalar(), slot)
    return rows.withColumns({slot_col: slot, shard_col: F.get(F.array(*map(F.lit, shards)), owner)})


def write_shards(rows: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder per shard, in files of the session's advisory size however large a shard is."""
    rows.hint("rebalance", shard_col).write.mode("error").partitionBy(shard_col).parquet(path)


def placements(rows: DataFrame, shards: list[str], slots: int = SLOTS) -> DataFrame:
    """``doc_id``, ``slot`` and ``shard`` of every document."""
    docs = rows.select(col("doc_id").alias("doc_id"), col("text").alias("text"))
    return assign(docs, shards, slots).drop("text")


def placements_sql(shards: list[str], slots: int = SLOTS) -> str:
    names = ", ".join(f"'{s}'" for s in shards)

    def number(text: str) -> str:
        return f"CAST('0x' || substr(md5({text}), 1, 15) AS BIGINT)"

    return f"""
WITH RECURSIVE shards AS (SELECT [{names}] AS names),
orders AS (SELECT [{number("s || ':offset'")} % {slots} FOR s IN names] AS starts,
                  [{number("s || ':skip'")} % {slots - 1} + 1 FOR s IN names] AS steps FROM shards),
claims(turn, owner) AS (
    SELECT 0, list_transform(range({slots}), lambda x: -1)
    UNION ALL
    SELECT turn + 1, list_concat(owner[1:slot], [turn % {len(shards)}], owner[slot + 2:])
    FROM (SELECT turn, owner,
                 [s FOR s IN [(starts[turn % {len(shards)} + 1] + j * steps[turn % {len(shards)} + 1])
                              % {slots} FOR j IN range({slots})] IF owner[s + 1] < 0][1] AS slot
          FROM claims, orders WHERE turn < {slots})),
filled AS (SELECT owner FROM claims WHERE turn = {slots}),
placed AS (SELECT doc_id, CAST({number("coalesce(CAST(doc_id AS VARCHAR), text, '')")} % {slots} AS INTEGER)
                  AS slot FROM documents)
SELECT doc_id, slot, names[owner[slot + 1] + 1] AS shard FROM placed, filled, shards
"""
