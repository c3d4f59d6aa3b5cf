"""Row keys, column names and staged tables that the operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.session import stage as stage

WITHOUT_ID = 1 << 62  # keys from here on belong to rows without an id


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` has them in any case."""
    taken = {c.lower() for c in df.columns}
    result = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        result.append(name)
    return result


def col(name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str) -> Column:
    return F.coalesce(col(name).cast("string"), F.lit(""))


def row_key(id_col: str, text_col: str) -> Column:
    """A BIGINT that stands for a document: its id, or for want of one a hash of its text.

    Keys made of texts are larger than any id below 2^62, so that "the smallest key" prefers rows
    that have an id.
    """
    by_text = F.lit(WITHOUT_ID) + F.shiftrightunsigned(F.xxhash64(text_of(text_col)), 2)
    return F.coalesce(col(id_col).cast("bigint"), by_text)


def id_of(key: Column) -> Column:
    """The id behind a row key, null where the row had none."""
    return F.when(key < WITHOUT_ID, key)


def hash_filter(keys: DataFrame, most_bits: int = 1 << 24) -> Callable[[Column], Column]:
    """A test that every key of the table passes, and of other values few: 16 bits a key, 3 probes.

    The filter is an array in a table of one row, which is handed to all tasks as a scalar subquery;
    ``most_bits`` bounds it. With more keys it lets more values through, none is ever refused wrongly.
    ``keys`` has one column.
    """
    name, spark = keys.columns[0], keys.sparkSession
    bits = max(64, min(most_bits, 16 * keys.count() // 64 * 64))

    def places(key: Column) -> list[Column]:
        return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(3)]

    words = (
        keys.select(F.explode(F.array(*places(col(name)))).alias("at"))
        .groupBy(F.shiftright("at", 6).alias("id"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("word"))
    )
    dense = spark.range(bits // 64).join(words, "id", "left")
    pair = F.struct("id", F.coalesce("word", F.lit(0).cast("bigint")).alias("word"))
    array = F.transform(F.sort_array(F.collect_list(pair)), lambda x: x["word"])
    table = stage(dense.agg(array.alias("words")), "hash-filter")

    def passes(key: Column) -> Column:
        result = F.lit(True)
        for at in places(key):
            word = F.get(table.scalar(), F.shiftright(at, 6).cast("int"))
            result = result & (F.getbit(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return result

    return passes


def slices(batches: Iterator[pa.RecordBatch], text_col: str, most: int = 4 << 20):
    """Cuts Arrow batches so that a piece holds about ``most`` bytes of text or one row."""
    for batch in batches:
        lengths = pc.binary_length(batch.column(text_col)).to_pylist()
        start = size = 0
        for i, n in enumerate(lengths):
            if size and size + (n or 0) > most:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n or 0
        if start < batch.num_rows:
            yield batch.slice(start)
