"""What the two trained operators share: a bounded sample of labelled rows, and one training task."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col

_GRAIN = 1 << 30
MOST_LABELS = 1000  # labels that are learnt, the commonest if there are more
LONGEST = 200_000  # characters of a text to learn from


def fold(id_col: str) -> Column:
    """The held-out fold of a document: CRC-32 of its id as text, modulo 3; null without an id."""
    return F.crc32(col(id_col).cast("string").cast("binary")) % 3


def held_out(id_col: str) -> Column:
    return F.coalesce(fold(id_col) == 1, F.lit(False))


def _level(counts: list[int], most: int) -> int:
    """The bound for each label at which a sample has at most ``most`` rows in all."""
    left = most
    for i, n in enumerate(sorted(counts)):
        share = left // (len(counts) - i)
        if n > share:
            return share
        left -= n
    return max(counts, default=0)


def bounded(labelled: DataFrame, label: str, key: str, text: str, most: int) -> DataFrame:
    """Distinct texts of each label, with their least key, in about ``most`` rows at most.

    Labels share these evenly, and what a rare one leaves goes to the others. A label's texts are
    those with the least hashes, so a text takes one place however often it is repeated. Of more
    than MOST_LABELS labels only the commonest are learnt. Callers leave out texts of more than
    LONGEST characters, so what one task gets is bounded in rows and in bytes. ``text`` may be a
    hash of the text.
    """
    known = labelled.where(col(label).isNotNull())
    grain = F.pmod(F.xxhash64(F.lit("sample"), text), F.lit(_GRAIN))
    count = F.approx_count_distinct(F.xxhash64(text), 0.02).alias("n")
    common = known.groupBy(label).agg(count).orderBy(F.desc("n"), label).limit(MOST_LABELS)
    counts = {row[label]: row["n"] for row in common.collect()}
    level = _level(list(counts.values()), most)
    cut = {name: max(1, int(_GRAIN * min(1, level / n))) for name, n in counts.items()}
    if not cut:
        return known.where("false").select(label, text, key)
    bounds = F.create_map(*(F.lit(x) for pair in cut.items() for x in pair))
    chosen = known.where(grain < F.coalesce(F.try_element_at(bounds, label), F.lit(0)))
    return chosen.groupBy(label, text).agg(F.min(key).alias(key))


def train(
    examples: DataFrame, learn: Callable[[list[dict]], bytes | None], order: list[str]
) -> bytes | None:
    """What ``learn`` makes of a bounded table's rows, in one task; the rows come in a fixed order.

    The result is None if there are no rows.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in batch.to_pylist()]
        rows.sort(key=lambda row: tuple(row[c] for c in order))
        model = learn(rows) if rows else None
        if model is not None:
            yield pa.RecordBatch.from_arrays([pa.array([model], pa.binary())], names=["model"])

    found = examples.repartition(1).mapInArrow(task, "model binary").first()
    return bytes(found["model"]) if found else None
