"""Near-duplicates by 64-bit similarity fingerprints, compared exactly in tiles.

Fingerprints within ``radius`` bits of each other agree in at least one of ``radius + 1`` parts of
their bits. Every distinct fingerprint therefore appears once per part, sorted by (part, value of
the part, number of set bits); the sorted rows are cut into tiles. Two tiles are compared, with
numpy exclusive-or and bit counts, only if they share a value of a part and the numbers of set bits
of their rows come within the radius. A comparison returns not the linked pairs but one link per row
to the least row it reaches, so that thousands of near copies give thousands of links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, fresh, id_of, row_key, slices, stage, text_of
from tickloom.llm.components import components

SEED = 42
HASHES_AT_ONCE = 1 << 16
_BITS_OF_BYTE = np.unpackbits(
    np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"
).astype(np.int64)


def fingerprint(text: str, shingle: int = 3) -> int:
    """The fingerprint of a text: bit i is set if more than half of its shingles' hashes have it.

    Words are what lies between white space (ASCII), A-Z counting as a-z; a shingle is ``shingle``
    words with spaces between them, repeats included. A text of fewer words is one shingle; one
    without words has fingerprint 0.
    """
    from xxhash import xxh64_intdigest

    words = text.encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams, n = iter([b" ".join(words)]), 1
    else:
        shifted = [islice(words, i, None) for i in range(shingle)]
        grams, n = map(b" ".join, zip(*shifted)), len(words) - shingle + 1
    counts = np.zeros((8, 8), np.int64)
    for begin in range(0, n, HASHES_AT_ONCE):
        size = min(HASHES_AT_ONCE, n - begin)
        hashes = np.fromiter(
            map(xxh64_intdigest, islice(grams, size), repeat(SEED)), "<u8", size
        )
        octets = hashes.view(np.uint8).reshape(size, 8)
        for k in range(8):
            counts[k] += np.bincount(octets[:, k], minlength=256) @ _BITS_OF_BYTE
    set_bits = np.packbits((2 * counts > n).reshape(64), bitorder="little")
    return int(set_bits.view("<i8")[0])


def fingerprints(
    docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``key``, ``mark`` (a hash of the text) and ``fp`` of every row; null texts count as empty ones."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            known: dict[str, int] = {}
            out = []
            for text in batch.column("text").to_pylist():
                if text not in known:
                    known[text] = fingerprint(text, shingle)
                out.append(known[text])
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("mark"), pa.array(out, pa.int64())],
                names=["key", "mark", "fp"],
            )

    text = text_of(text_col)
    rows = docs.select(
        row_key(id_col, text_col).alias("key"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    return rows.mapInArrow(scan, "key bigint, mark bigint, fp bigint")


TILE_ROWS = "a bigint, b bigint, part int, value bigint, tile bigint, lo int, hi int, fps binary"


def _reach(near: np.ndarray) -> np.ndarray:
    """For each row of a symmetric link matrix, the first row it reaches by links."""
    n = len(near)
    first = np.arange(n)
    linked = np.flatnonzero(near.sum(axis=1) > 1)
    if not len(linked):
        return first
    sub = near[np.ix_(linked, linked)]
    label = np.arange(len(linked))
    while True:
        least = np.where(sub, label[None, :], len(linked)).min(axis=1)
        least = label[least]
        if (least == label).all():
            break
        label = least
    first[linked] = linked[label]
    return first


def _links(x: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all rows of ``x`` that a chain of near pairs connects."""
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    first = _reach(near)
    own = np.flatnonzero((first != np.arange(len(x))) & (x != x[first]))
    return x[own], x[first[own]]


def _cross_links(x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """The same for pairs that have one row in ``x`` and one in ``y``."""
    near = np.bitwise_count(x[:, None] ^ y[None, :]) <= radius
    rows, columns = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
    if not len(rows):
        return x[:0], x[:0]
    near = near[np.ix_(rows, columns)]
    n, m = near.shape
    both = np.zeros((n + m, n + m), bool)
    both[:n, n:], both[n:, :n] = near, near.T
    np.fill_diagonal(both, True)
    z = np.concatenate([x[rows], y[columns]])
    first = _reach(both)
    own = np.flatnonzero((first != np.arange(n + m)) & (z != z[first]))
    return z[own], z[first[own]]


def _rows(links: list, ends: list) -> pa.RecordBatch:
    """Links, and the rows of tiles that may share a value with another tile, as one batch."""
    a = np.concatenate([x for x, _ in links]) if links else np.empty(0, np.uint64)
    b = np.concatenate([x for _, x in links]) if links else np.empty(0, np.uint64)
    none, n = [None] * len(ends), len(a)
    columns = [a.view(np.int64).tolist() + none, b.view(np.int64).tolist() + none]
    for i in range(6):
        columns.append([None] * n + [x[i] for x in ends])
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int32()]
    arrays = [pa.array(c, k) for c, k in zip(columns, [*kinds, pa.binary()])]
    names = ["a", "b", "part", "value", "tile", "lo", "hi", "fps"]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _cut_tiles(tile: int, radius: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[np.ndarray] = []

        def compare(rows: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            part, value, bits, fp = rows
            x = np.unique(fp).view(np.uint64)
            ends = []
            for p, v in dict.fromkeys([(part[0], value[0]), (part[-1], value[-1])]):
                mine = np.flatnonzero((part == p) & (value == v))
                ends.append(
                    (int(p), int(v), number, int(bits[mine[0]]), int(bits[mine[-1]]),
                     fp[mine].tobytes())
                )
            number += 1
            return _rows([_links(x, radius)], ends)

        for batch in batches:
            held.append(
                np.stack([
                    batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                    for c in ("part", "value", "bits", "fp")
                ])
            )
            if sum(x.shape[1] for x in held) >= tile:
                rows = np.concatenate(held, axis=1)
                whole = rows.shape[1] // tile * tile
                for i in range(0, whole, tile):
                    yield compare(rows[:, i : i + tile])
                held = [rows[:, whole:]]
        if held and (rows := np.concatenate(held, axis=1)).shape[1]:
            yield compare(rows)

    return cut


def _compare_tiles(radius: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            links = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                links.append(
                    _cross_links(np.frombuffer(x, "<u8"), np.frombuffer(y, "<u8"), radius)
                )
            yield _rows(links, []).select(["a", "b"])

    return compare


def near_links(fps: DataFrame, radius: int = 3, tile: int = 1024) -> DataFrame:
    """Edges ``a``, ``b`` between distinct fingerprints ``fp``.

    They connect exactly the fingerprints that a chain of pairs of at most ``radius`` differing bits
    connects. Nulls say nothing.
    """
    parts = radius + 1
    bounds = [64 * i // parts for i in range(parts + 1)]
    copies = F.array(*[
        F.struct(
            F.lit(i).alias("part"),
            F.shiftrightunsigned("fp", low)
            .bitwiseAND((1 << (high - low)) - 1 if high - low < 64 else -1)
            .alias("value"),
        )
        for i, (low, high) in enumerate(zip(bounds, bounds[1:]))
    ])
    rows = (
        fps.where("fp IS NOT NULL")
        .select("fp", F.bit_count("fp").alias("bits"), F.explode(copies).alias("at"))
        .select("at.part", "at.value", "bits", "fp")
    )
    order = ["part", "value", "bits", "fp"]
    cut = stage(
        rows.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(_cut_tiles(tile, radius), TILE_ROWS),
        "tiles",
    )
    within = cut.where("a IS NOT NULL").select("a", "b")
    ends = cut.where("tile IS NOT NULL").drop("a", "b")
    left, right = ends.alias("l"), ends.alias("r")
    pairs = (
        left.join(right, ["part", "value"])
        .where(f"l.tile < r.tile AND r.lo - l.hi <= {radius} AND l.lo - r.hi <= {radius}")
        .select(F.col("l.fps").alias("x"), F.col("r.fps").alias("y"))
    )
    across = pairs.mapInArrow(_compare_tiles(radius), "a bigint, b bigint")
    return within.unionByName(across)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``doc_id``, ``fp`` and the group it belongs to.

    Documents whose fingerprints differ in at most ``radius`` bits are linked; ``component_key`` is
    the least key that links reach and ``component_id`` the id behind it. Keys are the ids, which
    must be below 2^62; a row without an id has a key made of its text, larger than any id, so
    ``component_id`` is null only where no document of the group has an id. Texts without words,
    null ones included, share fingerprint 0. Repeated rows stay rows; an empty table gives none;
    other columns are not read.
    """
    found = _grouped(docs, shingle, radius, id_col, text_col)
    return found.select(
        "key",
        id_of(F.col("key")).alias("doc_id"),
        "fp",
        "component_key",
        id_of(F.col("component_key")).alias("component_id"),
    )


def _grouped(
    docs: DataFrame, shingle: int, radius: int, id_col: str, text_col: str
) -> DataFrame:
    """``key``, ``mark``, ``fp``, ``root`` (which names the group) and ``component_key`` of every row."""
    found = stage(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    firsts = stage(found.groupBy("fp").agg(F.min("key").alias("first")), "distinct-fingerprints")
    roots = components(near_links(firsts, radius)).select(F.col("node").alias("fp"), "root")
    rooted = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    groups = rooted.groupBy("root").agg(F.min("first").alias("component_key"))
    member = rooted.join(groups, "root").select("fp", "root", "component_key")
    return found.join(member, "fp").select("key", "mark", "fp", "root", "component_key")


def keep_one(
    docs: DataFrame,
    shingle: int = 3,
    radius: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the smallest id.

    Rows that repeat an id are told apart by their texts: each group keeps a row, and of rows with
    that id and text any one.
    """
    key, mark = fresh(docs, "key", "mark")
    groups = _grouped(docs, shingle, radius, id_col, text_col).where("key = component_key")
    # in a group, rows of its least key may hold several texts
    kept = groups.groupBy("root", F.col("key").alias(key)).agg(F.min("mark").alias(mark))
    rows = docs.withColumns(
        {key: row_key(id_col, text_col), mark: F.xxhash64(text_of(text_col))}
    )
    one = rows.join(kept.select(key, mark), [key, mark], "left_semi").dropDuplicates([key, mark])
    return one.drop(key, mark)


def hex_digits(fp: str) -> Column:
    return F.lpad(F.lower(F.hex(col(fp))), 16, "0")
