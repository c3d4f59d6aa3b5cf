"""Benchmark decontamination by spaced seeds: passages are found although words were substituted.

A seed takes ten consecutive words and hashes the five that its mask selects. The six masks are
chosen so that any two of the ten positions are ignored together by at least one of them; a stretch
of ten words with up to two substituted words thus still shares a seed. Seeds of all documents are
tried against a bitmap of the benchmark's seeds, whose size is bounded; those that pass are joined
with the seeds themselves, and around every joint seed the words are compared one by one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import fresh, id_of, row_key, slices, stage, text_of

SPAN = 10
# The positions that each mask selects.
MASKS = (
    (2, 6, 7, 8, 9),
    (0, 3, 4, 5, 9),
    (0, 1, 5, 6, 8),
    (1, 3, 4, 8, 9),
    (2, 3, 4, 6, 7),
    (0, 1, 2, 5, 7),
)
SHORTEST = 3  # words; a shorter item is no evidence of anything and is not sought
VERBATIM = 4  # items of so many words at most are sought word for word
SIMILARITY = 0.8
PROBES = 3  # each from other bits of the seed
MOST_BITS = 1 << 26  # of the bitmap, 8 MB; a fuller bitmap lets more seeds through to the join
BITS_PER_SEED = 256
AT_ONCE = 1 << 15  # words of several texts whose seeds are made together

_WORD = re.compile(r"\w+")
# ASCII letters in lower case, digits and underscores as they are, spaces for other signs
_ASCII_WORDS = bytes(
    ord(chr(i).lower()) if i < 128 and (chr(i).isalnum() or chr(i) == "_") else 32 for i in range(256)
)
# Scripts without spaces between words, from Thai and Lao to Han; each of their signs is a word.
_SIGNS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_SIGN = re.compile(f"[{_SIGNS}]")
_WORD_OR_SIGN = re.compile(f"[{_SIGNS}]|[^\\W{_SIGNS}]+")
_ODD = np.uint64(0x9E3779B97F4A7C15)


def word_hashes(text: str) -> np.ndarray:
    """A 64-bit hash of every word of a text, letters in lower case."""
    from xxhash import xxh64_intdigest

    if text.isascii():
        words = text.encode().translate(_ASCII_WORDS).split()  # the same words, sooner
    else:
        text = text.lower()
        words = (_WORD_OR_SIGN if _SIGN.search(text) else _WORD).findall(text)
    return np.fromiter(map(xxh64_intdigest, words), np.uint64, len(words))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= _ODD
    x ^= x >> np.uint64(29)
    return x


def _selected(words: np.ndarray, mask: tuple[int, ...], salt: int) -> np.ndarray:
    n = len(words) - max(mask)
    total = np.full(n, salt, np.uint64)
    for offset in mask:
        total *= _ODD
        total += words[offset : offset + n]
    return _mixed(total)


def seeds(words: np.ndarray, short: tuple[int, ...] = ()) -> Iterator[np.ndarray]:
    """The seeds of a text, one array per mask, entry i beginning at word i.

    ``short`` are the lengths of items that have fewer than SPAN words. Their masks cover the whole
    item: all words up to VERBATIM, else three masks that each ignore a third of the positions, so
    that one of them misses a substituted word.
    """
    for salt, mask in enumerate(MASKS):
        if len(words) >= SPAN:
            yield _selected(words, mask, salt)[: len(words) - SPAN + 1]
    for length in short:
        if len(words) >= length:
            for third in range(3) if length > VERBATIM else [3]:
                mask = tuple(i for i in range(length) if i % 3 != third)
                yield _selected(words, mask, 100 + 4 * length + third)[: len(words) - length + 1]


def _items(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``key`` and ``words`` of every item long enough; items of equal words stay apart."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            words = [word_hashes(t).view(np.int64) for t in batch.column("text").to_pylist()]
            arrays = [batch.column("item"), pa.array(words, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, names=["item", "words"])

    rows = items.select(row_key(id_col, text_col).alias("item"), text_of(text_col).alias("text"))
    found = rows.distinct().mapInArrow(scan, "item bigint, words array<bigint>")
    return found.where(F.size("words") >= SHORTEST)


def _item_seeds(items: DataFrame) -> DataFrame:
    """``seed``, ``item`` and the position ``at`` of the seed in the item."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, words in zip(
                batch.column("item").to_pylist(), batch.column("words").to_pylist()
            ):
                x = np.array(words, np.int64).view(np.uint64)
                found = list(seeds(x, (len(x),) if len(x) < SPAN else ()))
                at = np.concatenate([np.arange(len(f)) for f in found])
                seed = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(seed), pa.array([item] * len(seed), pa.int64()),
                     pa.array(at, pa.int32())],
                    names=["seed", "item", "at"],
                )

    return items.mapInArrow(scan, "seed bigint, item bigint, at int")


def _bit_of(seed: np.ndarray, probe: int, bits: int) -> np.ndarray:
    return (seed >> np.uint64(probe * 19)) & np.uint64(bits - 1)


def _bitmap(item_seeds: DataFrame) -> np.ndarray:
    """The bitmap of the seeds as 64-bit words; at most MOST_BITS / 64 rows come to the driver."""
    count = item_seeds.select(F.approx_count_distinct("seed")).first()[0]
    bits = 1 << 16
    while bits < min(MOST_BITS, BITS_PER_SEED * count):
        bits *= 2
    probes = F.array(*[
        F.shiftrightunsigned("seed", 19 * p).bitwiseAND(bits - 1) for p in range(PROBES)
    ])
    rows = (
        item_seeds.select(F.explode(probes).alias("bit"))
        .groupBy(F.shiftright("bit", 6).alias("at"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 AS int))")).alias("word"))
        .toArrow()
    )
    bitmap = np.zeros(bits // 64, np.int64)
    bitmap[rows["at"].to_numpy()] = rows["word"].to_numpy()
    return bitmap.view(np.uint64)


def _known(bitmap: np.ndarray, seed: np.ndarray) -> np.ndarray:
    """Indexes of the seeds that the bitmap may hold."""
    left = None
    for probe in range(PROBES):
        bit = _bit_of(seed if left is None else seed[left], probe, 64 * len(bitmap))
        held = bitmap[(bit >> np.uint64(6)).view(np.int64)] >> (bit & np.uint64(63))
        held = np.flatnonzero(held & np.uint64(1))
        left = held if left is None else left[held]
    return left


def _known_seeds(
    texts: list[np.ndarray], bitmap: np.ndarray, short: tuple[int, ...]
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Number, positions and seeds of each text that has seeds the bitmap may hold.

    ``texts`` are the hashes of their words. They are put one behind the other, and seeds that reach
    from one text into the next are left out.
    """
    words = np.concatenate(texts)
    ends = np.cumsum([len(t) for t in texts])
    found = [[np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)]]
    for seed in seeds(words, short):
        at = _known(bitmap, seed)
        text = np.searchsorted(ends, at, side="right")
        within = at + (len(words) - len(seed) + 1) <= ends[text]
        at, text = at[within], text[within]
        found.append([text, at - (ends[text] - [len(texts[i]) for i in text]), seed[at]])
    text, at, seed = map(np.concatenate, zip(*found))
    order = np.argsort(text, kind="stable")
    numbers, starts = np.unique(text[order], return_index=True)
    for number, own in zip(numbers.tolist(), np.split(order, starts[1:])):
        yield number, at[own], seed[own]


def _seeded(docs: DataFrame, bitmap, short: tuple[int, ...], text_col: str) -> DataFrame:
    """Each text that may share a seed, with its words' hashes and those seeds."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_type, int_list = pa.list_(pa.int64()), pa.list_(pa.int32())
        for batch in slices(batches, "text"):
            out: list[list] = [[], [], [], []]
            digests, texts, total = [], [], 0

            def search() -> None:
                for i, at, hits in _known_seeds(texts, bitmap.value, short):
                    for values, value in zip(out, (
                        digests[i], texts[i].view(np.int64), at.astype(np.int32), hits.view(np.int64),
                    )):
                        values.append(value)

            for digest, text in zip(
                batch.column("digest").to_pylist(), batch.column("text").to_pylist()
            ):
                digests.append(digest)
                texts.append(word_hashes(text))
                total += len(texts[-1])
                if total >= AT_ONCE:
                    search()
                    digests, texts, total = [], [], 0
            if texts:
                search()
            kinds = [pa.string(), words_type, int_list, words_type]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
            names = ["digest", "words", "at", "seeds"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(_digest(text_col).alias("digest"), text_of(text_col).alias("text"))
    found = rows.mapInArrow(
        scan, "digest string, words array<bigint>, at array<int>, seeds array<bigint>"
    )
    return found.dropDuplicates(["digest"])


def best_overlap(
    doc: np.ndarray, item: np.ndarray, diagonals: list[int]
) -> tuple[int, int, int, int] | None:
    """The longest stretch in which document and item agree in at least SIMILARITY of the words.

    Start in the document, start in the item, length and equal words; None below the least length,
    SPAN words or the whole of a shorter item. Of equal lengths the one with more equal words wins,
    then the first in the document, then in the item.
    """
    best = None
    least = min(SPAN, len(item))
    for diagonal in diagonals:
        begin, end = max(0, diagonal), min(len(doc), diagonal + len(item))
        if end - begin < least:
            continue
        equal = doc[begin:end] == item[begin - diagonal : end - diagonal]
        # equal words weigh 1, others -4: a stretch holds if its weight is not negative
        weight = np.concatenate([[0], np.cumsum(np.where(equal, 1, -4))])
        lowest = np.minimum.accumulate(weight)
        highest = np.maximum.accumulate(weight[::-1])[::-1]
        # for every end j that tops a suffix, the first start whose weight is not above it
        starts = np.searchsorted(-lowest, -highest, side="left")
        length = np.arange(len(weight)) - starts
        i = int(np.argmax(length))
        if length[i] < least:
            continue
        start, n = int(starts[i]), int(length[i])
        row = (n, int(equal[start : start + n].sum()), -(begin + start), -(begin - diagonal + start))
        best = max(best, row) if best else row
    return (-best[2], -best[3], best[0], best[1]) if best else None


def _digest(text_col: str):
    return F.md5(text_of(text_col))


def overlapping_texts(
    docs: DataFrame,
    items: DataFrame,
    item_id: str = "item_id",
    item_text: str = "text",
    text_col: str = "text",
) -> DataFrame:
    """``digest`` (MD5 of a text), ``item``, ``start``, ``item_start``, ``length``, ``matched``."""
    items = stage(_items(items, item_id, item_text), "items")
    item_seeds = stage(_item_seeds(items), "item-seeds")
    short = sorted(
        r[0]
        for r in items.where(F.size("words") < SPAN).select(F.size("words")).distinct().collect()
    )
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(item_seeds))
    found = stage(_seeded(docs, bitmap, tuple(short), text_col), "seeded-texts")
    hits = found.select("digest", F.explode(F.arrays_zip("at", "seeds")).alias("hit")).select(
        "digest", F.col("hit.at").alias("doc_at"), F.col("hit.seeds").alias("seed")
    )
    diagonals = (
        hits.join(item_seeds, "seed")
        .groupBy("digest", "item")
        .agg(F.collect_set(F.col("doc_at") - F.col("at")).alias("diagonals"))
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            out = []
            for digest, item, doc, words, at in zip(
                rows["digest"], rows["item"], rows["doc_words"], rows["item_words"],
                rows["diagonals"],
            ):
                overlap = best_overlap(np.array(doc), np.array(words), at)
                if overlap:
                    out.append((digest, item, *overlap))
            columns = list(zip(*out)) or [[]] * 6
            kinds = [pa.string(), pa.int64(), *[pa.int32()] * 4]
            names = ["digest", "item", "start", "item_start", "length", "matched"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)], names=names
            )

    candidates = (
        diagonals.join(found.select("digest", F.col("words").alias("doc_words")), "digest")
        .join(items.select("item", F.col("words").alias("item_words")), "item")
        .select("digest", "item", "doc_words", "item_words", "diagonals")
    )
    return candidates.mapInArrow(
        verify,
        "digest string, item bigint, start int, item_start int, length int, matched int",
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document and benchmark item that overlap, with the longest overlap.

    ``start`` and ``item_start`` count words, ``length`` is the overlap's, ``matched`` how many of
    its words are equal: at least 0.8 of at least ten words, or of a whole item of five to nine, or
    all of three or four; shorter items are not sought. Words are runs of letters, digits and
    underscores in lower case, and the single signs of scripts without spaces. Null and empty texts overlap nothing; rows without an id are reported
    with a null ``doc_id``; repeated rows are reported once each; other columns are not read.
    Equal texts are compared once. Either table may be empty.
    """
    overlaps = stage(overlapping_texts(docs, items, item_id, item_text, text_col), "overlaps")
    rows = docs.select(
        id_of(row_key(id_col, text_col)).alias("doc_id"), _digest(text_col).alias("digest")
    )
    return rows.join(overlaps, "digest").select(
        "doc_id", id_of(F.col("item")).alias("item_id"), "start", "item_start", "length", "matched"
    )


def without_contaminated(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item."""
    (digest,) = fresh(docs, "digest")
    overlaps = stage(overlapping_texts(docs, items, item_id, item_text, text_col), "overlaps")
    bad = overlaps.select(F.col("digest").alias(digest)).distinct()
    return docs.withColumn(digest, _digest(text_col)).join(bad, digest, "left_anti").drop(digest)



