"""Packing documents into training windows by the sum-of-squares rule.

A task places the documents of its partition one after the other. What does not fill a window by
itself goes, as a whole, to the fill level for which the sum of the squared numbers of partially
filled windows per level becomes least; the numbers stand in an array with one entry per level.
Windows that are still open at the end are filled up from the emptiest ones, cutting documents, and
the very last one is cut into sequences whose lengths are powers of two. So nothing is padded,
however many partitions there are. No row is shuffled.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, slices, text_of

PIECES = (
    "doc_id bigint, start bigint, length bigint, doc_tokens bigint, sequence_id bigint, "
    "`offset` bigint, ids binary"
)
SEQUENCE_BITS = 33  # of a sequence id: the number within its task
MOST_OPEN = 4096  # windows a task holds open; beyond it the open ones are filled up
CACHED_CHUNKS, CACHED_IDS, LONGEST_CACHED = 1_000_000, 8_000_000, 64  # some 250 MB a worker

# Fixed value: the words that a byte-level vocabulary of this kind is made of.
BYTE_LEVEL_WORDS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

# A space between two characters that are no white space always starts a new word for the
# tokenizer, so the parts between such spaces can be encoded, and remembered, each by itself.
_INNER_SPACE = re.compile(r"(?<=\S) (?=\S)")
_OTHER_SPACE = re.compile(r"[^\S \n]")


def _chunks(text: str) -> list[str]:
    parts = text.split(" ")
    if "" in parts or " \n" in text or "\n " in text or _OTHER_SPACE.search(text):
        return _INNER_SPACE.split(text)
    return parts


def _byte_of_char() -> dict[str, int]:
    """The bytes that the characters of a byte-level vocabulary stand for.

    Printable characters stand for their own code; the bytes without one follow from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def _chunk_encoder(path: str) -> Callable[[str], list[int]]:
    """Text to ids as the ``tokenizers`` file says, special tokens being ordinary text.

    A byte-level vocabulary whose ids follow the order of its merges is at the same time a list of
    merge ranks; for short texts ``tiktoken`` applies those in half the time ``tokenizers`` takes,
    with the same ids. Any other file goes to ``tokenizers`` itself.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    vocabulary, merges = model.get("vocab"), model.get("merges") or []
    pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
    ranked = (
        (split.get("type"), split.get("add_prefix_space"), split.get("use_regex", True))
        == ("ByteLevel", False, True)
        and not spec.get("normalizer")
        and all(vocabulary.get("".join(m)) == 256 + i for i, m in enumerate(pairs))
    )
    if ranked:
        import tiktoken

        code = _byte_of_char()
        special = {t["content"] for t in spec.get("added_tokens", [])}
        ranks = {
            bytes(code[c] for c in word): i
            for word, i in vocabulary.items()
            if word not in special
        }
        encoding = tiktoken.Encoding(
            "chunks", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}
        )
        return encoding.encode_ordinary
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def _added_tokens(path: str) -> tuple[re.Pattern | None, Callable[[str], list[int]] | None]:
    """A pattern that cuts the file's added tokens out of texts, and an encoder of whole texts.

    The encoder is none where the texts between the tokens can be encoded each by itself, as in a
    byte-level vocabulary whose tokens take no white space with them. Texts that hold a token are
    encoded as a whole elsewhere, and all texts if a token is sought in what a normalizer returns.
    """
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    added, split = spec.get("added_tokens") or [], spec.get("pre_tokenizer") or {}
    if not added:
        return None, None
    longest_first = sorted((t["content"] for t in added), key=len, reverse=True)
    pattern = "(" + "|".join(map(re.escape, longest_first)) + ")"
    normalizer = spec.get("normalizer")
    if normalizer and any(t.get("normalized") for t in added):
        pattern = "()"
    apart = (
        (split.get("type"), split.get("add_prefix_space"), normalizer) == ("ByteLevel", False, None)
        and not any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip"))
    )
    if apart:
        return re.compile(pattern), None
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return re.compile(pattern), lambda text: tokenizer.encode(text, add_special_tokens=False).ids


class Encoder(dict):
    """Token ids of texts; remembers what recurring chunks encode to, by a number for each.

    With ``added_tokens`` the file's added tokens inside a text become their own ids, as in
    ``Tokenizer.encode`` with ``add_special_tokens=False``; otherwise they are ordinary text.
    """

    def __init__(self, path: str, added_tokens: bool = False):
        super().__init__()
        self.chunk_ids = _chunk_encoder(path)
        self.added, self.whole_ids, self.added_id = None, None, {}
        if added_tokens:
            self.added, self.whole_ids = _added_tokens(path)
            with open(path, encoding="utf-8") as file:
                self.added_id = {t["content"]: t["id"] for t in json.load(file).get("added_tokens") or []}
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.ids, self.starts = array("I"), array("q", [0])

    def __missing__(self, chunk: str) -> int:
        number = len(self.starts) - 1
        self.ids.extend(self.chunk_ids(" " + chunk))
        self.starts.append(len(self.ids))
        if len(chunk) <= LONGEST_CACHED:
            self[chunk] = number
        return number

    def encode(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The ids of each text, ``end_id`` behind them."""
        if self.added is None or not any(map(self.added.search, texts)):
            return self._ordinary(texts, end_id)
        cut = [self.added.split(text) for text in texts]
        if self.whole_ids:
            plain = iter(self._ordinary([p[0] for p in cut if len(p) == 1], end_id))
            return [
                next(plain) if len(p) == 1 else np.array([*self.whole_ids(text), end_id], np.uint32)
                for text, p in zip(texts, cut)
            ]
        # every second part is an added token
        plain = iter(self._ordinary([part for parts in cut for part in parts[::2]], end_id))
        result = []
        for parts in cut:
            ids = [next(plain)]
            for token in parts[1::2]:
                ids[-1][-1] = self.added_id[token]  # in place of the end
                ids.append(next(plain))
            result.append(np.concatenate(ids))
        return result

    def _ordinary(self, texts: list[str], end_id: int) -> list[np.ndarray]:
        """The same, added tokens being ordinary text."""
        if len(self.starts) > CACHED_CHUNKS or len(self.ids) > CACHED_IDS:
            self._forget()
        heads, numbers = [], []
        for text in texts:
            first, *rest = _chunks(text)
            heads.append(self.chunk_ids(first))
            numbers.append(np.fromiter(map(self.__getitem__, rest), np.int64, len(rest)))
        starts, known, result = np.array(self.starts), np.array(self.ids, np.uint32), []
        for head, which in zip(heads, numbers):
            length = starts[which + 1] - starts[which]
            ends = np.cumsum(length)
            n = int(ends[-1]) if len(ends) else 0
            ids = np.empty(len(head) + n + 1, np.uint32)
            ids[: len(head)] = head
            ids[len(head) : -1] = known[np.repeat(starts[which] - ends + length, length) + np.arange(n)]
            ids[-1] = end_id
            result.append(ids)
        return result


_encoders: dict[tuple[str, bool], Encoder] = {}


def _encoder(path: str, added_tokens: bool) -> Encoder:
    if (path, added_tokens) not in _encoders:
        _encoders[path, added_tokens] = Encoder(path, added_tokens)
    return _encoders[path, added_tokens]


class Piece:
    """Consecutive ids of one document."""

    __slots__ = ("doc_id", "doc_tokens", "ids", "start")

    def __init__(self, doc_id: int | None, start: int, ids: np.ndarray, doc_tokens: int):
        self.doc_id, self.start, self.ids, self.doc_tokens = doc_id, start, ids, doc_tokens

    def cut(self, n: int) -> tuple[Piece, Piece]:
        head = Piece(self.doc_id, self.start, self.ids[:n], self.doc_tokens)
        return head, Piece(self.doc_id, self.start + n, self.ids[n:], self.doc_tokens)


class Window(list):
    """Pieces that share a window."""

    @property
    def fill(self) -> int:
        return sum(len(p.ids) for p in self)


class SumOfSquares:
    """Open windows by fill level, and the number of them per level."""

    def __init__(self, size: int):
        self.size = size
        self.count = np.zeros(size + 1, np.int64)
        self.open: dict[int, list[Window]] = {}

    def level_for(self, n: int) -> int:
        """The fill level a piece of ``n`` ids goes to, 0 for a new window; of equals the fullest.

        Moving a window from level h to h + n changes the sum of squares by 1 - 2 count(h) and
        1 + 2 count(h + n); empty and full windows are not counted.
        """
        levels = np.flatnonzero(self.count[: self.size - n + 1])
        levels = np.concatenate([[0], levels])
        gain = np.where(levels > 0, 1 - 2 * self.count[levels], 0)
        loss = np.where(levels + n < self.size, 1 + 2 * self.count[levels + n], 0)
        cost = gain + loss
        return int(levels[len(cost) - 1 - np.argmin(cost[::-1])])

    def place(self, piece: Piece) -> Window | None:
        """Puts a piece into a window; the window, if that filled it."""
        n = len(piece.ids)
        level = self.level_for(n)
        window = Window()
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        window.append(piece)
        if level + n == self.size:
            return window
        self.count[level + n] += 1
        self.open.setdefault(level + n, []).append(window)
        return None

    def settle(self) -> list[Window]:
        """Fills the fullest windows from the emptiest; full ones are returned, one stays open."""
        windows = [w for level in sorted(self.open) for w in self.open[level]]
        full, low = [], 0
        for high in range(len(windows) - 1, -1, -1):
            window, room = windows[high], self.size - windows[high].fill
            while room and low < high:
                piece = windows[low].pop()
                if len(piece.ids) > room:
                    piece, rest = piece.cut(room)
                    windows[low].append(rest)
                window.append(piece)
                room -= len(piece.ids)
                low += not windows[low]
            if room:
                break
            full.append(window)
            if low >= high:
                break
        rest = [w for w in windows[: len(windows) - len(full)] if w]
        self.count[:] = 0
        self.open = {}
        for window in rest:
            self.count[window.fill] += 1
            self.open.setdefault(window.fill, []).append(window)
        return full


def _powers_of_two(window: Window) -> Iterator[Window]:
    """A window's ids as sequences whose lengths are powers of two, the longest first."""
    pieces, left = list(window), window.fill
    while left:
        room = 1 << (left.bit_length() - 1)
        left -= room
        part = Window()
        while room:
            piece = pieces.pop(0)
            if len(piece.ids) > room:
                piece, rest = piece.cut(room)
                pieces.insert(0, rest)
            part.append(piece)
            room -= len(piece.ids)
        yield part


def _packer(path: str, size: int, end_id: int, added_tokens: bool):
    def pack_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, open_windows = _encoder(path, added_tokens), SumOfSquares(size)
        number = TaskContext.get().partitionId() << SEQUENCE_BITS
        done: list[Window] = []

        def rows() -> pa.RecordBatch:
            nonlocal number
            out: list[list] = [[] for _ in range(7)]
            for window in done:
                offset = 0
                for p in window:
                    n = len(p.ids)
                    row = (p.doc_id, p.start, n, p.doc_tokens, number, offset)
                    for values, value in zip(out, (*row, p.ids.astype("<u4").tobytes())):
                        values.append(value)
                    offset += n
                number += 1
            done.clear()
            kinds = [pa.int64()] * 6 + [pa.binary()]
            names = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]
            arrays = [pa.array(v, k) for v, k in zip(out, kinds)]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            for doc_id, ids in zip(
                batch.column("doc_id").to_pylist(), encoder.encode(texts, end_id)
            ):
                whole = len(ids) // size * size
                for start in range(0, whole, size):
                    done.append(Window([Piece(doc_id, start, ids[start : start + size], len(ids))]))
                if whole < len(ids):
                    window = open_windows.place(Piece(doc_id, whole, ids[whole:], len(ids)))
                    if window:
                        done.append(window)
            if sum(map(len, open_windows.open.values())) > MOST_OPEN:
                done.extend(open_windows.settle())
            yield rows()
        done.extend(open_windows.settle())
        for windows in open_windows.open.values():
            for window in windows:
                done.extend(_powers_of_two(window))
        yield rows()

    return pack_partition


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    added_tokens: bool = False,
) -> DataFrame:
    """One row per piece of a document: where it lies in the document and in its sequence.

    ``tokenizer`` is the path of a ``tokenizers`` file that every executor can read. With
    ``added_tokens`` the file's added tokens inside a text become their own ids, as that library
    gives them without further settings; otherwise they are spelled out. ``ids`` holds a
    piece's ids as little-endian unsigned 32-bit numbers; ``doc_tokens`` counts the document's ids
    with its ``end_id``. Sequences are full windows but for the last few of a task, whose lengths
    are powers of two. A null or empty text is a document of ``end_id`` alone; rows without an id
    and repeated rows are documents like any other; very long texts fill many windows; an empty
    table gives none. Other columns are not read. A task keeps the open windows and about 4 MB of
    text in memory.
    """
    rows = docs.select(
        col(id_col).cast("bigint").alias("doc_id"), text_of(text_col).alias("text")
    )
    return rows.mapInArrow(_packer(tokenizer, window, end_id, added_tokens), PIECES)


def digest(pieces: DataFrame) -> DataFrame:
    """Pieces with a checksum in place of their ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
