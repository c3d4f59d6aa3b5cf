"""Quality rules as weak supervision: rules vote, their accuracies are estimated, a posterior decides.

Each rule looks at a few counts of a whole text and votes that the document is good, that it is bad,
or abstains. No vote is final. Expectation-maximisation finds, without labels, how often each rule
votes right on good and on bad documents, and the share of good ones; a document's posterior
probability of being good then follows from its votes. Documents with equal votes are
interchangeable for this, so the iterations run over the table of distinct votes, which has at most
3^rules rows whatever the number of documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, slices, stage

SPACES = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
FEWEST_WORDS = 50  # shorter texts fail the base check; rates of so few words say little


class Rule(NamedTuple):
    """Votes bad where ``bad`` holds, else good where ``good`` holds, and abstains otherwise."""

    name: str
    bad: str
    good: str


#: Thresholds over the columns of ``features``; between the two a rule abstains.
RULES = (
    Rule("symbols", "n_symbols > 0.1 * n_words", "n_symbols <= 0.02 * n_words"),
    Rule(
        "word_length",
        "word_chars < 3 * n_words OR word_chars > 10 * n_words",
        "word_chars BETWEEN 3.5 * n_words AND 8 * n_words",
    ),
    Rule("capitals", "n_capitals > 0.4 * n_words", "n_capitals <= 0.1 * n_words"),
    Rule("letters", "n_letters < 0.8 * n_words", "n_letters >= 0.9 * n_words"),
    Rule(
        "sentence_ends",
        "n_ends > 0.4 * n_words OR n_ends < 0.002 * n_words",
        "n_ends BETWEEN 0.01 * n_words AND 0.3 * n_words",
    ),
    Rule("doubled_marks", "n_doubled > 0.2 * n_words", "n_doubled <= 0.02 * n_words"),
    Rule("repeated_windows", "n_repeat_words > 0.4 * n_words", "n_repeat_words <= 0.1 * n_words"),
    Rule("commonest_word", "n_commonest > 0.25 * n_words", "n_commonest <= 0.15 * n_words"),
    Rule("repeated_lines", "n_dup_lines > 0.5 * n_lines", "n_dup_lines <= 0.1 * n_lines"),
)

_COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_capitals", "n_letters", "n_ends", "n_doubled", "n_commonest",
)
_UPPER, _LETTER, _END, _DOUBLED = 1, 2, 4, 8
_REMEMBERED = 500_000  # words whose kind a worker keeps


def _kind(word: bytes) -> int:
    """What a word is, as bits: in capitals, with a letter, a sentence's end, ending in two marks."""
    text = word.decode("utf-8", "replace")
    letters = any(c.isalpha() for c in text)
    bare = text.rstrip("\"')]»”’")
    doubled = len(text) > 1 and text[-1] == text[-2] and not text[-1].isalnum()
    return (
        _UPPER * (len(text) > 1 and text.isupper())
        | _LETTER * letters
        | _END * bare.endswith((".", "!", "?", "…", "。", "！", "？"))
        | _DOUBLED * doubled
    )


def repeated_words(ids: np.ndarray) -> int:
    """Words inside windows of three words that occur at least twice, the first time included."""
    if len(ids) < 4:
        return 0
    base = int(ids.max()) + 1
    pairs = ids[:-2] * base + ids[1:-1]
    if base >= 1 << 21:  # else the three together fit 64 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs * base + ids[2:]
    order = np.argsort(windows, kind="stable")
    ordered = windows[order]
    same = ordered[1:] == ordered[:-1]
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    inside = np.zeros(len(ids), bool)
    for shift in range(3):
        inside[shift : shift + len(again)] |= again
    return int(inside.sum())


def counts_of(text: str | None, kinds: dict[bytes, int]) -> tuple[int, ...]:
    """The counts of one text, named by ``_COUNTS``; ``kinds`` remembers words between texts."""
    if not text:
        return (0,) * len(_COUNTS)
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()  # bytes split at ASCII white space alone
    if not words:
        return (0,) * len(_COUNTS)
    number: dict[bytes, int] = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    times = np.bincount(ids)
    if len(kinds) > _REMEMBERED:
        kinds.clear()
    kind = np.empty(len(number), np.int64)
    for i, word in enumerate(number):
        found = kinds.get(word)
        if found is None:
            found = _kind(word)
            if len(word) < 100:
                kinds[word] = found
        kind[i] = found
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in SPACES),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        *(int(times[(kind & bit) > 0].sum()) for bit in (_UPPER, _LETTER, _END, _DOUBLED)),
        int(times.max()),
    )


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``mark`` (a hash of the text) and the counts of every row's whole text.

    Words are runs of anything but ASCII white space. A null text counts as empty; all counts of an
    empty or blank text are 0. Repeated rows stay rows; an empty table gives none.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds: dict[bytes, int] = {}
        for batch in slices(batches, "text"):
            rows = [counts_of(text, kinds) for text in batch.column("text").to_pylist()]
            columns = np.array(rows, np.int64).reshape(len(rows), len(_COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), *map(pa.array, columns.T)],
                names=["doc_id", "mark", *_COUNTS],
            )

    text = col(text_col).cast("string")
    rows = docs.select(
        col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    counts = ", ".join(f"{name} bigint" for name in _COUNTS)
    return rows.mapInArrow(scan, f"doc_id bigint, mark bigint, {counts}")


def vote(rule: Rule) -> Column:
    """1 for good, -1 for bad, 0 for abstaining; all rules abstain on short texts."""
    said = F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)
    return F.when(F.col("n_words") < FEWEST_WORDS, 0).otherwise(said)


class Votes(NamedTuple):
    """What the votes tell: the share of good documents, and each rule's rates of right votes.

    ``on_good[j]`` is the probability that rule j, if it votes on a good document, votes good;
    ``on_bad[j]`` that it votes bad on a bad one.
    """

    share: float
    on_good: np.ndarray
    on_bad: np.ndarray

    def evidence(self) -> tuple[float, np.ndarray, np.ndarray]:
        """Log odds of being good: at first, added by a vote for good, added by a vote for bad."""
        start = np.log(self.share / (1 - self.share))
        return (
            float(start),
            np.log(self.on_good / (1 - self.on_bad)),
            np.log((1 - self.on_good) / self.on_bad),
        )


def estimate(votes: np.ndarray, count: np.ndarray, rounds: int = 500) -> Votes:
    """Expectation-maximisation over distinct vote vectors (-1, 0, 1) and how often each occurs.

    It starts from all-must-pass: good are those without a vote against them. Abstaining says
    nothing. Every rate starts as if ten votes had been seen, eight of them right (half of them for
    ``on_bad``, since a rule need not see every kind of bad document), so that rates stay off 0 and 1.
    """
    up, down, count = votes > 0, votes < 0, count.astype(float)
    good = np.where(down.any(axis=1), 0.1, 0.9)
    model = Votes(0.5, np.empty(0), np.empty(0))
    for _ in range(rounds):
        w, v = count * good, count * (1 - good)
        share = (w.sum() + 1) / (count.sum() + 2)
        on_good = (w @ up + 8) / (w @ (up | down) + 10)
        on_bad = (v @ down + 5) / (v @ (up | down) + 10)
        model = Votes(float(share), on_good, on_bad)
        start, plus, minus = model.evidence()
        odds = start + up @ plus + down @ minus
        again = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
        moved = np.abs(again - good).max(initial=0)
        good = again
        if moved < 1e-9:
            break
    return model


def learn_votes(voted: DataFrame, rules: tuple[Rule, ...] = RULES) -> Votes:
    """The model of a table with ``mark``, ``n_words`` and a vote column per rule.

    Distinct texts of at least FEWEST_WORDS words count, each once, so that a text copied into a
    third of all rows weighs no more than any other. At most 3^rules rows reach the driver.
    """
    names = [rule.name for rule in rules]
    texts = voted.where(F.col("n_words") >= FEWEST_WORDS).groupBy("mark").agg(
        *(F.max(name).alias(name) for name in names)
    )
    rows = texts.groupBy(*names).count().orderBy(*names).collect()
    votes = np.array([[row[name] for name in names] for row in rows]).reshape(len(rows), len(names))
    return estimate(votes, np.array([row["count"] for row in rows]))


def judged(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``doc_id``, the counts, each rule's vote, ``base_failed``, ``posterior`` and ``kept``.

    ``posterior`` is the probability that the document is good, given all rules' votes. A document
    is kept if that is at least one half and it did not fail the base check: fewer than
    FEWEST_WORDS words, or more than half of them inside repeated windows of three words. Null,
    empty and blank texts have no words and so fail it. Repeated rows are judged alike, an empty
    table gives no rows; other columns of any name are not looked at.
    """
    votes = [vote(rule).alias(rule.name) for rule in rules]
    voted = stage(features(docs, id_col, text_col).select("*", *votes), "votes")
    start, plus, minus = learn_votes(voted, rules).evidence()
    odds: Column = F.lit(start)
    for rule, good, bad in zip(rules, plus.tolist(), minus.tolist()):
        said = F.col(rule.name)
        odds = odds + F.when(said > 0, good).when(said < 0, bad).otherwise(0.0)
    failed = (F.col("n_words") < FEWEST_WORDS) | (
        100 * F.col("n_repeat_words") > 50 * F.col("n_words")
    )
    posterior = 1 / (1 + F.exp(-odds))
    result = voted.withColumns({"base_failed": failed, "posterior": posterior})
    return result.withColumn("kept", ~F.col("base_failed") & (F.col("posterior") >= 0.5)).drop("mark")
