"""Document quality from a linear-chain conditional random field over lines.

Every line of a text is good or bad. A line speaks through counts of its characters and words, and
through those of the lines before and after it; neighbouring labels are tied by transition weights.
The field is trained by gradient ascent in numpy on documents whose lines all take the document's
label. A document's raw score is the mean of its lines' forward-backward marginals for "good",
weighted by their lengths; a logistic curve fitted to the sample turns it into a probability.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, fresh, id_of, row_key, slices, stage, text_of
from tickloom.llm.learning import LONGEST, bounded, fold, held_out, train

SAMPLE = 4000  # labelled documents to learn from at most, about
SEGMENT = 32  # lines of a document that are trained on as one chain
STEPS, RATE, PENALTY = 300, 0.05, 1e-3
TOGETHER = 1 << 14  # lines whose chains run side by side

_KINDS = np.full(256, 6, np.uint8)  # other signs
for _kind, _bytes in enumerate((
    range(97, 123), range(65, 91), range(48, 58), b" \t\r", b".,;:?'\"-()", b"!", (),
    range(128, 256),
)):
    _KINDS[list(_bytes)] = _kind
_KIND_COUNT = 8
OWN = 14  # features of a line itself
FEATURES = 3 * OWN + 3


def line_features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """A row of features for each line that is not blank, and the lines' lengths in characters."""
    lines = [line for line in text.split("\n") if line.strip()]
    if not lines:
        return np.zeros((0, FEATURES)), np.zeros(0)
    data = np.frombuffer("\n".join(lines).encode(), np.uint8)
    ends = data == 10
    line_of = np.cumsum(ends)[~ends]
    kinds = np.bincount(
        line_of * _KIND_COUNT + _KINDS[data[~ends]], minlength=_KIND_COUNT * len(lines)
    ).reshape(len(lines), _KIND_COUNT)
    own = np.zeros((len(lines), OWN))
    own[:, :_KIND_COUNT] = kinds / np.maximum(kinds.sum(axis=1, keepdims=True), 1)
    length = np.array([len(line) for line in lines], float)
    for i, line in enumerate(lines):
        words = line.split()
        n = len(words)
        own[i, 8:13] = (
            len(set(words)) / n,
            sum(map(str.isupper, words)) / n,
            min(length[i] / n / 10, 3),
            min(np.log1p(n) / 5, 3),
            words[0][:1].isupper(),
        )
    own[:, 13] = 1
    flat = np.zeros((len(lines), FEATURES))
    flat[:, :OWN] = own
    flat[1:, OWN : 2 * OWN] = own[:-1]
    flat[:-1, 2 * OWN : 3 * OWN] = own[1:]
    flat[0, -3], flat[-1, -2], flat[:, -1] = 1, 1, min(np.log1p(len(lines)) / 5, 3)
    return flat, length


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(
    unary: np.ndarray, lengths: np.ndarray, ties: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of "good" per line and summed marginals of label pairs, for padded chains.

    ``unary`` (chains, lines) weighs "good" against "bad"; ``ties`` (2, 2) weighs label pairs.
    """
    chains, steps = unary.shape
    score = np.stack([np.zeros_like(unary), unary], axis=2)
    live = np.arange(steps)[None, :] < lengths[:, None]
    alpha, beta = np.zeros((chains, steps, 2)), np.zeros((chains, steps, 2))
    alpha[:, 0] = score[:, 0]
    for t in range(1, steps):
        alpha[:, t] = score[:, t] + _logsumexp(alpha[:, t - 1, :, None] + ties, axis=1)
    for t in range(steps - 2, -1, -1):
        step = _logsumexp(ties + (score[:, t + 1] + beta[:, t + 1])[:, None, :], axis=2)
        beta[:, t] = np.where(live[:, t + 1, None], step, 0)
    total = alpha + beta
    norm = _logsumexp(total, axis=2)
    good = np.where(live, np.exp(total[:, :, 1] - norm), 0)
    pairs = np.zeros((2, 2))
    if steps > 1:
        joint = (
            alpha[:, :-1, :, None]
            + ties
            + (score[:, 1:] + beta[:, 1:])[:, :, None, :]
            - norm[:, 1:, None, None]
        )
        pairs = (np.exp(np.minimum(joint, 0)) * live[:, 1:, None, None]).sum(axis=(0, 1))
    return good, pairs


def _padded(features: list[np.ndarray], weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(x) for x in features])
    unary = np.zeros((len(features), lengths.max()))
    flat = np.concatenate(features) @ weights
    unary[np.arange(unary.shape[1])[None, :] < lengths[:, None]] = flat
    return unary, lengths


class Field:
    """Weights of the lines' features, of label pairs, and the curve for documents."""

    def __init__(self, weights, ties, curve):
        self.weights, self.ties, self.curve = weights, ties, curve

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, weights=self.weights, ties=self.ties, curve=self.curve)
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Field:
        with np.load(io.BytesIO(data)) as parts:
            return Field(parts["weights"], parts["ties"], parts["curve"])

    def raw(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Length-weighted share of good lines per document; 0 for one without lines.

        Chains of like lengths run together, so that short ones are not padded to the longest.
        """
        result = np.zeros(len(docs))
        order = sorted((i for i, d in enumerate(docs) if len(d[0])), key=lambda i: len(docs[i][0]))
        begin = 0
        while begin < len(order):
            end = begin + 1
            while end < len(order) and len(docs[order[end]][0]) * (end + 1 - begin) <= TOGETHER:
                end += 1
            part = order[begin:end]
            unary, lengths = _padded([docs[i][0] for i in part], self.weights)
            good, _ = forward_backward(unary, lengths, self.ties)
            for row, i in enumerate(part):
                result[i] = np.average(good[row, : lengths[row]], weights=docs[i][1])
            begin = end
        return result

    def score(self, docs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        slope, shift = self.curve
        return 1 / (1 + np.exp(-(slope * (2 * self.raw(docs) - 1) + shift)))


def _fit_curve(raw: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Slope and shift of the logistic curve, by Newton's method with a small penalty."""
    x = np.stack([2 * raw - 1, np.ones_like(raw)], axis=1)
    curve = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ curve))
        gradient = x.T @ (label - p) - 0.01 * curve
        bend = (x * (p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(2)
        curve = curve + np.clip(np.linalg.solve(bend, gradient), -2, 2)
    return curve


def _learn(rows: list[dict]) -> bytes:
    docs = [line_features(row["text"]) for row in rows]
    label = np.array([row["label"] for row in rows], float)
    chains, wanted = [], []
    for (features, _), y in zip(docs, label):
        for begin in range(0, len(features), SEGMENT):
            chains.append(features[begin : begin + SEGMENT])
            wanted.append(y)
    weights, ties = np.zeros(FEATURES), np.zeros((2, 2))
    # the two labels count alike, however rare one is
    wanted = np.array(wanted)
    weight = np.where(wanted == 1, 0.5 / max(1, (wanted == 1).sum()), 0.5 / max(1, (wanted == 0).sum()))
    if chains:
        order = np.argsort([len(c) for c in chains], kind="stable")
        groups = np.array_split(order, max(1, len(order) // 512))
        moments = [np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)]
        for step in range(1, STEPS + 1):
            gradient, pair_gradient = np.zeros(FEATURES), np.zeros((2, 2))
            part = groups[step % len(groups)] if len(groups) < 4 else np.concatenate(
                [groups[(step * 3 + k * (len(groups) // 3)) % len(groups)] for k in range(3)]
            )
            share = weight[part].sum()
            for label_value in (0, 1):
                mine = part[wanted[part] == label_value]
                if not len(mine):
                    continue
                features = [chains[i] for i in mine]
                unary, lengths = _padded(features, weights)
                good, pairs = forward_backward(unary, lengths, ties)
                live = np.arange(good.shape[1])[None, :] < lengths[:, None]
                error = (label_value - good)[live]
                scale = weight[mine[0]] / share
                per_line = np.repeat(1 / lengths, lengths)
                gradient += scale * (np.concatenate(features).T @ (error * per_line))
                seen = np.zeros((2, 2))
                seen[label_value, label_value] = pairs.sum()
                pair_gradient += scale * (seen - pairs) / max(1, lengths.mean())
            both = np.concatenate([gradient, pair_gradient.ravel()])
            both -= PENALTY * np.concatenate([weights, ties.ravel()])
            moments[0] = 0.9 * moments[0] + 0.1 * both
            moments[1] = 0.99 * moments[1] + 0.01 * both**2
            move = RATE * (moments[0] / (1 - 0.9**step)) / (
                np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-8
            )
            weights, ties = weights + move[:FEATURES], ties + move[FEATURES:].reshape(2, 2)
    field = Field(weights, ties, np.zeros(2))
    field.curve = _fit_curve(field.raw(docs), label)
    return field.save()


def learn_quality(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> bytes | None:
    """A field learnt from at most about ``sample`` labelled documents outside the held-out fold.

    The sample is one of distinct texts, see ``bounded`` for its bounds. Labels of one document that
    differ count as their mean, rounded up; rows without an id or a label are not learnt from. None
    if no document is left.
    """
    usable = col(label_col).isNotNull() & (fold(id_col) != 1)
    known = (
        labels.where(usable)
        .groupBy(col(id_col).cast("bigint").alias("key"))
        .agg((F.avg(col(label_col)) >= 0.5).cast("int").alias("label"))
    )
    text = text_of(text_col)
    rows = docs.where(F.length(text) <= LONGEST).select(
        row_key(id_col, text_col).alias("key"), F.xxhash64(text).alias("mark"), text.alias("text")
    )
    marks = rows.drop("text").join(known, "key").withColumn("of", F.lit("all"))
    marks = stage(marks, "labelled-marks")  # read twice: counted, then chosen from
    chosen = bounded(marks, "of", "key", "mark", sample).join(known, "key")
    # about ``sample`` rows of a few numbers
    examples = rows.join(F.broadcast(chosen.select("key", "mark", "label")), ["key", "mark"])
    return train(examples.dropDuplicates(["key", "mark"]), _learn, ["key", "text"])


def quality_scores(
    docs: DataFrame,
    model: bytes | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``key``, ``doc_id``, ``mark`` (a hash of the text), ``held_out``, ``score``, ``predicted``.

    The score is the probability that the document's label is 1, ``predicted`` is 1 from 0.5 on.
    Only the text is looked at. Empty, blank and null texts have no lines and a raw score of 0;
    without a model every score is 0.5. Repeated rows stay rows, an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: list[Field] = []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value and not loaded:
            loaded.append(Field.load(shared.value))
        for batch in slices(batches, "text"):
            texts = batch.column("text").to_pylist()
            distinct = {text: i for i, text in enumerate(dict.fromkeys(texts))}
            score = np.full(len(distinct), 0.5)
            if loaded:
                score = loaded[0].score([line_features(text) for text in distinct])
            score = score[[distinct[text] for text in texts]]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("key", "mark", "held_out")), pa.array(score)],
                names=["key", "mark", "held_out", "score"],
            )

    rows = docs.select(
        row_key(id_col, text_col).alias("key"),
        F.xxhash64(text_of(text_col)).alias("mark"),
        held_out(id_col).alias("held_out"),
        text_of(text_col).alias("text"),
    )
    found = rows.mapInArrow(scan, "key bigint, mark bigint, held_out boolean, score double")
    return found.select(
        "key",
        id_of(F.col("key")).alias("doc_id"),
        "mark",
        "held_out",
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def good_documents(
    docs: DataFrame,
    model: bytes | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of ``docs`` whose text the field does not reject (``predicted`` is 1).

    Scores are computed where the rows are and nothing is shuffled: a pandas UDF marks the rows. All
    columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: list[Field] = []

    @F.pandas_udf("boolean")
    def good(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if shared.value and not loaded:
            loaded.append(Field.load(shared.value))
        for series in texts:
            kept: list[bool] = []
            for begin in range(0, len(series), 500):
                part = series.iloc[begin : begin + 500].tolist()
                distinct = {text: i for i, text in enumerate(dict.fromkeys(part))}
                score = np.full(len(distinct), 0.5)
                if loaded:
                    score = loaded[0].score([line_features(text) for text in distinct])
                kept.extend(bool(score[distinct[text]] >= 0.5) for text in part)
            yield pd.Series(kept, dtype=bool)

    (mark,) = fresh(docs, "good")
    return docs.withColumn(mark, good(text_of(text_col))).where(F.col(mark)).drop(mark)
