"""Language identification: averaged hashed subword embeddings under a linear softmax.

A text is the mean of the embeddings of its subwords, the byte 3- and 4-grams of its letters and word
boundaries, hashed into a table. Embeddings and softmax are trained together by stochastic gradient
descent in numpy. A part of the sample that is not trained on gives the temperature that calibrates
the probabilities, and the least probability at which a prediction is accepted.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, id_of, row_key, slices, text_of
from tickloom.llm.learning import LONGEST, bounded, fold, held_out, train

BUCKETS = 1 << 13
WIDTH = 16
SAMPLE = 4000  # labelled texts to learn from at most, about, shared among the languages
EPOCHS, BATCH, RATE = 6, 64, 0.5
SNIPPETS = (12, 40, 160)  # characters; short pieces of each text are learnt beside the whole
CHECKED = 5  # every fifth text of the sample calibrates
PRECISION = 0.99  # of accepted predictions on those
UNKNOWN = "und"
AT_ONCE = 1 << 20  # bytes of a text that are hashed at once

_TO_SPACE = bytes(
    b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)
)
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


def _has_letter(text: str) -> bool:
    """Whether a text has a character of the Unicode category L."""
    return any(map(str.isalpha, text))


def subwords(text: str) -> np.ndarray:
    """How often each bucket of the table occurs in a text."""
    data = b" " + text.lower().encode().translate(_TO_SPACE) + b" "
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(data), AT_ONCE):
        # the pieces overlap by three bytes, so that each n-gram begins in exactly one of them
        x = np.frombuffer(data[begin : begin + AT_ONCE + 3], np.uint8).astype(np.uint32)
        whole = begin + AT_ONCE + 3 <= len(data)
        partial = x[:-1] * _MULTIPLIERS[0]
        partial = partial[:-1] + x[1:-1] * _MULTIPLIERS[1]
        three = partial + x[2:] * _MULTIPLIERS[2]
        four = three[:-1] + x[3:] * _MULTIPLIERS[3]
        spaces = (x == 32)
        blank = spaces[:-2] & spaces[1:-1] & spaces[2:]
        if whole:
            three, blank = three[:AT_ONCE], blank[:AT_ONCE]
        for grams in (three[~blank], four):
            mixed = (grams ^ (grams >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
            counts += np.bincount(mixed >> np.uint32(19), minlength=BUCKETS)
    return counts


def _mean(counts: np.ndarray) -> np.ndarray:
    total = counts.sum()
    return counts / total if total else counts.astype(float)


def _snippets(text: str) -> list[str]:
    middle = len(text) // 2
    return [text[middle : middle + n] for n in SNIPPETS if _has_letter(text[middle : middle + n])]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Model:
    """Embeddings, softmax, temperature and the least accepted probability."""

    def __init__(self, languages, embeddings, weights, bias, temperature=1.0, least=0.0):
        self.languages, self.embeddings = list(languages), embeddings
        self.weights, self.bias = weights, bias
        self.temperature, self.least = float(temperature), float(least)

    def save(self) -> bytes:
        out = io.BytesIO()
        np.savez(
            out, languages=np.array(self.languages), embeddings=self.embeddings,
            weights=self.weights, bias=self.bias, temperature=self.temperature, least=self.least,
        )
        return out.getvalue()

    @staticmethod
    def load(data: bytes) -> Model:
        with np.load(io.BytesIO(data)) as parts:
            return Model(*(
                parts[k]
                for k in ("languages", "embeddings", "weights", "bias", "temperature", "least")
            ))

    def logits(self, means: np.ndarray) -> np.ndarray:
        return means @ self.embeddings @ self.weights + self.bias

    def predict(self, text: str) -> tuple[str, float, bool]:
        if not _has_letter(text):
            return UNKNOWN, 0.0, False
        p = _softmax(self.logits(_mean(subwords(text))) / self.temperature)
        i = int(np.argmax(p))
        return str(self.languages[i]), float(p[i]), bool(p[i] >= self.least)


def _learn(rows: list[dict]) -> bytes:
    languages = sorted({row["lang"] for row in rows})
    number = {lang: i for i, lang in enumerate(languages)}
    learnt, checked = [], []
    for i, row in enumerate(rows):
        part = checked if i % CHECKED == 0 and len(rows) >= 2 * CHECKED else learnt
        for text in [row["text"], *_snippets(row["text"])]:
            counts = _mean(subwords(text))
            at = np.flatnonzero(counts)
            part.append((at, counts[at].astype(np.float32), number[row["lang"]]))

    def dense(part):
        x = np.zeros((len(part), BUCKETS), np.float32)
        for i, (at, values, _) in enumerate(part):
            x[i, at] = values
        return x, np.array([y for _, _, y in part])

    rng = np.random.default_rng(7)
    model = Model(
        languages,
        rng.normal(0, 0.5, (BUCKETS, WIDTH)).astype(np.float32),
        rng.normal(0, 0.1, (WIDTH, len(languages))).astype(np.float32),
        np.zeros(len(languages), np.float32),
    )
    steps = EPOCHS * -(-len(learnt) // BATCH)
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(learnt))
        for begin in range(0, len(order), BATCH):
            x, y = dense([learnt[i] for i in order[begin : begin + BATCH]])
            hidden = x @ model.embeddings
            error = _softmax(hidden @ model.weights + model.bias)
            error[np.arange(len(y)), y] -= 1
            error /= len(y)
            rate = RATE * (1 - step / steps)
            back = error @ model.weights.T
            # a bucket's share of a text is about 1 / 1000, hence the larger rate
            model.embeddings -= 200 * rate * (x.T @ back)
            model.weights -= rate * (hidden.T @ error)
            model.bias -= 0.1 * rate * error.sum(axis=0)
            step += 1
    if checked:
        scores = [model.logits(dense(checked[i : i + BATCH])[0]) for i in range(0, len(checked), BATCH)]
        logits, y = np.concatenate(scores), np.array([y for _, _, y in checked])
        loss = {}
        for temperature in np.geomspace(0.25, 4, 17):
            p = _softmax(logits / temperature)[np.arange(len(y)), y]
            loss[temperature] = -np.log(np.maximum(p, 1e-12)).mean()
        model.temperature = float(min(loss, key=loss.get))
        p = _softmax(logits / model.temperature)
        right, best = p.argmax(axis=1) == y, p.max(axis=1)
        order = np.argsort(-best, kind="stable")
        precise = np.cumsum(right[order]) / np.arange(1, len(y) + 1) >= PRECISION
        model.least = float(best[order][np.flatnonzero(precise)[-1]]) if precise.any() else 1.0
    return model.save()


def learn_languages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    sample: int = SAMPLE,
) -> bytes | None:
    """A model learnt from about ``sample`` distinct texts that have a language and letters.

    Languages share the sample evenly, and a rare one has all its texts in it; see ``bounded`` for
    its bounds. Rows of the held-out fold, rows without an id and the language ``und`` are not
    learnt from. None if no rows are left.
    """
    key, lang = row_key(id_col, text_col).alias("key"), col(lang_col).alias("lang")
    text = text_of(text_col)
    usable = (fold(id_col) != 1) & (col(lang_col) != UNKNOWN) & text.rlike(r"\p{L}")
    usable = usable & (F.length(text) <= LONGEST)
    labelled = docs.where(usable).select(key, lang, text.alias("text"))
    return train(bounded(labelled, "lang", "key", "text", sample), _learn, ["key", "lang", "text"])


def identify(
    docs: DataFrame,
    model: bytes | None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id``, ``held_out``, ``lang_pred``, ``score`` and ``accepted`` of every row.

    ``score`` is the calibrated probability of the predicted language; ``accepted`` says whether it
    reaches the model's bound. Null texts, texts without a letter and, without a model, all texts
    get ``und`` with score 0. Only the text is looked at. Repeated rows stay rows, an empty table
    gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    loaded: list[Model] = []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if shared.value and not loaded:
            loaded.append(Model.load(shared.value))
        for batch in slices(batches, "text"):
            known: dict[str, tuple[str, float, bool]] = {}
            out = []
            for text in batch.column("text").to_pylist():
                if text not in known:
                    known[text] = loaded[0].predict(text) if loaded else (UNKNOWN, 0.0, False)
                out.append(known[text])
            lang, score, accepted = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()),
                 pa.array(score, pa.float64()), pa.array(accepted, pa.bool_())],
                names=["doc_id", "held_out", "lang_pred", "score", "accepted"],
            )

    rows = docs.select(
        id_of(row_key(id_col, text_col)).alias("doc_id"),
        held_out(id_col).alias("held_out"),
        text_of(text_col).alias("text"),
    )
    return rows.mapInArrow(
        scan,
        "doc_id bigint, held_out boolean, lang_pred string, score double, accepted boolean",
    )
