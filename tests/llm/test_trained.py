"""Language and quality: held-out accuracy, calibration, and the field against all labellings."""

import itertools
import os
from collections import Counter

import numpy as np
import pytest

from tickloom.llm import language, quality
from tickloom.llm.learning import bounded, train

SF_DIR = "/root/testdata/sf0.01"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_marginals_against_all_labellings():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5):
        unary, ties = rng.normal(size=(1, n)), rng.normal(size=(2, 2))
        weight = {}
        for labels in itertools.product((0, 1), repeat=n):
            score = sum(unary[0, t] * y for t, y in enumerate(labels))
            score += sum(ties[a, b] for a, b in zip(labels, labels[1:]))
            weight[labels] = np.exp(score)
        total = sum(weight.values())
        padded = np.concatenate([unary, np.full((1, 3), 9.0)], axis=1)
        good, pairs = quality.forward_backward(padded, np.array([n]), ties)
        for t in range(n):
            assert np.isclose(good[0, t], sum(w for y, w in weight.items() if y[t]) / total)
        assert (good[0, n:] == 0).all()
        for a, b in itertools.product((0, 1), repeat=2):
            expected = sum(
                w * sum((p, q) == (a, b) for p, q in zip(y, y[1:])) for y, w in weight.items()
            ) / total
            assert np.isclose(pairs[a, b], expected)


def test_chains_of_any_length_score_alike():
    field = quality.Field(
        np.random.default_rng(2).normal(size=quality.FEATURES), np.eye(2), np.array([2.0, 0.1])
    )
    texts = ["One line.", "", "a\nb\n\nc!!", "\n".join(f"line {i} of many" for i in range(500)), "  \n\t"]
    docs = [quality.line_features(t) for t in texts]
    together = field.score(docs)
    assert np.allclose(together, [field.score([d])[0] for d in docs])
    assert together[1] == together[4]


def test_line_features():
    features, length = quality.line_features("AB cd\n\n12 !!")
    assert features.shape == (2, quality.FEATURES) and length.tolist() == [5, 5]
    assert np.isclose(features[0, 1], 0.4) and np.isclose(features[1, 2], 0.4)
    assert (features[0, quality.OWN * 2 : quality.OWN * 3] == features[1, : quality.OWN]).all()


@needs_tables
def test_quality_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = quality.learn_quality(docs, labels)
    scores = quality.quality_scores(docs, model).join(labels, "doc_id").where("held_out").collect()
    right = np.mean([r.predicted == r.quality for r in scores])
    assert len(scores) > 100 and right > 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in scores)
    kept = quality.good_documents(docs.withColumnRenamed("lang", "good"), model)
    assert kept.columns == ["doc_id", "text", "good", "source", "n_chars"]
    assert kept.count() == quality.quality_scores(docs, model).where("predicted = 1").count()


def test_quality_edge_cases(spark):
    rows = [(1, "Good words here."), (2, None), (None, ""), (1, "Good words here."), (4, "w " * 300_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (1, None), (None, 0), (4, 0)], "doc_id long, quality int")
    model = quality.learn_quality(docs, labels)
    assert quality.quality_scores(docs, model).count() == 5
    assert {r.score for r in quality.quality_scores(docs, None).collect()} == {0.5}
    assert quality.learn_quality(docs, labels.where("false")) is None
    assert quality.quality_scores(docs.where("false"), model).count() == 0
    assert quality.good_documents(docs, model).count() <= 5


@needs_tables
def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    model = language.learn_languages(docs)
    found = language.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = found.where("held_out").collect()
    assert len(rows) > 100 and np.mean([r.lang == r.lang_pred for r in rows]) > 0.97
    accepted = [r for r in rows if r.accepted]
    assert np.mean([r.lang == r.lang_pred for r in accepted]) > 0.98
    # calibrated: the mean score is about the share of right answers
    assert abs(np.mean([r.score for r in rows]) - np.mean([r.lang == r.lang_pred for r in rows])) < 0.05


def plain_language(model, text):
    """Probabilities from n-grams cut one by one, their embeddings' mean and a softmax."""
    letters = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in text.lower().encode())
    data = b" " + letters + b" "
    grams = [data[i : i + 3] for i in range(len(data) - 2) if data[i : i + 3] != b"   "]
    grams += [data[i : i + 4] for i in range(len(data) - 3)]

    def bucket(gram):
        multipliers = (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)
        h = sum(b * m for b, m in zip(gram, multipliers)) % 2**32
        return ((h ^ (h >> 15)) * 0x2C1B3C6D) % 2**32 >> 19

    mean = np.mean([model.embeddings[bucket(g)] for g in grams], axis=0)
    odds = np.exp((mean @ model.weights + model.bias) / model.temperature)
    return odds / odds.sum()


def test_prediction_step_by_step():
    rng = np.random.default_rng(7)
    model = language.Model(
        ["a", "b", "c"], rng.normal(size=(language.BUCKETS, language.WIDTH)),
        rng.normal(size=(language.WIDTH, 3)), rng.normal(size=3), 1.7, 0.4,
    )
    for text in ("Ein Haus.", "x", "Straße 12, naïve café", "the  river runs\n\n  home " * 30, "слово 你好"):
        expected = plain_language(model, text)
        lang, score, accepted = model.predict(text)
        assert lang == "abc"[expected.argmax()]
        assert np.isclose(score, expected.max()) and accepted == (expected.max() >= 0.4)


def test_subwords_of_long_texts():
    text = "straße und  Häuser, 12 mal " * 60_000
    plain = np.zeros(language.BUCKETS, np.int64)
    saved = language.AT_ONCE
    try:
        counts = language.subwords(text)
        language.AT_ONCE = 10 * len(text.encode())
        plain = language.subwords(text)
    finally:
        language.AT_ONCE = saved
    assert (counts == plain).all()


def test_language_edge_cases(spark):
    rows = [(1, "ein deutscher Text", "de"), (2, "an English text", "en"), (3, None, "en"), (4, "", None),
            (5, "123 !?", "en"), (None, "no id at all", "fr"), (6, "more English words", "en"),
            (1, "ein deutscher Text", "de"), (7, "unbestimmt", "und"), (8, "noch ein Satz", None)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, held_out boolean")
    model = language.learn_languages(docs)
    got = language.identify(docs, model).collect()
    assert len(got) == len(rows)
    for r in got:
        assert 0 <= r.score <= 1 and r.lang_pred in {"de", "en", "und"}
    by_id = {r.doc_id: r for r in got}
    assert {by_id[i].lang_pred for i in (3, 4, 5)} == {"und"} and by_id[3].score == 0
    assert by_id[None].held_out is False
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    assert language.identify(docs.where("false"), model).count() == 0
    assert language.learn_languages(docs.where("lang is null")) is None


def test_training_sees_rows_in_one_order(spark):
    rows = spark.range(50).selectExpr("id as key", "50 - id as value").repartition(7)
    learn = lambda got: ",".join(str(r["key"]) for r in got).encode()
    assert train(rows, learn, ["key"]) == ",".join(map(str, range(50))).encode()
    assert train(rows.where("false"), learn, ["key"]) is None


def test_rare_language_is_in_the_sample(spark):
    rows = [(i, f"the text {i} of many", "en") for i in range(6000)]
    rows += [(i, "une copie", "fr") for i in range(6000, 9000)]
    rows += [(i, f"ett ord {i}", "sv") for i in range(9000, 9003)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    chosen = bounded(docs, "lang", "doc_id", "text", 400).collect()
    count = Counter(r.lang for r in chosen)
    assert count["sv"] == 3 and count["fr"] == 1 and 300 < count["en"] < 500
    assert [r.doc_id for r in chosen if r.lang == "fr"] == [6000]
    found = language.Model.load(language.learn_languages(docs, sample=40))
    assert list(found.languages) == ["en", "fr", "sv"]
    assert bounded(docs.where("false"), "lang", "doc_id", "text", 400).count() == 0
    for text in ("\u00bd \u00b2 \u2167", "12", ""):
        assert found.predict(text) == ("und", 0.0, False)
