"""Counts against a plain version, expectation-maximisation against votes with known accuracies."""

import os
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm.rules import FEWEST_WORDS, RULES, counts_of, estimate, judged

SF_DIR = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")


def plain(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)"""
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(words, words[1:], words[2:]))
    inside = {
        i + k
        for i, w in enumerate(zip(words, words[1:], words[2:]))
        if windows[w] > 1
        for k in range(3)
    }
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(inside),
    )


TEXTS = [
    None, "", " \t\n ", "one", "a b c", "a a a", "a a a a", "a b c a b c", "x y z w x y q x y z",
    "é ü   中文 \x1c\x85", "same\nsame\n \nsame \nsame", "a\r\nb\r\na\r\n", "# * $%&|<>",
    "w" * 200_000, "long words here " * 30_000, "\x0b\x0c a \x0b b",
]


def test_counts():
    kinds = {}
    rng = random.Random(1)
    texts = TEXTS + [
        " ".join(rng.choices("abcd", k=rng.randint(0, 60))).replace("d ", "d\n") for _ in range(200)
    ]
    for text in texts:
        assert counts_of(text, kinds)[:5] == plain(text), text and text[:50]


def test_many_distinct_words():
    words = [f"w{i}" for i in range(1 << 21)] + ["w5", "w6", "w7", "w8"]
    assert counts_of(" ".join(words), {})[4] == 8


def test_estimate_finds_accuracies():
    rng = np.random.default_rng(4)
    n, share = 60_000, 0.8
    on_good = np.array([0.97, 0.9, 0.99, 0.85, 0.95, 0.6])
    on_bad = np.array([0.6, 0.8, 0.3, 0.7, 0.9, 0.5])
    good = rng.random(n) < share
    right = rng.random((n, 6)) < np.where(good[:, None], on_good, on_bad)
    votes = np.where(right == good[:, None], 1, -1)
    votes[rng.random((n, 6)) < 0.2] = 0
    rows, count = np.unique(votes, axis=0, return_counts=True)
    model = estimate(rows, count)
    assert model.share == pytest.approx(share, abs=0.02)
    assert model.on_good == pytest.approx(on_good, abs=0.03)
    assert model.on_bad == pytest.approx(on_bad, abs=0.06)
    start, plus, minus = model.evidence()
    odds = start + (votes > 0) @ plus + (votes < 0) @ minus
    must_pass = (votes >= 0).all(axis=1)
    assert ((odds >= 0) == good).mean() > 0.93 > (must_pass == good).mean()


def test_estimate_of_nothing():
    model = estimate(np.zeros((0, 3), int), np.zeros(0, int))
    assert np.isfinite(model.evidence()[1]).all()


def test_cases(spark):
    good = [
        (i, " ".join(random.Random(i).choices(["the", "river", "runs", "slowly", "home.", "and",
                                               "people", "walked", "over", "bridges"], k=80)))
        for i in range(30)
    ]
    rows = good + [(100 + i, t) for i, t in enumerate(TEXTS)] + [
        (None, good[1][1]), (1, good[2][1]),
        *((200 + i, " ".join(f"{w}###" for w in good[i][1].split())) for i in range(12)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    named = docs.select("*", *(F.lit(1).alias(c) for c in ("n_words", "mark", "kept")))
    got = judged(named).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for key, text in rows:
        counts = [
            (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)
            for r in by_id[key]
        ]
        assert plain(text) in counts
    for r in got:
        failed = r.n_words < FEWEST_WORDS or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == failed and not (failed and r.kept)
        assert r.kept == (not failed and r.posterior >= 0.5)
    assert not any(by_id[200 + i][0].kept for i in range(12))
    assert all(by_id[i][0].kept for i in range(3, 30))
    assert judged(docs.where("false")).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_given_documents(spark):
    """The whole query by hand: votes from the counts, the model by repeated weighting, the verdict."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {
        r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    }
    got = {r.doc_id: r for r in judged(docs).collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert got.keys() == texts.keys()
    fit = {}
    for key, r in got.items():
        assert plain(texts[key]) == (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words
        )
        if r.n_words >= FEWEST_WORDS:
            fit[texts[key]] = [r[rule.name] for rule in RULES]
    votes = np.array(list(fit.values()))
    good = np.where((votes < 0).any(axis=1), 0.1, 0.9)
    for _ in range(500):
        rate = {}
        for side, w in (("good", good), ("bad", 1 - good)):
            right, prior = (votes > 0, 8) if side == "good" else (votes < 0, 5)
            rate[side] = [
                (w[right[:, j]].sum() + prior) / (w[votes[:, j] != 0].sum() + 10)
                for j in range(len(RULES))
            ]
        share = (good.sum() + 1) / (len(good) + 2)

        def odds(row):
            a, b = share, 1 - share
            for v, g, d in zip(row, rate["good"], rate["bad"]):
                a *= g if v > 0 else 1 - g if v < 0 else 1
                b *= d if v < 0 else 1 - d if v > 0 else 1
            return a / (a + b)

        good = np.array([odds(row) for row in votes])
    known = right = 0
    for key, r in got.items():
        if r.n_words >= FEWEST_WORDS:
            own = odds([r[rule.name] for rule in RULES])
            assert r.posterior == pytest.approx(own, abs=1e-6)
        if key in labels and not r.base_failed:
            known += 1
            right += r.kept == (labels[key] == 1)
    assert known > 30 and right / known > 0.95
