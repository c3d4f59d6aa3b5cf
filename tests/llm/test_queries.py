"""Registered queries against their SQL, and the pipeline's stages one by one."""

import os
import re

import numpy as np
import pytest

import __spark_entry__ as repo
import corpus_pipeline
from sql_twin import mismatches
from test_lines import plain
from test_simhash import plain_fingerprint, roots_of
from tickloom.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_LLM_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")


def test_registered():
    assert sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0])) == [
        "op1_licenses", "op2_packing", "op3_sharding", "op4_simhash", "op5_decontamination",
        "op6_url_filter", "op7_line_dedup", "op8_language", "op9_quality", "op10_top_k",
        "op11_conversation_trie", "op12_whitening", "op13_quality_rules",
    ]
    assert set(repo.queries()) >= {*QUERIES, "pipeline"}
    assert set(SQL) < set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    rows, only_spark, only_sql = mismatches(spark, name, SF_DIR)
    assert rows > 0
    assert (only_spark, only_sql) == (0, 0)


def near_copies_by_hand(spark, docs):
    ids = sorted(docs)
    roots = roots_of([plain_fingerprint(docs[i]) for i in ids], 3)
    return {i: docs[i] for n, i in enumerate(ids) if roots[n] == n}


def contaminated_by_hand(spark, docs):
    """Ten words in a row, eight of them equal, anywhere in a document and an item."""
    words = lambda text: re.findall(r"\w+", (text or "").lower())
    items = [words(r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    number = {}
    code = lambda ws: np.array([number.setdefault(w, len(number)) for w in ws])
    windows = np.concatenate([
        np.lib.stride_tricks.sliding_window_view(code(i), 10) for i in items if len(i) >= 10
    ])
    kept = {}
    for key, text in docs.items():
        own = code(words(text))
        bad = len(own) >= 10 and any(
            ((windows == w).sum(axis=1) >= 8).any()
            for w in np.lib.stride_tricks.sliding_window_view(own, 10)
        )
        if not bad:
            kept[key] = text
    return kept


BY_HAND = {
    "quality classifier": lambda spark, docs: None,  # trained; see test_trained
    "line dedup": lambda spark, docs: plain(docs),
    "SimHash near-dedup": near_copies_by_hand,
    "benchmark decontamination": contaminated_by_hand,
}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    seen = []
    for name, function in corpus_pipeline.STAGES[:-1]:
        docs = function(spark, docs, SF_DIR)
        rows = docs.collect()
        docs = spark.createDataFrame(rows, docs.schema)
        assert docs.columns == columns
        expected = BY_HAND[name](spark, before)
        if expected is not None:
            assert {r.doc_id: r.text for r in rows} == expected
        ids = [r.doc_id for r in rows]
        assert len(ids) == len(set(ids)) and set(ids) <= set(before)
        if name == "line dedup":
            assert len(ids) == len(before)
            for r in rows:
                assert r.n_chars == len(r.text)
                assert set(r.text.split("\n")) - {""} <= set(before[r.doc_id].split("\n"))
        else:
            assert all(r.text == before[r.doc_id] for r in rows)
        before = {r.doc_id: r.text for r in rows}
        seen.append(len(rows))
    assert seen == sorted(seen, reverse=True) and seen[0] > 100
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert {r.doc_id for r in pieces} == set(before)


def test_stages_take_documents_as_they_come(spark):
    """Nulls, empty and long texts, repeated rows, columns with clashing names, no rows at all."""
    good = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(3).collect()]
    rows = [
        (1, good[0], "en", "s", 1), (1, good[1], None, None, None), (2, None, "en", "s", 0),
        (None, good[2], "en", "s", 1), (3, "", "en", "s", 0), (3, "", "en", "s", 0),
        (4, "word " * 60_000, "en", "s", 9), (5, good[0], "en", "s", 1),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    plain = spark.createDataFrame(rows, schema)
    docs = plain.selectExpr("*", "'k' AS key", "'m' AS mark", "7 AS gone", "7 AS good", "7 AS fp")
    for name, function in corpus_pipeline.STAGES[:-1]:
        out = function(spark, docs, SF_DIR)
        assert out.columns == docs.columns, name
        got = out.collect()
        assert {(r.key, r.mark, r.gone, r.good, r.fp) for r in got} <= {("k", "m", 7, 7, 7)}
        assert len(got) <= len(rows) and {r.doc_id for r in got} <= {1, 2, 3, 4, 5, None}
        if name == "line dedup":
            assert len(got) == len(rows)
            assert {r.doc_id for r in got if r.text is None} == {2}
        assert function(spark, plain.where("false"), SF_DIR).count() == 0
    last = corpus_pipeline.STAGES[-1][1]
    assert {r.doc_id for r in last(spark, docs, SF_DIR).collect()} == {1, 2, 3, 4, 5, None}
    assert last(spark, plain.where("false"), SF_DIR).count() == 0


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 100
