"""Packing: an exact round trip of ids, gapless sequences, and the placement rule."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tickloom.llm import queries
from tickloom.llm.packing import Encoder, Piece, SumOfSquares, Window, digest, pack

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    "", " ", "  two  spaces ", "a\n b  c\t d \n", "it's we've 12ab 3½ <|endoftext|>",
    "日本語 テキスト", "a " * 3000, "\x1c a \x85 b", "naïve Straße!! ... ok", "x" * 5000, "\n\n\n",
]


@pytest.fixture(scope="module")
def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def test_ids_equal_the_tokenizers_library(tokenizer):
    encoder = Encoder(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(TEXTS, encoder.encode(TEXTS, 1)):
            assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_random_texts(tokenizer):
    rng = random.Random(5)
    texts = ["".join(rng.choices(" \n\t.,'sé1½aB!", k=rng.randint(0, 60))) for _ in range(400)]
    for text, ids in zip(texts, Encoder(PATH).encode(texts, 1)):
        assert ids.tolist() == tokenizer.encode(text, add_special_tokens=False).ids + [1]


def test_other_tokenizer_file():
    path = public_tokenizers.path("word_bpe_49k.json")
    plain = Tokenizer.from_file(path)
    for text, ids in zip(TEXTS[:5], Encoder(path).encode(TEXTS[:5], 1)):
        assert ids[-1] == 1 and len(ids) >= 1
    word = "hello"
    assert Encoder(path).encode([word], 1)[0][:-1].tolist() == plain.encode(
        word, add_special_tokens=False
    ).ids


ADDED = [
    *TEXTS, "a <|endoftext|> b", "<|endoftext|>", "<|endoftext|><|endoftext|>\n", "x<|endoftext|>  <|endoftext",
    "<|startoftext|>Hello <|endoftext|>", "a b " * 500 + "<|endoftext|>" + " c" * 500,
]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_added_tokens_inside_texts_get_their_own_ids(name):
    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    encoder = Encoder(path, added_tokens=True)
    texts = ADDED if name.startswith("byte") else [t for t in ADDED if "<|endoftext|>" in t]
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, encoder.encode(texts, 1)):
            assert ids.tolist() == plain.encode(text, add_special_tokens=False).ids + [1]


@pytest.mark.parametrize("query", [queries.op2_packing, lambda spark, sf_dir: corpus_pipeline.STAGES[-1][1](
    spark, spark.read.parquet(f"{sf_dir}/documents.parquet"), sf_dir)])
def test_queries_keep_added_tokens(spark, tmp_path, query):
    docs = spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    rows = sorted(query(spark, str(tmp_path)).collect(), key=lambda r: r.start)
    ids, at = [64, 220, 50256, 275, 1], 0
    for r in rows:
        assert (r.start, r.doc_tokens) == (at, 5)
        assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
        at += r.length
    assert at == 5


def check_pieces(rows, docs, tokenizer, window=2048):
    """Every id of every document in exactly one piece, every sequence gapless and full."""
    ids = {}
    for doc_id, text in docs:
        encoded = tokenizer.encode(text or "", add_special_tokens=False).ids
        ids.setdefault(doc_id, []).append([*encoded, 1])
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids)
    for doc_id, parts in pieces.items():
        if len(ids[doc_id]) > 1:
            continue
        (expected,), at = ids[doc_id], 0
        for r in sorted(parts, key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(expected)
            part = np.array(expected[at : at + r.length], "<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
            at += r.length
        assert at == len(expected)
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at == window or at & (at - 1) == 0


def test_round_trip(spark, tokenizer):
    docs = [(i, t) for i, t in enumerate(TEXTS)] + [(50, None), (51, TEXTS[4]), (51, TEXTS[4]), (None, "q")]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, ids int")
    rows = digest(pack(df.repartition(3), PATH)).collect()
    check_pieces(rows, docs, tokenizer)
    assert [r.length for r in rows if r.doc_id == 50] == [1]
    repeated = [r for r in rows if r.doc_id == 51]
    assert sum(r.length for r in repeated) == 2 * repeated[0].doc_tokens


def test_no_rows(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def squares(count):
    return int((count[1:-1] ** 2).sum())


def test_placement_minimises_the_sum_of_squares():
    rng = random.Random(3)
    size = 40
    packer = SumOfSquares(size)
    for _ in range(500):
        n = rng.randint(1, size - 1)
        options = {}
        for level in range(size - n + 1):
            if level and not packer.count[level]:
                continue
            after = packer.count.copy()
            if level:
                after[level] -= 1
            after[level + n] += 1
            options[level] = squares(after)
        chosen = packer.level_for(n)
        assert options[chosen] == min(options.values())
        assert chosen == max(k for k, v in options.items() if v == options[chosen])
        packer.place(Piece(0, 0, np.zeros(n, np.uint32), n))


def test_settling_loses_no_id_and_leaves_one_window():
    packer = SumOfSquares(100)
    for i, n in enumerate([60, 70, 80, 10, 55, 65, 99]):
        packer.open.setdefault(n, []).append(Window([Piece(i, 0, np.arange(n, dtype=np.uint32), n)]))
    full = packer.settle()
    rest = [w for ws in packer.open.values() for w in ws]
    assert all(w.fill == 100 for w in full) and len(rest) <= 1
    pieces = [p for w in [*full, *rest] for p in w]
    assert sum(len(p.ids) for p in pieces) == 439
    for p in pieces:
        assert p.ids.tolist() == list(range(p.start, p.start + len(p.ids)))
