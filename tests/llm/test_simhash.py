"""Fingerprints against a plain computation, groups against all pairs."""

import random

import numpy as np
import pytest
import xxhash

from tickloom.llm.components import components
from tickloom.llm.simhash import (
    _cross_links,
    _links,
    fingerprint,
    hex_digits,
    keep_one,
    near_duplicates,
    near_links,
)


def plain_fingerprint(text, n=3):
    words = [w for w in text.encode().lower().split() if w]
    shingles = [b" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def unsigned(x):
    return x % (1 << 64)


@pytest.mark.parametrize(
    "text",
    ["", " \n\t", "one", "One two", "a b c", "É é Ä A\x0bB\x0cC d e f", "x y z w", "a b c d " * 40_000],
)
def test_fingerprint(text):
    expected = plain_fingerprint(text) if len(text) < 1000 else None
    got = unsigned(fingerprint(text))
    if expected is None:  # more shingles than are counted at once: only four differ
        words = text.split()
        counted = {}
        for i in range(4):
            h = xxhash.xxh64_intdigest(" ".join((words * 2)[i : i + 3]).encode(), 42)
            counted[h] = len(words) // 4 - (i > 1)
        expected = sum(
            1 << b for b in range(64)
            if 2 * sum(n for h, n in counted.items() if h >> b & 1) > len(words) - 2
        )
    assert got == expected


def roots_of(values, radius):
    x = np.array(values, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= radius
    label = np.arange(len(x))
    while True:
        least = np.where(near, label[None, :], len(x)).min(axis=1)
        if (least == label).all():
            return label
        label = least


def clustered(rng, n):
    centres = [rng.getrandbits(64) for _ in range(n // 20 + 1)]
    values = {0, 1, (1 << 64) - 1}
    while len(values) < n:
        v = rng.choice(centres)
        for _ in range(rng.randint(0, 4)):
            v ^= 1 << rng.randrange(64)
        values.add(v)
    return sorted(values)


def test_links_connect_what_pairs_connect():
    rng = random.Random(1)
    values = clustered(rng, 300)
    x = np.array(values, np.uint64)
    label = roots_of(values, 3)
    a, b = _links(x, 3)
    position = {v: i for i, v in enumerate(values)}
    mine = np.arange(len(x))
    for p, q in zip(a.tolist(), b.tolist()):
        mine[position[p]] = position[q]
    assert (mine == label).all()
    a, b = _cross_links(x[:100], x[100:], 3)
    assert all(label[position[p]] == label[position[q]] for p, q in zip(a.tolist(), b.tolist()))
    assert len(a) < len(x)


@pytest.mark.parametrize("tile", [4, 50, 1024])
def test_near_links_find_every_component(spark, tile):
    rng = random.Random(2)
    values = clustered(rng, 400)
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    # a group that shares one block value, larger than a tile
    df = spark.createDataFrame([(v,) for v in signed] + [(None,)], "fp long")
    roots = {r.node: r.root for r in components(near_links(df, 3, tile)).collect()}
    label = roots_of(values, 3)
    groups = {}
    for i, v in enumerate(signed):
        groups.setdefault(label[i], []).append(v)
    for members in groups.values():
        found = {roots.get(v, v) for v in members}
        assert found == {min(members)}


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i + 1, i) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(500)]
    loops = [(5000, 5000), (None, 3), (4, None)]
    edges = spark.createDataFrame(path + star + loops, "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[i] for i in range(301)} == {0}
    assert {roots[i] for i in range(1000, 1501)} == {1000}
    assert 5000 not in roots
    assert components(edges.where("a < 0")).count() == 0


ROWS = [
    (5, "the quick brown fox jumps over", "x"),
    (3, "The QUICK brown  fox\njumps over", "y"),
    (9, "something else entirely here now", "z"),
    (7, None, "n"),
    (8, "", None),
    (None, "the quick brown fox jumps over", "w"),
    (None, "a text without an id of its own", "v"),
    (9, "something else entirely here now", "z"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, key string")


def test_groups(spark, docs):
    rows = near_duplicates(docs).select("doc_id", hex_digits("fp").alias("f"), "component_id").collect()
    assert len(rows) == len(ROWS)
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert by_id[5].component_id == by_id[3].component_id == 3
    assert by_id[7].component_id == by_id[8].component_id == 7
    assert by_id[8].f == "0" * 16
    assert by_id[5].f == f"{plain_fingerprint(ROWS[0][1]):016x}"
    assert sorted(r.component_id or -1 for r in rows if r.doc_id is None) == [-1, 3]


def test_keep_one(docs):
    kept = keep_one(docs).collect()
    assert sorted((r.doc_id or -1, r.key) for r in kept) == [(-1, "v"), (3, "y"), (7, "n"), (9, "z")]
    assert keep_one(docs.where("false")).count() == 0
    assert keep_one(docs).columns == docs.columns


def test_keep_one_of_repeated_ids(spark):
    rows = [
        (1, "the river runs slowly home past the old mill and the bridge"),
        (1, "quite another text that has nothing at all to do with rivers or mills"),
        (2, "and a third one, in which neither of the two others can be found"),
        (2, "and a third one, in which neither of the two others can be found"),
        (3, "quite another text that has nothing at all to do with rivers or mills"),
    ]
    kept = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(set(rows[:3]))
