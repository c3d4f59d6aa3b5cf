"""Top-k search against all inner products; trees and bounds by hand."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import vectors
from tickloom.llm.vectors import Best, Block, Ids, Tree, bounds, search, top_k


def brute(points, k, every):
    """(query, rank, id, score) of (id, integer vector) rows; a row is no candidate of its own."""
    out = []
    for n, (q, x) in enumerate(points):
        if q % every:
            continue
        scores = sorted(
            (-int(np.dot(x, y)), i)
            for m, (i, y) in enumerate(points)
            if m != n and len(y) == len(x)
        )
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


def test_tree_covers_its_points():
    x = np.random.default_rng(1).integers(-30, 30, (900, 8))
    tree = Tree(x)

    def check(node):
        if tree.leaf[node] is not None:
            inside = tree.leaf[node]
        else:
            assert tree.centre[tree.children[node][0]] != -1
            inside = np.concatenate([check(c) for c in tree.children[node]])
        away = np.linalg.norm(x[inside] - x[tree.centre[node]], axis=1)
        assert away.max() <= tree.radius[node] + 1e-6
        return inside

    assert sorted(check(0)) == list(range(900))
    assert all(tree.centre[n] in {tree.centre[c] for c in cs} for n, cs in enumerate(tree.children) if cs)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    a, b = Tree(rng.integers(-9, 9, (200, 5))), Tree(rng.integers(-9, 9, (300, 5)))
    limit = bounds(a, b)
    for i, p in enumerate(a.leaf):
        for j, q in enumerate(b.leaf):
            if p is not None and q is not None:
                assert (a.points[p] @ b.points[q].T).max() <= limit[i, j]


def test_search_prunes_and_is_exact():
    rng = np.random.default_rng(3)
    centres = rng.normal(0, 200, (12, 6))
    x = np.unique(np.rint(centres[rng.integers(0, 12, 1500)] + rng.normal(0, 4, (1500, 6))).astype(int), axis=0)
    block = Block.load(Block(x, Ids(np.arange(len(x)), np.ones(len(x), int))).save())
    queries = Tree(x[::7])
    best = Best(len(x[::7]), 5, np.full(len(x[::7]), vectors._NONE))
    compared = search(queries, block.tree, block.ids, best)
    assert compared < len(x) * len(x[::7]) / 2
    scores = x[::7] @ x.T
    for q in range(len(scores)):
        order = np.lexsort((np.arange(len(x)), -scores[q]))[:5]
        assert best.ids[q].tolist() == order.tolist()


@pytest.fixture(scope="module")
def many(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(0, 0.2, (6, 8))
    x = centres[rng.integers(0, 6, 700)] + rng.normal(0, 0.05, (700, 8))
    x[100:300] = x[100]  # a vector that many rows share
    x = x.astype(np.float32)
    rows = [(i, [float(v) for v in row], 1) for i, row in enumerate(x)]
    rows += [(2000, None, 1), (2020, [1.0, None] + [0.0] * 6, 1), (2040, [float("nan")] * 8, 1),
             (2060, [float("inf")] * 8, 1), (None, [0.5] * 8, 1), (700, [0.25, 0.5], 1),
             (701, [1.5, -1.0], 1), (20, rows[20][1], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vec int")
    sound = rows[:700] + rows[-3:]  # the last repeats the row of id 20
    points = [(i, np.floor(64 * np.array(v, float)).astype(int)) for i, v, _ in sound]
    return df, points


@pytest.mark.parametrize("data_block, query_block", [(2048, 512), (60, 16)])
def test_top_k(many, monkeypatch, data_block, query_block):
    monkeypatch.setattr(vectors, "DATA_BLOCK", data_block)
    monkeypatch.setattr(vectors, "QUERY_BLOCK", query_block)
    df, points = many
    rows = top_k(df, F.col("id") % 20 == 0, k=20).collect()
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows)
    assert got == brute(points, 20, 20)


def test_few_rows(many):
    df, points = many
    few = points[:3]
    rows = top_k(df.where("vec_id in (0, 1, 2)"), F.col("id") % 20 == 0, k=20).collect()
    assert sorted((r.query_id, r.rank, r.vec_id, r.score) for r in rows) == brute(few, 20, 20)
    assert top_k(df.where("false"), F.col("id") % 20 == 0).count() == 0


def test_rows_that_repeat_an_id(spark):
    """Every row is a candidate of the others, whatever its id; only a query's own row is not."""
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.0]), (1, [2.0, 0.0]), (0, [3.0, 1.0]), (0, [3.0, 1.0]), (5, [0.0, 1.0])]
    got = top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0)
    points = [(i, [int(64 * x) for x in v]) for i, v in rows]
    expected = []
    for n, (i, x) in enumerate(points):
        if i % 20 == 0:
            scores = sorted(
                (-sum(a * b for a, b in zip(x, y)), j) for m, (j, y) in enumerate(points) if m != n
            )
            expected += [(i, r + 1, j, -s) for r, (s, j) in enumerate(scores)]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected)
    assert max(s for q, _, i, s in expected if (q, i) == (0, 1)) == 64 * 64 * 6


def test_products_beyond_64_bits_are_refused(spark):
    rows = spark.createDataFrame([(0, [1e9, 1.0]), (1, [1.0, 2.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit"):
        top_k(rows, F.col("id") % 20 == 0).collect()
