"""Exact top-k search by inner product with pairs of cover trees.

Equal vectors are one point. Points are dealt to the nearest of a bounded number of pivots and cut
into blocks; over each block a cover tree is built: a node has a centre among its points, which is
also the centre of its first child, and a covering radius. Query vectors are indexed in the same
way. For a node of a query tree and one of a data tree,

    <cq, cx> + rq |cx| + rx |cq| + rq rx

bounds every inner product between their points; the pair is pruned if that lies below the worst kth
score of the node's queries. The same bound is applied to whole blocks first: each query block
searches the blocks that look best, and then all others that its worst kth score does not rule out. A node whose points would not fall into at most CHILDREN clusters
of smaller radius is a leaf, and two leaves are compared by one matrix product.
"""

from __future__ import annotations

import io
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import col, stage

MOST_PIVOTS = 4096  # a bounded sample; beyond it cells hold several blocks
DATA_BLOCK, QUERY_BLOCK = 2048, 512  # points of a block at most
LEAF, FEWEST = 64, 8  # so few points are split only into much smaller clusters, or not at all
CHILDREN, BASE = 16, 1.3  # a node's children at most; the factor by which their radii should shrink
WORTH = 1.15  # the factor from which a split of many points is worth while
FIRST_BLOCKS = 64  # the best of which a query block searches first, as many as hold DATA_BLOCK points
EXACT = 1 << 53  # integers below it are exact in floating point
SLACK = 1 + 1e-9  # for rounding of bounds
_NONE = -(1 << 62)  # below every score


class Tree:
    """A cover tree over the rows of ``points``; nodes are numbered, children after their parent."""

    def __init__(self, points: np.ndarray):
        self.points = points
        x = points.astype(float)
        squares = np.einsum("ij,ij->i", x, x)
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.children: list[list[int]] = []
        self.leaf: list[np.ndarray | None] = []
        waiting = [(None, np.arange(len(x)), 0)]
        while waiting:
            parent, own, centre = waiting.pop()
            node = len(self.centre)
            if parent is not None:
                self.children[parent].append(node)
            away = self._distance(x, squares, own, centre)
            far = float(away.max())
            self.centre.append(centre)
            self.radius.append(far)
            self.children.append([])
            self.leaf.append(None)
            if len(own) <= FEWEST or far == 0:
                self.leaf[node] = own
                continue
            nearest, which = away, np.zeros(len(own), np.int64)
            centres = [centre]
            while len(centres) < CHILDREN and nearest.max() > far / BASE:
                centres.append(int(own[nearest.argmax()]))
                to_new = self._distance(x, squares, own, centres[-1])
                closer = to_new < nearest
                nearest, which = np.where(closer, to_new, nearest), np.where(
                    closer, len(centres) - 1, which
                )
            if nearest.max() > far / (2 if len(own) <= LEAF else WORTH):
                self.leaf[node] = own  # points that do not fall into clusters
                continue
            for i, c in enumerate(centres):
                waiting.append((node, own[which == i], c))

    @staticmethod
    def _distance(x, squares, own, centre) -> np.ndarray:
        away = squares[own] + squares[centre] - 2 * (x[own] @ x[centre])
        return np.sqrt(np.maximum(away, 0))


def bounds(a: Tree, b: Tree) -> np.ndarray:
    """The greatest inner products possible, for each node of one tree and each of the other."""
    ca, cb = a.points[a.centre].astype(float), b.points[b.centre].astype(float)
    ra, rb = np.array(a.radius)[:, None], np.array(b.radius)[None, :]
    na, nb = np.linalg.norm(ca, axis=1)[:, None], np.linalg.norm(cb, axis=1)[None, :]
    spread = ra * nb + rb * na + ra * rb
    return ca @ cb.T + spread * SLACK + 1e-6 * (1 + na * nb)


class Best:
    """The ``k`` best (score, id) of every query, the greater score and then the smaller id first.

    Candidates gather until there are eight times as many as results, then all are ranked at once. ``least`` and
    ``last`` are the score and the id that a candidate of each query has to beat.
    """

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.last = np.full(queries, np.iinfo(np.int64).max)
        self.scores = np.full((queries, k), _NONE, np.int64)
        self.ids = np.full((queries, k), np.iinfo(np.int64).max, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def offer(self, queries: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> bool:
        """Scores (queries, ids) of candidates for some queries; whether the scores to beat rose."""
        least, last = self.least[queries][:, None], self.last[queries][:, None]
        ties, raised = ids[None, :] < last, False
        if scores.shape[1] > self.k:  # only the best of these can be among the best of all
            own = np.partition(scores, scores.shape[1] - self.k, axis=1)[:, [-self.k]]
            better = own > least
            ties |= better
            raised = better.any()
            least = np.maximum(least, own)
            self.least[queries] = least[:, 0]
            self.last[queries[better[:, 0]]] = np.iinfo(np.int64).max
        row, column = np.nonzero((scores > least) | ((scores == least) & ties))
        if not len(row):
            return False  # then none is better either
        self.waiting.append((queries[row], scores[row, column], ids[column]))
        self.size += len(row)
        if self.size < 8 * self.ids.size:
            return bool(raised)
        self.rank()
        return True

    def rank(self) -> None:
        if not self.waiting:
            return
        found = self.scores > _NONE
        self.waiting.append((np.nonzero(found)[0], self.scores[found], self.ids[found]))
        query, score, number = (np.concatenate(x) for x in zip(*self.waiting))
        self.waiting, self.size = [], 0
        order = np.lexsort((number, -score, query))
        query, score, number = query[order], score[order], number[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        kept = place < self.k
        self.scores[query[kept], place[kept]] = score[kept]
        self.ids[query[kept], place[kept]] = number[kept]
        full = self.scores[:, -1] > _NONE
        better = full & (self.scores[:, -1] >= self.least)
        self.least[better], self.last[better] = self.scores[better, -1], self.ids[better, -1]


def search(queries: Tree, data: Tree, ids: Ids, best: Best) -> int:
    """Finds each query's best among the data, given the ids of every point; pairs compared."""
    limit = bounds(queries, data)
    largest = [float(np.abs(t.points).max(initial=0)) for t in (queries, data)]
    exact = largest[0] * largest[1] * queries.points.shape[1] < EXACT
    kind = float if exact else np.int64  # floating point is faster, and exact below EXACT
    q_points, x_points = queries.points.astype(kind), data.points.astype(kind)
    leaves = [None if leaf is None else ids.of(leaf) for leaf in data.leaf]
    worst = np.full(len(queries.centre), float(_NONE))

    parent = {c: n for n, cs in enumerate(queries.children) for c in cs}

    def settle(node: int) -> None:
        leaf, children = queries.leaf[node], queries.children[node]
        worst[node] = best.least[leaf].min() if leaf is not None else worst[children].min()

    for node in range(len(queries.centre) - 1, -1, -1):
        settle(node)
    compared = 0
    waiting = [(0, 0)]
    while waiting:
        q, x = waiting.pop()
        if limit[q, x] < worst[q]:
            continue
        q_leaf, x_leaf = queries.leaf[q], data.leaf[x]
        if q_leaf is not None and x_leaf is not None:
            compared += len(q_leaf) * len(x_leaf)
            scores = (q_points[q_leaf] @ x_points[x_leaf].T).astype(np.int64)
            numbers, copies = leaves[x]
            if best.offer(q_leaf, scores if copies is None else scores[:, copies], numbers):
                node = q
                while node is not None:
                    settle(node)
                    node = parent.get(node)
        elif x_leaf is not None or (q_leaf is None and queries.radius[q] > data.radius[x]):
            waiting.extend((c, x) for c in queries.children[q])
        else:  # the most promising child is looked at first
            waiting.extend((q, c) for c in sorted(data.children[x], key=lambda c: limit[q, c]))
    best.rank()
    return compared


class Ids:
    """The ids of every point, one behind the other."""

    def __init__(self, flat: np.ndarray, counts: np.ndarray):
        self.flat, self.counts = flat, counts
        self.starts = np.cumsum(counts) - counts

    def of(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
        """Ids of some points, and the place of each id's point among them; None if it is its own."""
        counts = self.counts[points]
        if (counts == 1).all():
            return self.flat[self.starts[points]], None
        copies = np.repeat(np.arange(len(points)), counts)
        within = np.arange(len(copies)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.flat[self.starts[points][copies] + within], copies

    def first(self) -> np.ndarray:
        return self.flat[self.starts]


def _pack(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def _small(x: np.ndarray) -> np.ndarray:
    for kind in (np.int8, np.int16, np.int32):
        if not x.size or (x.min() >= np.iinfo(kind).min and x.max() <= np.iinfo(kind).max):
            return x.astype(kind)
    return x


class Block:
    """Points, the ids of each, and their tree, as one binary value."""

    def __init__(self, points: np.ndarray, ids: Ids, tree: Tree | None = None):
        self.ids = ids
        self.tree = tree or Tree(points)

    def save(self) -> bytes:
        t = self.tree
        leaves = [np.empty(0, np.int64) if leaf is None else leaf for leaf in t.leaf]
        parents = sorted((c, p) for p, cs in enumerate(t.children) for c in cs)
        return _pack(
            points=_small(t.points),
            ids=self.ids.flat,
            id_counts=self.ids.counts,
            centre=np.array(t.centre),
            radius=np.array(t.radius),
            parent=np.array([-1, *(p for _, p in parents)]),
            leaf=np.concatenate(leaves),
            leaf_counts=np.array([-1 if t.leaf[i] is None else len(x) for i, x in enumerate(leaves)]),
        )

    @staticmethod
    def load(data: bytes) -> Block:
        with np.load(io.BytesIO(data)) as z:
            part = {k: z[k] for k in z.files}
        tree = Tree.__new__(Tree)
        tree.points = part["points"].astype(np.int64)
        tree.centre, tree.radius = part["centre"].tolist(), part["radius"].tolist()
        tree.children = [[] for _ in tree.centre]
        for node, parent in enumerate(part["parent"].tolist()):
            if parent >= 0:
                tree.children[parent].append(node)
        counts = part["leaf_counts"]
        leaves = np.split(part["leaf"], np.cumsum(np.maximum(counts, 0))[:-1])
        tree.leaf = [None if n < 0 else x for n, x in zip(counts.tolist(), leaves)]
        return Block(tree.points, Ids(part["ids"], part["id_counts"]), tree)


def integer_vectors(
    rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64
) -> DataFrame:
    """``id``, ``number`` and ``vec``: floor(scale * x) of every component, of the rows that take part.

    Left out are rows without an id or a vector and vectors with a null or non-finite component.
    ``number`` tells all rows apart, also those that repeat an id, and grows with the id. A vector
    whose inner products a BIGINT might not hold raises an error.
    """
    vector = F.transform(col(vector_col), lambda x: x.cast("double"))
    sound = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    vec = F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x))
    chosen = rows.where(col(id_col).isNotNull() & col(vector_col).isNotNull()).where(sound)
    chosen = chosen.select(col(id_col).cast("bigint").alias("id"), vec.alias("vec"))
    largest = F.array_max(F.transform("vec", lambda x: F.abs(x))).cast("double")
    fits = F.coalesce(F.size("vec") * largest * largest < float(1 << 62), F.lit(True))
    beyond = F.raise_error(F.lit("inner products of such components do not fit 64 bits"))
    chosen = chosen.withColumn("vec", F.when(fits, F.col("vec")).otherwise(beyond.cast("array<bigint>")))
    place = chosen.withColumn("place", F.monotonically_increasing_id())
    ordered = place.repartitionByRange("id", "place").sortWithinPartitions("id", "place")
    return ordered.select("id", F.monotonically_increasing_id().alias("number"), "vec")


def _points(vectors: DataFrame, most_ids: int) -> DataFrame:
    """Distinct vectors with the ``most_ids`` smallest numbers of their rows; ``rep`` is the least."""
    order = Window.partitionBy("vec").orderBy("number")
    first = vectors.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most_ids)
    return (
        first.groupBy("vec")
        .agg(F.sort_array(F.collect_list("number")).alias("ids"))
        .withColumn("rep", F.col("ids")[0])
    )


def _with_cells(points: DataFrame, pivots) -> DataFrame:
    """Each point's nearest pivot ``cell`` and its distance ``away``, among pivots of its length."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vec").to_pylist()
            cell, away = np.zeros(len(lists), np.int64), np.zeros(len(lists))
            size = np.array([len(v) for v in lists])
            for n in np.unique(size):
                mine = np.flatnonzero(size == n)
                centres, offset = pivots.value.get(int(n), (np.zeros((1, n)), 0))
                x = np.array([lists[i] for i in mine], float).reshape(len(mine), n)
                square = (x * x).sum(1)[:, None] + (centres * centres).sum(1) - 2 * x @ centres.T
                best = square.argmin(axis=1)
                cell[mine] = offset + best
                away[mine] = np.sqrt(np.maximum(square[np.arange(len(mine)), best], 0))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("vec", "ids", "rep")), pa.array(cell), pa.array(away)],
                names=["vec", "ids", "rep", "cell", "away"],
            )

    return points.mapInArrow(
        assign, "vec array<bigint>, ids array<bigint>, rep bigint, cell bigint, away double"
    )


def _choose_pivots(points: DataFrame) -> dict[int, tuple[np.ndarray, int]]:
    """Pivots by length of vector, and the number of the first; at most MOST_PIVOTS in all."""
    count = points.count()
    wanted = int(min(MOST_PIVOTS, max(1, count // DATA_BLOCK)))
    rows = (
        points.withColumn("order", F.xxhash64(F.lit("pivot"), "rep"))
        .orderBy("order", "rep")
        .select("vec")
        .limit(wanted)
        .collect()
    )
    by_size: dict[int, list] = {}
    for (vec,) in rows:
        by_size.setdefault(len(vec), []).append(vec)
    pivots, offset = {}, 0
    for size, vecs in sorted(by_size.items()):
        pivots[size] = (np.array(vecs, float).reshape(len(vecs), size), offset)
        offset += len(vecs)
    return pivots


BLOCK = (
    "block bigint, size int, points int, centre array<double>, radius double, data binary"
)


def _blocks(points: DataFrame, most: int, name: str) -> DataFrame:
    """The points cut into blocks, each with its tree."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held, key = [], None

        def block() -> pa.RecordBatch:
            nonlocal number
            points = np.array([v for v, _ in held], np.int64).reshape(len(held), key[1])
            counts = np.array([len(i) for _, i in held])
            made = Block(points, Ids(np.array([n for _, i in held for n in i], np.int64), counts))
            number += 1
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([key[1]], pa.int32()),
                    pa.array([len(held)], pa.int32()),
                    pa.array([points[0].astype(float)], pa.list_(pa.float64())),
                    pa.array([made.tree.radius[0]], pa.float64()),
                    pa.array([made.save()], pa.binary()),
                ],
                names=["block", "size", "points", "centre", "radius", "data"],
            )

        for batch in batches:
            for vec, ids, cell in zip(*(batch.column(c).to_pylist() for c in ("vec", "ids", "cell"))):
                if held and (key != (cell, len(vec)) or len(held) >= most):
                    yield block()
                    held = []
                key = (cell, len(vec))
                held.append((vec, ids))
        if held:
            yield block()

    order = [F.size("vec"), "cell", "away", "rep"]
    sorted_points = points.repartitionByRange(*order).sortWithinPartitions(*order)
    return stage(sorted_points.mapInArrow(cut, BLOCK), name)


FOUND = "rep bigint, score bigint, id bigint"


def _searcher(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, data = None, None  # rows come sorted by data block
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                if row["x_block"] != number:
                    number, data = row["x_block"], Block.load(row["data"])
                queries = Block.load(row["queries"])
                reps = queries.ids.first()
                least = np.full(len(reps), _NONE)
                if row["reps"]:
                    known = dict(zip(row["reps"], row["leasts"]))
                    least = np.array([known.get(rep, _NONE) for rep in reps.tolist()])
                best = Best(len(reps), k, least)
                search(queries.tree, data.tree, data.ids, best)
                found = best.scores > _NONE
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.repeat(reps, found.sum(axis=1))),
                        pa.array(best.scores[found]),
                        pa.array(best.ids[found]),
                    ],
                    names=["rep", "score", "id"],
                )

    return run


def _reach_of(side: str) -> Column:
    squares = F.aggregate(
        F.col(f"{side}_centre"), F.lit(0.0), lambda total, x: total + x * x
    )
    return F.sqrt(squares)


def top_k(
    rows: DataFrame,
    is_query: Column,
    k: int = 20,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    scale: int = 64,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score``: each query's ``k`` best others.

    ``is_query`` is a condition on the column ``id``. Scores are integer inner products of
    floor(scale * x); ties go to the smaller id. A query's
    own row is no candidate, an equal vector under another id is one. A vector is compared with
    those of its length only. Rows without an id, null vectors and vectors with null or non-finite
    components take no part. Rows that repeat an id are queries and candidates of their own. A query
    has fewer rows if there are fewer candidates, an empty table has none. Other columns are not
    read.
    """
    vectors = stage(integer_vectors(rows, id_col, vector_col, scale), "vectors")
    points = stage(_points(vectors, k + 1), "points")
    pivots = rows.sparkSession.sparkContext.broadcast(_choose_pivots(points))
    points = stage(_with_cells(points, pivots), "points-in-cells")
    queries = vectors.where(is_query)
    asked = queries.select("vec").distinct()
    data_blocks = _blocks(points, DATA_BLOCK, "data-blocks")
    query_blocks = _blocks(points.join(asked, "vec", "left_semi"), QUERY_BLOCK, "query-blocks")

    def described(blocks: DataFrame, side: str) -> DataFrame:
        columns = ("block", "size", "points", "centre", "radius")
        return blocks.select(*(F.col(c).alias(f"{side}_{c}") for c in columns))

    # One row for each block of the query set and each block of the data. Almost all vectors have one
    # length, so a salt spreads the data blocks; the query blocks go to every salt.
    salts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asking = described(query_blocks, "q").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    )
    answering = described(data_blocks, "x").withColumn(
        "salt", F.pmod(F.xxhash64("x_block"), F.lit(salts)).cast("int")
    )
    centre = F.aggregate(
        F.zip_with("q_centre", "x_centre", lambda a, b: a * b), F.lit(0.0), lambda t, x: t + x
    )
    nq, nx = _reach_of("q"), _reach_of("x")
    spread = F.col("q_radius") * nx + F.col("x_radius") * nq + F.col("q_radius") * F.col("x_radius")
    pairs = stage(
        asking.withColumnRenamed("q_size", "size")
        .join(answering.withColumnRenamed("x_size", "size"), ["size", "salt"])
        .select(
            "q_block",
            "x_block",
            "x_points",
            centre.alias("middle"),
            (centre + spread * F.lit(SLACK) + F.lit(1e-6) * (1 + nq * nx)).alias("most"),
        ),
        "block-pairs",
    )
    order = Window.partitionBy("q_block").orderBy(F.desc("middle"), "x_block")
    seen = F.sum("x_points").over(order.rowsBetween(Window.unboundedPreceding, -1))
    first = (
        pairs.withColumn("n", F.row_number().over(order))
        .where(F.col("n") <= FIRST_BLOCKS)
        .withColumn("seen", F.coalesce(seen, F.lit(0)))
        .where(F.col("seen") < DATA_BLOCK)
    )
    first = stage(first.select("q_block", "x_block"), "first-pairs")

    def searched(chosen: DataFrame, leasts: DataFrame) -> DataFrame:
        payload = (
            chosen.join(leasts, "q_block", "left")
            .join(query_blocks.select(F.col("block").alias("q_block"), F.col("data").alias("queries")), "q_block")
            .join(data_blocks.select(F.col("block").alias("x_block"), "data"), "x_block")
        )
        return (
            payload.select("x_block", "queries", "data", "reps", "leasts")
            .sortWithinPartitions("x_block")
            .mapInArrow(_searcher(k + 1), FOUND)
        )

    def best_of(found: DataFrame) -> DataFrame:
        rank = Window.partitionBy("rep").orderBy(F.desc("score"), "id")
        return found.withColumn("place", F.row_number().over(rank)).where(F.col("place") <= k + 1)

    nothing = query_blocks.select(
        F.col("block").alias("q_block"),
        F.array().cast("array<bigint>").alias("reps"),
        F.array().cast("array<bigint>").alias("leasts"),
    )
    early = stage(best_of(searched(first, nothing)).drop("place"), "first-results")
    kth = (
        early.groupBy("rep")
        .agg(F.min("score").alias("least"), F.count("*").alias("n"))
        .select("rep", F.when(F.col("n") > k, F.col("least")).otherwise(_NONE).alias("least"))
    )
    members = _members(query_blocks)
    leasts = stage(
        members.join(kth, "rep", "left")
        .select("q_block", "rep", F.coalesce("least", F.lit(_NONE)).alias("least"))
        .groupBy("q_block")
        .agg(
            F.collect_list("rep").alias("reps"),
            F.collect_list("least").alias("leasts"),
            F.min("least").alias("worst"),
        ),
        "kth-scores",
    )
    rest = (
        pairs.join(first, ["q_block", "x_block"], "left_anti")
        .join(leasts.select("q_block", "worst"), "q_block")
        .where("most >= worst")
        .select("q_block", "x_block")
    )
    late = searched(rest, leasts.drop("worst"))
    best = stage(best_of(early.unionByName(late)), "best")
    lists = best.groupBy("rep").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("down"), "id"))).alias("best")
    )
    named = queries.join(points.select("vec", "rep"), "vec").select(
        F.col("id").alias("query_id"), "number", "rep"
    )
    others = F.slice(F.filter("best", lambda x: x["id"] != F.col("number")), 1, k)
    hits = (
        named.join(lists, "rep")
        .select("query_id", F.posexplode(others).alias("at", "hit"))
        .select(
            "query_id",
            (F.col("at") + 1).alias("rank"),
            F.col("hit.id").alias("number"),
            (-F.col("hit.down")).alias("score"),
        )
    )
    ids = vectors.select("number", F.col("id").alias("vec_id"))
    return hits.join(ids, "number").select("query_id", "rank", "vec_id", "score")


def _members(query_blocks: DataFrame) -> DataFrame:
    """``q_block`` and ``rep`` of every point of the query blocks."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, data in zip(batch.column("block").to_pylist(), batch.column("data").to_pylist()):
                reps = Block.load(data).ids.first().tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([block] * len(reps), pa.int64()), pa.array(reps, pa.int64())],
                    names=["q_block", "rep"],
                )

    return query_blocks.select("block", "data").mapInArrow(members, "q_block bigint, rep bigint")


TOP_SQL = """
WITH v AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS number, [floor(64 * CAST(x AS DOUBLE)) FOR x IN embedding] AS vec
           FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scored AS (SELECT q.vec_id AS query_id, q.number AS query, v.vec_id,
                  CAST(list_inner_product(q.vec, v.vec) AS BIGINT) AS score
           FROM v q JOIN v ON len(q.vec) = len(v.vec) AND q.number <> v.number
           WHERE q.vec_id % 20 = 0),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, vec_id) AS rank
           FROM scored)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20
"""
