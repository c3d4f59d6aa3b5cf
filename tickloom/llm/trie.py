"""Prefix trie of conversations, encoded as balanced parentheses, shard by shard.

A node is a distinct sequence of first turns. Nodes are put in preorder by a range sort, which cuts
them into shards of about equal size. A shard writes its nodes as a string of parentheses; blocks
with their least and greatest excess, and blocks of blocks, find the parenthesis that closes a node.
Between the two lies its subtree: the rank of ``()`` counts its leaves, a cumulative array gives its
savings. Nodes still open at a shard's end are the spine that later shards share; where each of them
closes follows from the depths at which shards begin and a few numbers a shard, and cumulative
totals over the shards complete their figures.

The sort key of a node names the turns at which its path leaves the most frequent continuation.
Every such step at least halves the conversations, so a key has few parts however deep the node lies
(a preorder by whole paths would need keys as long as conversations). Neither a frequent first turn
nor a conversation of very many turns is gathered in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickloom.llm.common import col, stage
from tickloom.operators.rolling import number_rows

NODES_A_SHARD = 250_000
MOST_SHARDS = 100_000  # bounds what is known of all shards together, a few numbers each
RUN = 1024  # turns of a conversation that are hashed together
IDS_A_CHUNK = 512  # ids written out at once, for the hash over a node's ends
ID = ["a", "b", "depth"]  # names a node: two hashes of its turns, and their number


# Parentheses


class Parentheses:
    """A string of parentheses, with the least and the greatest excess of blocks over blocks."""

    FAN = 64

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        excess = np.cumsum(np.where(opens, 1, -1))
        self.levels = [(excess, excess)]
        while len(self.levels[-1][0]) > self.FAN:
            low, high = self.levels[-1]
            starts = np.arange(0, len(low), self.FAN)
            self.levels.append(
                (np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts))
            )
        leaf = np.zeros(len(opens) + 1, np.int64)
        leaf[1:-1] = np.cumsum(opens[:-1] & ~opens[1:])
        leaf[-1:] = leaf[-2:-1]
        self.leaf = leaf  # how many "()" begin before each place
        self.opened = np.concatenate([[0], np.cumsum(opens)])  # how many "(" lie before it

    def find_close(self, at: np.ndarray) -> np.ndarray:
        """The places of the parentheses that close those at ``at``; the length where none does."""
        result = np.full(len(at), len(self.opens))
        for begin in range(0, len(at), 1 << 14):
            part = at[begin : begin + (1 << 14)]
            result[begin : begin + len(part)] = self._next(part + 1, self.levels[0][0][part] - 1)
        return result

    def _next(self, start: np.ndarray, excess: np.ndarray) -> np.ndarray:
        """The first places from ``start`` on with an excess, or the length."""
        result = np.full(len(start), len(self.opens))
        waiting, place = np.arange(len(start)), start.copy()
        hits = []
        for level in range(len(self.levels)):  # up, until a block holds it
            found, where = self._in_block(level, place, excess[waiting])
            hits.append((waiting[found], where[found]))
            waiting, place = waiting[~found], place[~found] // self.FAN + 1
        own, place = np.empty(0, np.int64), np.empty(0, np.int64)
        for level in range(len(self.levels) - 1, -1, -1):  # and down again
            own = np.concatenate([own, hits[level][0]])
            place = np.concatenate([place, hits[level][1]])
            if level:
                place = self._in_block(level - 1, place * self.FAN, excess[own])[1]
        result[own] = place
        return result

    def _in_block(self, level: int, place: np.ndarray, excess: np.ndarray) -> tuple:
        """Whether and where an entry from ``place`` to its block's end spans an excess."""
        low, high = self.levels[level]
        offsets = np.arange(self.FAN)
        at = place[:, None] + offsets
        inside = (at < (place[:, None] // self.FAN + 1) * self.FAN) & (at < len(low))
        at = np.minimum(at, len(low) - 1)
        hit = inside & (low[at] <= excess[:, None]) & (high[at] >= excess[:, None])
        return hit.any(axis=1), place + hit.argmax(axis=1)


class Shard(NamedTuple):
    """A stretch of nodes in preorder, given by their depths, as parentheses.

    ``leaves`` and ``saved`` are totals of a closed node's subtree; for a node that stays ``open``
    they are those of the nodes before it. ``ends`` are the nodes that close open nodes of earlier
    shards: of depths from ``depth`` to ``upto``, after ``leaves`` leaves and ``saved`` tokens.
    """

    open: np.ndarray
    leaves: np.ndarray
    saved: np.ndarray
    ends: list[tuple[int, int, int, int]]
    totals: tuple[int, int]


def encode(depth: np.ndarray, childless: np.ndarray, weight: np.ndarray) -> Shard:
    """One shard's figures. The last node is closed at once if it is childless."""
    n = len(depth)
    least = np.minimum.accumulate(depth)
    closes = np.zeros(n, np.int64)  # parentheses closed before each node opens
    closes[1:] = depth[:-1] - np.maximum(depth[1:], least[:-1]) + 1
    at = np.arange(n) + np.cumsum(closes)
    opens = np.zeros(int(at[-1]) + 1 + bool(childless[-1]), bool)
    opens[at] = True
    string = Parentheses(opens)
    close = string.find_close(at)
    still = close == len(opens)
    before = np.concatenate([[0], np.cumsum(weight)])
    stop = np.where(still, at, close)
    leaves = string.leaf[stop] - np.where(still, 0, string.leaf[at])
    saved = before[string.opened[stop]] - np.where(still, 0, before[:-1])
    first = np.flatnonzero(np.concatenate([[True], depth[1:] < least[:-1]]))
    upto = [np.iinfo(np.int64).max, *(least[first[1:] - 1] - 1).tolist()]
    ends = [
        (int(depth[i]), int(up), int(string.leaf[at[i]]), int(before[i]))
        for i, up in zip(first, upto)
    ]
    return Shard(still, leaves, saved, ends, (int(string.leaf[-1]), int(before[-1])))


def closings(shards: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Which shard closes the open nodes of which: (shard, by, depths from, to).

    ``shards`` are (number, least depth, greatest depth of a node left open) in order; an open path
    has one node of each depth in between. What nothing closes is closed by -1, the end.
    """
    result, stack = [], []
    for number, least, last in shards:
        while stack and stack[-1][2] >= least:
            owner, low, high = stack.pop()
            result.append((owner, number, max(low, least), high))
            if low < least:
                stack.append((owner, low, least - 1))
        if last >= least:
            stack.append((number, least, last))
    return result + [(owner, -1, low, high) for owner, low, high in stack]


# Turns


def turns_in_order(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv``, ``at`` (0, 1, ... per conversation), ``digest`` of role and text, ``size`` of the text.

    Turns without a number come first; turns of one number follow role, then the digest. A null role
    or text counts as empty. ``size`` is in code points. Rows without a conversation are left out.
    """
    role = F.coalesce(col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    rows = turns.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("bigint").alias("conv"),
        col(turn_col).cast("bigint").alias("turn"),
        role.alias("role"),
        digest.alias("digest"),
        F.length(text).cast("bigint").alias("size"),
    )
    numbered = number_rows(rows, "conv", ["turn", "role", "digest"])
    return numbered.select("conv", F.col("_n").cast("bigint").alias("at"), "digest", "size")


def with_shared_heads(turns: DataFrame, group: int = 100, most: int = 6) -> DataFrame:
    """Conversations whose first turns are those of the first one of their group.

    Conversation c begins with the first h turns of conversation c - c % ``group`` (all it has if
    there are fewer, none if it is absent), then follow its own turns after its first h, where h is
    CRC-32 of its number modulo ``most``. Columns ``conv``, ``depth`` from 1 on, ``digest``, ``size``
    and ``last``; a conversation without turns has one row of depth 0 and no digest.
    """
    own = turns.groupBy("conv").agg(F.count("*").alias("own"))
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = own.select("conv", "own", head.alias("h"), (F.col("conv") - F.col("conv") % group).alias("base"))
    bases = own.select(F.col("conv").alias("base"), F.col("own").alias("base_turns"))
    shared = F.least("h", F.coalesce("base_turns", F.lit(0)))
    total = F.col("k") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = stage(
        convs.join(bases, "base", "left").withColumn("k", shared).withColumn("total", total),
        "conversations",
    )
    # at most most - 1 turns of each base, for the fewer than 2 * group conversations around it
    heads = turns.where((F.col("conv") % group == 0) & (F.col("at") < most - 1))
    first = (
        heads.withColumnRenamed("conv", "base")
        .join(convs.select("conv", "base", "k", "total"), "base")
        .where("at < k")
        .select("conv", (F.col("at") + 1).alias("depth"), "digest", "size", "total")
    )
    rest = (
        turns.join(convs.select("conv", "h", "k", "total"), "conv")
        .where("at >= h")
        .select("conv", F.expr("at - h + k + 1").alias("depth"), "digest", "size", "total")
    )
    empty = convs.where("total = 0").select(
        "conv", F.lit(0).cast("bigint").alias("depth"), F.lit(None).cast("string").alias("digest"),
        F.lit(0).cast("bigint").alias("size"), "total",
    )
    every = first.unionByName(rest).unionByName(empty)
    return every.withColumn("last", F.col("depth") == F.col("total")).drop("total")


def paths(steps: DataFrame) -> DataFrame:
    """Each step with the node it leads to (``a``, ``b``, ``depth``) and the one it comes from.

    ``a`` and ``b`` are the exclusive or of 64-bit hashes of (place, digest) of all turns up to it.
    A conversation's steps are hashed in runs, and the runs' totals are put in front, so a long one
    is not one task's work. Steps of depth 0 lead to the root, whose hashes are 0.
    """
    hashes = {
        name: F.when(F.col("depth") == 0, F.lit(0).cast("bigint")).otherwise(
            F.xxhash64(F.lit(seed), "depth", "digest")
        )
        for name, seed in (("ha", 1), ("hb", 2))
    }
    rows = steps.withColumns({**hashes, "run": F.floor((F.col("depth") - 1) / RUN)}).drop("digest")
    inside = Window.partitionBy("conv", "run").orderBy("depth")
    rows = stage(
        rows.withColumns({"a": F.bit_xor("ha").over(inside), "b": F.bit_xor("hb").over(inside)}),
        "runs-of-turns",
    )
    full = rows.where((F.col("depth") % RUN == 0) & (F.col("depth") > 0))
    earlier = Window.partitionBy("conv").orderBy("run")
    totals = full.select(
        "conv",
        (F.col("run") + 1).alias("run"),
        F.bit_xor("a").over(earlier).alias("before_a"),
        F.bit_xor("b").over(earlier).alias("before_b"),
    )
    joined = rows.join(totals, ["conv", "run"], "left")
    a = F.col("a").bitwiseXOR(F.coalesce("before_a", F.lit(0).cast("bigint")))
    b = F.col("b").bitwiseXOR(F.coalesce("before_b", F.lit(0).cast("bigint")))
    joined = joined.withColumns({"a": a, "b": b})
    return joined.select(
        "conv", *ID, "size", "last",
        F.col("a").bitwiseXOR(F.col("ha")).alias("up_a"),
        F.col("b").bitwiseXOR(F.col("hb")).alias("up_b"),
    )


# The trie


def _nodes(steps: DataFrame, convs: DataFrame) -> DataFrame:
    """Every node with its least and its number of members, its parent and its children's number."""
    below = (
        steps.where("depth > 0")
        .groupBy(*ID)
        .agg(
            F.min("conv").alias("conv"), F.count("*").alias("n"),
            F.min("up_a").alias("up_a"), F.min("up_b").alias("up_b"), F.min("size").alias("size"),
        )
    )
    zero = F.lit(0).cast("bigint")
    root = convs.agg(F.min("conv").alias("conv"), F.count("*").alias("n")).where("n > 0").select(
        zero.alias("a"), zero.alias("b"), zero.alias("depth"), "conv", "n",
        F.lit(None).cast("bigint").alias("up_a"), F.lit(None).cast("bigint").alias("up_b"),
        zero.alias("size"),
    )
    nodes = stage(below.unionByName(root), "nodes")
    family = (
        nodes.where("depth > 0")
        .groupBy("up_a", "up_b", (F.col("depth") - 1).alias("up_depth"))
        .agg(
            F.count("*").alias("children"),
            # the most frequent continuation
            F.max(F.struct("n", "a", "b")).alias("heavy"),
        )
    )
    family = stage(family, "families")
    parents = nodes.join(
        family.select(
            F.col("up_a").alias("a"), F.col("up_b").alias("b"), F.col("up_depth").alias("depth"),
            "children",
        ),
        ID,
        "left",
    ).withColumn("children", F.coalesce("children", F.lit(0).cast("bigint")))
    heavy = family.select(
        F.col("heavy.a").alias("a"), F.col("heavy.b").alias("b"),
        (F.col("up_depth") + 1).alias("depth"), F.lit(False).alias("light"),
    )
    both = parents.join(heavy, ID, "left")
    light = F.coalesce("light", F.col("depth") > 0)
    return stage(both.withColumn("light", light), "nodes")


def _keyed(nodes: DataFrame, steps: DataFrame) -> DataFrame:
    """Nodes with a text ``key`` that sorts them in preorder, the frequent child last.

    The key lists, as hexadecimal digits of fixed width, the depth and hashes of each node on the
    path that is not its parent's most frequent continuation, and ends with the node's own depth.
    """

    def digits(column: Column, width: int) -> Column:
        return F.lpad(F.hex(column), width, "0")

    turning = nodes.where("light").select(*ID)
    members = nodes.select("conv").distinct()
    left = (
        steps.join(members, "conv", "left_semi")
        .join(turning, ID)
        .groupBy("conv")
        .agg(F.sort_array(F.collect_list(F.struct("depth", "a", "b"))).alias("turns"))
    )
    run = F.floor(F.col("depth") / RUN)
    # a long conversation's nodes would all meet in one key
    runs = nodes.groupBy("conv").agg(F.max(run).alias("top"))
    copies = left.join(runs, "conv").select(
        "conv", "turns", F.explode(F.sequence(F.lit(0).cast("bigint"), "top")).alias("run")
    )
    joined = nodes.withColumn("run", run).join(copies, ["conv", "run"], "left")
    depth = F.col("depth")
    own = F.filter(F.coalesce("turns", F.array()), lambda t: t["depth"] <= depth)
    parts = F.transform(
        own,
        lambda t: F.concat(
            digits(t["depth"], 10), F.lit("0"), digits(t["a"], 16), digits(t["b"], 16)
        ),
    )
    key = F.concat(F.array_join(parts, ""), digits(depth, 10), F.lit("1"))
    return joined.withColumn("key", key).drop("turns", "run")


_NODE, _END, _TOTAL = 0, 1, 2
_PARTS = (
    "kind int, shard bigint, a bigint, b bigint, depth bigint, upto bigint, open boolean, "
    "leaves bigint, saved bigint"
)


def _encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One shard: a row per node, one per end, one of totals."""
    parts = list(batches)
    if not sum(part.num_rows for part in parts):
        return
    table = pa.Table.from_batches(parts)
    a, b, depth, weight = (table.column(c).to_numpy() for c in ("a", "b", "depth", "weight"))
    childless = table.column("children").to_numpy() == 0
    shard = encode(depth, childless, weight)
    number = TaskContext.get().partitionId()
    types = [pa.int32(), *[pa.int64()] * 5, pa.bool_(), pa.int64(), pa.int64()]
    names = [part.split()[0] for part in _PARTS.split(", ")]

    def batch(kind: int, *columns) -> pa.RecordBatch:
        n = len(columns[-1])
        full = [np.full(n, kind), np.full(n, number), *columns]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(full, types)], names=names)

    for i in range(0, len(depth), 1 << 16):
        cut = slice(i, i + (1 << 16))
        own = shard.open[cut]
        zero = np.zeros(len(own), np.int64)
        yield batch(
            _NODE, a[cut], b[cut], depth[cut], zero, own, shard.leaves[cut], shard.saved[cut]
        )
    low, up, leaves, saved = (list(x) for x in zip(*shard.ends))
    none = [0] * len(low)
    yield batch(_END, none, none, low, up, [False] * len(low), leaves, saved)
    last = int(depth[-1]) - bool(childless[-1])
    total_leaves, total_saved = shard.totals
    yield batch(_TOTAL, [0], [0], [int(depth.min())], [last], [False], [total_leaves], [total_saved])


def _subtrees(nodes: DataFrame, keyed: DataFrame) -> DataFrame:
    """``leaves`` and ``saved`` of every node's subtree."""
    spark = nodes.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    count = max(least, min(MOST_SHARDS, -(-nodes.count() // NODES_A_SHARD)))
    ordered = keyed.select(
        "key", *ID, "children", ((F.col("n") - 1) * F.col("size")).alias("weight")
    )
    sorted_ = ordered.repartitionByRange(count, "key").sortWithinPartitions("key").drop("key")
    parts = stage(sorted_.mapInArrow(_encoded, _PARTS), "shards")

    # a row per shard, MOST_SHARDS or the shuffle partitions at most
    totals = parts.where(F.col("kind") == _TOTAL).orderBy("shard").collect()
    before, leaves, saved = [], 0, 0
    for row in totals:
        before.append((row["shard"], leaves, saved))
        leaves, saved = leaves + row["leaves"], saved + row["saved"]
    offsets = spark.createDataFrame(
        [*before, (-1, leaves, saved)], "shard bigint, leaves0 bigint, saved0 bigint"
    )
    links = closings([(row["shard"], row["depth"], row["upto"]) for row in totals])
    by = spark.createDataFrame(links, "owner bigint, shard bigint, low bigint, high bigint")
    # the frequent child comes last, so a shard closes a path at few places: each leaves a light node
    ends = parts.where(F.col("kind") == _END).select("shard", "depth", "upto", "leaves", "saved")
    last = spark.createDataFrame([(-1, 0, (1 << 63) - 1, 0, 0)], ends.schema)
    closed = (
        ends.unionByName(last)
        .join(by, "shard")
        .where("low <= upto AND high >= depth")
        .join(offsets, "shard")
        .select(
            F.col("owner").alias("shard"),
            F.explode(F.sequence(F.greatest("low", "depth"), F.least("high", "upto"))).alias("depth"),
            (F.col("leaves") + F.col("leaves0")).alias("leaves1"),
            (F.col("saved") + F.col("saved0")).alias("saved1"),
        )
    )
    found = parts.where(F.col("kind") == _NODE)
    spine = (
        found.where("open")
        .join(offsets, "shard")
        .join(closed, ["shard", "depth"])
        .select(
            *ID,
            F.expr("leaves1 - leaves - leaves0").alias("leaves"),
            F.expr("saved1 - saved - saved0").alias("saved"),
        )
    )
    return found.where("NOT open").select(*ID, "leaves", "saved").unionByName(spine)


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of ends in order: stretches of a node's conversations, written out."""
    for batch in batches:
        a, b, depth, conv = (batch.column(c).to_numpy() for c in (*ID, "conv"))
        new = (np.diff(a) != 0) | (np.diff(b) != 0) | (np.diff(depth) != 0)
        starts = np.concatenate([[0], np.flatnonzero(new) + 1, [len(a)]])
        cuts = [
            (i, min(i + IDS_A_CHUNK, int(e)))
            for s, e in zip(starts[:-1], starts[1:])
            for i in range(int(s), int(e), IDS_A_CHUNK)
        ]
        at = np.array([s for s, _ in cuts], np.int64)
        ids = [",".join(map(str, conv[s:e].tolist())) for s, e in cuts]
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(x[at]) for x in (a, b, depth, conv)), pa.array(ids, pa.string())],
            names=[*ID, "conv", "ids"],
        )


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over each node's chunks in order; one node's state is kept at a time."""
    node, state = None, None

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[], [], [], []]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, types)], names=[*ID, "ends_sha256"]
        )

    for part in batches:
        done = []
        columns = (part.column(c).to_pylist() for c in (*ID, "ids"))
        for *own, ids in zip(*columns):
            if own != node:
                if node is not None:
                    done.append((*node, state.hexdigest()))
                node, state = own, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        yield batch(done)
    if node is not None:
        yield batch([(*node, state.hexdigest())])


def _ends(steps: DataFrame) -> DataFrame:
    """``ends_sha256`` of every node at which conversations end.

    Ids are sorted over all tasks and written out in chunks first, so that a node at which very many
    end costs one task few rows; the hash itself is one after the other.
    """
    ends = steps.where("last").select(*ID, "conv")
    ordered = ends.repartitionByRange(*ID, "conv").sortWithinPartitions(*ID, "conv")
    schema = "a bigint, b bigint, depth bigint, conv bigint, ids string"
    chunks = ordered.mapInArrow(_chunks, schema)
    together = chunks.repartition(*ID).sortWithinPartitions(*ID, "conv").drop("conv")
    return together.mapInArrow(_hashed, "a bigint, b bigint, depth bigint, ends_sha256 string")


def prefix_trie(steps: DataFrame) -> DataFrame:
    """The trie of conversations given by their steps: one row per node.

    ``steps`` has ``conv``, ``depth`` (1, 2, ... per conversation), ``digest`` of the turn, ``size``
    of its text and ``last``; a conversation without turns has one row of depth 0. Result columns:
    ``conv_id``, the smallest member; ``depth``; ``parent_conv_id``, that of the parent; ``n_convs``;
    ``n_children``; ``n_leaves``; ``saved_tokens``, over the subtree each node's (members - 1) times
    the size of its last text; ``ends_sha256``, of the comma-joined ids of the conversations that end
    in the node, in order. No conversations give no rows.
    """
    walked = stage(paths(steps), "paths")
    convs = walked.where("last").select("conv")
    nodes = _nodes(walked, convs)
    subtrees = _subtrees(nodes, stage(_keyed(nodes, walked), "keyed-nodes"))
    parents = nodes.where("children > 0").select(
        F.col("a").alias("up_a"), F.col("b").alias("up_b"),
        (F.col("depth") + 1).alias("depth"), F.col("conv").alias("parent"),
    )
    whole = nodes.join(subtrees, ID).join(_ends(walked), ID, "left")
    rows = whole.join(parents, ["up_a", "up_b", "depth"], "left")
    nothing = hashlib.sha256(b"").hexdigest()
    return rows.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(nothing)).alias("ends_sha256"),
    )


def forked_conversations(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``prefix_trie`` of the conversations of a table, rebuilt ``with_shared_heads``.

    Null roles and texts are empty, empty and very long texts are turns as any other; turns without
    a number come first, and rows of one number follow role and digest, repeated ones each counting
    as a turn. Rows without a conversation take no part. Other columns, of any name, are not looked
    at. An empty table gives no rows.
    """
    ordered = stage(turns_in_order(turns, conv_col, turn_col, role_col, text_col), "turns")
    return prefix_trie(with_shared_heads(ordered))


# crc32(d) of decimal digits, a bit at a time; DuckDB has no such function
_CRC = (
    "xor(4294967295, list_reduce(list_transform(string_split(CAST(c AS VARCHAR), ''), "
    "lambda x: CAST(ascii(x) AS BIGINT)), lambda crc, byte: "
    "list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])), "
    "lambda y, z: xor(y >> 1, 3988292384 * (y & 1))), CAST(4294967295 AS BIGINT)))"
)

TRIE_SQL = f"""
WITH own AS (
  SELECT conv_id AS c, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           coalesce(role, ''), md5(length(coalesce(role, '')) || ':' || coalesce(role, '')
           || coalesce(text, ''))) AS BIGINT) AS place,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, CAST(c - c % 100 AS BIGINT) AS base, {_CRC} % 6 AS h
          FROM (SELECT DISTINCT c FROM own)),
turns AS (
  SELECT convs.c, 0 AS part, own.place, role, text
  FROM convs JOIN own ON own.c = convs.base AND own.place <= convs.h
  UNION ALL
  SELECT convs.c, 1, own.place, role, text FROM convs JOIN own USING (c) WHERE own.place > convs.h),
rebuilt AS (SELECT convs.c, coalesce(s, []) AS s FROM convs LEFT JOIN
  (SELECT c, list({{'r': role, 't': text}} ORDER BY part, place) AS s FROM turns GROUP BY c) USING (c)),
steps AS (SELECT c, CAST(unnest(range(len(s) + 1)) AS BIGINT) AS depth, s FROM rebuilt),
nodes AS (SELECT depth, s[1:depth] AS p, min(c) AS conv_id, count(*) AS n,
                 coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)
                          FILTER (WHERE len(s) = depth), '') AS ends
          FROM steps GROUP BY ALL),
linked AS (SELECT x.*, up.conv_id AS parent_conv_id, up.p AS up,
                  CASE WHEN x.depth = 0 THEN 0 ELSE (x.n - 1) * length(x.p[x.depth].t) END AS own
           FROM nodes x LEFT JOIN nodes up ON x.depth = up.depth + 1 AND x.p[1:up.depth] = up.p),
kids AS (SELECT up AS p, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY up),
full_nodes AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN kids USING (p)),
above AS (SELECT p[1:d] AS p, own, n_children FROM
          (SELECT p, own, n_children, unnest(range(depth + 1)) AS d FROM full_nodes)),
sums AS (SELECT p, sum(own) AS saved_tokens, count(*) FILTER (WHERE n_children = 0) AS n_leaves
         FROM above GROUP BY p)
SELECT conv_id, depth, parent_conv_id, n AS n_convs, n_children, n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM full_nodes JOIN sums USING (p)
"""
