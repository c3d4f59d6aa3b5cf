"""The prefix trie against a plain one; parentheses against a stack."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import trie
from tickloom.llm.trie import Parentheses, closings, encode, forked_conversations


def plain_trie(rows):
    """The nodes of (conversation, turn, role, text) rows."""
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own[c].append((t is not None, t or 0, r, digest, x))
    own = {c: [(r, x) for _, _, r, _, x in sorted(v)] for c, v in own.items()}
    whole = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
    nodes, kids = defaultdict(list), defaultdict(int)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes[s[:d]].append(c)
    for p in nodes:
        if p:
            kids[p[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for p, members in nodes.items():
        weight = (len(members) - 1) * len(p[-1][1]) if p else 0
        for d in range(len(p) + 1):
            saved[p[:d]] += weight
            leaves[p[:d]] += kids[p] == 0
    result = []
    for p, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(whole[c]) == len(p))
        result.append((
            min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p],
            leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return result


def in_order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(-1 if v is None else v for v in r))


SCHEMA = "conv_id long, turn long, role string, text string"


def same(spark, rows):
    got = in_order(forked_conversations(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == in_order(plain_trie(rows))
    return got


def test_random_conversations(spark):
    rng = random.Random(3)
    stock = ["", "a", "bb", "é中", "long " * 40]
    rows = []
    for c in [*range(0, 130), *range(400, 460), 777, 1205]:
        for turn in range(rng.choice([1, 1, 2, 3, 6, 9])):
            role = rng.choice(["user", "user", "assistant"])
            rows.append((c, turn, role, rng.choice(stock[: 2 + turn % 4])))
    rng.shuffle(rows)
    assert len(same(spark, rows)) > 200


def test_cases(spark, monkeypatch):
    monkeypatch.setattr(trie, "RUN", 16)  # several runs of turns
    long = [(500, t, "user", f"turn {t % 7}") for t in range(90)]
    rows = [
        *long,
        *((501, t, "user", f"turn {t % 7}") for t in range(80)),  # the same but for the end
        *((c, 0, "user", "hello") for c in range(600, 690)),  # copies
        (1, 2, None, None), (1, None, "user", "first"), (1, 2, None, None), (1, 2, "", ""),
        (1, 1, "a", "b:c"), (2, 1, "a:b", "c"),  # no mix-up of role and text
        (703, 0, "user", "of a group without a first one"),
        (None, 0, "user", "of no conversation"),
        (900, 0, "user", "x" * 200_000), (901, 0, "user", "x" * 200_000),
    ]
    got = same(spark, rows)
    assert max(r[1] for r in got) == 90


def test_no_rows_and_other_columns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "t")], SCHEMA)
    assert forked_conversations(rows.where("false")).collect() == []
    named = rows.select("*", *(F.lit(7).alias(c) for c in ("conv", "depth", "a", "b", "at", "_n")))
    assert in_order(forked_conversations(named).collect()) == in_order(
        plain_trie([(1, 0, "user", "t")])
    )


def test_hot_groups(spark, monkeypatch):
    """Chunks of ends and runs of turns smaller than the groups."""
    monkeypatch.setattr(trie, "IDS_A_CHUNK", 7)
    rows = [(c, t, "user", "same") for c in range(0, 300) for t in range(2)]
    same(spark, rows)


def closing_by_stack(opens):
    stack, close = [], {}
    for i, o in enumerate(opens):
        if o:
            stack.append(i)
        elif stack:
            close[stack.pop()] = i
    return close


@pytest.mark.parametrize("size", [1, 5, 64, 65, 4096, 30_000])
def test_find_close(size):
    rng = np.random.default_rng(size)
    opens = rng.random(size) < 0.6
    keep, level = [], 0
    for o in opens.tolist():
        if o or level:
            keep.append(o)
            level += 1 if o else -1
    opens = np.array(keep or [True])
    at = np.flatnonzero(opens)
    expected = closing_by_stack(opens.tolist())
    assert Parentheses(opens).find_close(at).tolist() == [
        expected.get(int(i), len(opens)) for i in at
    ]
    string = Parentheses(opens)
    pairs = [int(a and not b) for a, b in zip(opens[:-1], opens[1:])]
    for i in range(0, len(opens) + 1, 997):
        assert string.leaf[i] == sum(pairs[:i])


@pytest.mark.parametrize("cuts", [1, 2, 3, 7, 40])
def test_shards_merge(cuts):
    """However a preorder is cut, the merged figures are those of the whole."""
    rng = random.Random(cuts)
    depth = [0]
    while len(depth) < 300:
        depth.append(rng.randint(max(1, depth[-1] - 4), depth[-1] + 1))
    childless = [i + 1 == len(depth) or depth[i + 1] <= depth[i] for i in range(len(depth))]
    weight = [rng.randint(0, 9) for _ in depth]
    expected = []
    for i, d in enumerate(depth):
        stop = next((j for j in range(i + 1, len(depth)) if depth[j] <= d), len(depth))
        expected.append((sum(childless[i:stop]), sum(weight[i:stop])))
    bounds = sorted({0, len(depth), *rng.sample(range(1, len(depth)), cuts - 1)})
    shards, starts = [], [(0, 0)]
    for s, e in zip(bounds, bounds[1:]):
        part = encode(np.array(depth[s:e]), np.array(childless[s:e]), np.array(weight[s:e]))
        shards.append(part)
        starts.append(tuple(x + y for x, y in zip(starts[-1], part.totals)))
    links = closings([
        (k, min(depth[s:e]), depth[e - 1] - childless[e - 1])
        for k, (s, e) in enumerate(zip(bounds, bounds[1:]))
    ])
    stops = {}
    for owner, by, low, high in links:
        for d in range(low, high + 1):
            if by < 0:
                stops[owner, d] = starts[-1]
                continue
            _, _, leaves, saved = next(x for x in shards[by].ends if x[0] <= d <= x[1])
            stops[owner, d] = (leaves + starts[by][0], saved + starts[by][1])
    got = []
    for k, (s, e) in enumerate(zip(bounds, bounds[1:])):
        part = shards[k]
        for i in range(e - s):
            own = (int(part.leaves[i]), int(part.saved[i]))
            if part.open[i]:
                own = tuple(
                    c - o - b for c, o, b in zip(stops[k, depth[s + i]], own, starts[k])
                )
            got.append(own)
    assert got == expected
