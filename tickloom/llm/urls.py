"""URL filtering with Bloom filter cascades: exact membership of listed keys, without joins.

A key is a host and the beginning of a path, such as ``example.net/en/``. It fits every url whose
host is the key's or a subdomain of it and whose path begins with the key's path. The keys that a
url might be listed under are its host's suffixes with its path's beginnings; all of these over the
corpus are the universe. The first level of a cascade is a Bloom filter of the listed keys, the
second one of the universe's false positives of the first, the third one of the listed keys that
pass the second by mistake, and so on until none is left. So a key of the universe is listed exactly
if the first level that it fails is an even one, or if it fails none and their number is odd.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.common import col, stage

LATER_RATE = 0.25  # false positives of the levels after the first
MOST_BITS = 1 << 24  # of all levels together: 2 MB that go into the plan as a literal


@dataclass
class Level:
    """One Bloom filter: 64-bit words as a literal, so that it can be used inside lambdas."""

    words: Column
    bits: int
    probes: int
    number: int

    def positions(self, key: Column) -> list[Column]:
        return [
            F.pmod(F.xxhash64(F.lit(1000 * self.number + i), key), F.lit(self.bits))
            for i in range(self.probes)
        ]

    def holds(self, key: Column) -> Column:
        found = F.lit(True)
        for at in self.positions(key):
            word = F.get(self.words, (at / 64).cast("int"))
            found = found & (F.getbit(word, F.pmod(at, F.lit(64)).cast("int")) == 1)
        return found


def _level(keys: DataFrame, count: int, rate: float, number: int) -> Level:
    """A filter of ``keys``; its words, a number bounded by MOST_BITS, pass the driver."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2 / 64) * 64)
    if bits > MOST_BITS:
        raise ValueError(f"a filter of {count} keys needs {bits} bits, more than {MOST_BITS}")
    level = Level(F.lit(None), bits, max(1, round(bits / count * math.log(2))), number)
    level.probes = min(level.probes, 30)
    rows = (
        keys.select(F.explode(F.array(*level.positions(F.col("key")))).alias("at"))
        .groupBy((F.col("at") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 AS int))")).alias("set"))
        .collect()
    )
    words = [0] * (bits // 64)
    for word, value in rows:
        words[word] = value
    level.words = F.split(F.lit(",".join(map(str, words))), ",").cast("array<bigint>")
    return level


def listed(levels: list[Level], key: Column) -> Column:
    """Whether a key of the universe is listed."""
    answer = F.lit(len(levels) % 2 == 1)
    for i in range(len(levels) - 1, -1, -1):
        answer = F.when(levels[i].holds(key), answer).otherwise(F.lit(i % 2 == 1))
    return answer


def cascade(keys: DataFrame, universe: DataFrame, size: int) -> list[Level]:
    """The levels for the listed ``keys`` over the ``universe``, both with a column ``key``.

    ``size`` is about the number of distinct keys in the universe; the first level is made for it.
    Only what the first level lets through of the universe is made distinct.
    """
    keys = stage(keys.where("key IS NOT NULL").distinct(), "listed-keys")
    count = keys.count()
    if not count:
        return []
    rate = min(0.5, max(2.0**-40, count / max(1, size) / math.sqrt(2)))
    levels = [_level(keys, count, rate, 1)]
    inside = keys
    passed = universe.where(levels[0].holds(F.col("key"))).distinct()
    passed = stage(passed.join(F.broadcast(keys), "key", "left_anti"), "false-positives")
    while (count := passed.count()) > 0:
        levels.append(_level(passed, count, LATER_RATE, len(levels) + 1))
        wrong = stage(inside.where(levels[-1].holds(F.col("key"))), "false-positives")
        inside, passed = passed, wrong
    return levels


def split_url(url: Column) -> tuple[Column, Column]:
    """Host, with A-Z in lower case, and path of a url; both empty if it has no ``://``."""
    url = F.coalesce(url, F.lit(""))
    rest = F.when(F.contains(url, F.lit("://")), F.substring_index(url, "://", 1)).otherwise(None)
    rest = F.substr(url, F.length(rest) + 4)
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), "^[^?#]*", 0)
    host = F.translate(host, ascii_uppercase, ascii_lowercase)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def _keys(host: Column, path: Column, label_counts: list[int], path_lengths: list[int]) -> Column:
    """The keys a url may be listed under, of the shapes that listed keys have."""
    labels = F.split(host, r"\.")
    found = []
    for n in label_counts:
        suffix = F.when(
            F.size(labels) >= n, F.array_join(F.slice(labels, -n, n), ".")
        )
        for m in path_lengths:
            found.append(F.when(F.length(path) >= m, F.concat(suffix, F.left(path, F.lit(m)))))
    return F.filter(F.array(*found), lambda key: key.isNotNull())


def _shapes(lists: DataFrame) -> tuple[list[int], list[int]]:
    """Numbers of labels and lengths of paths that occur among listed keys, a few dozen at most."""
    host = F.substring_index("key", "/", 1)
    shape = lists.select(
        F.size(F.split(host, r"\.")).alias("labels"), (F.length("key") - F.length(host)).alias("path")
    )
    found = shape.agg(F.collect_set("labels"), F.collect_set("path")).first()
    return sorted(found[0]), sorted(found[1])


def judge(
    pages: DataFrame,
    rules: DataFrame,
    blocked: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict`` of every row.

    ``rules`` has columns ``key`` and ``verdict`` (allow or block), ``blocked`` has a column ``key``.
    Of the rules that fit a url the longest gives the verdict; a key that the rules both allow and
    block allows. Where none fits, ``rule`` is null and
    the url is blocked if a key of ``blocked`` fits it, else allowed. Null urls and those without
    ``://`` have an empty host and path, which no key fits. Ids are handed through, null or repeated;
    an empty table gives no row; other columns are not read. Lists may be empty; keys without a path
    fit any path. Lists together hold up to some 300,000 keys (see MOST_BITS), more raise an error.
    """
    host, path = split_url(col(url_col))
    rows = pages.select(
        col(id_col).alias("page_id"), host.alias("host"), path.alias("path")
    )
    every = rules.select("key").unionByName(blocked.select("key"))
    keys = _keys(F.col("host"), F.col("path"), *_shapes(every))
    universe = rows.select(F.explode(keys).alias("key"))
    size = universe.select(F.approx_count_distinct("key")).first()[0]
    allow = cascade(rules.where("verdict = 'allow'").select("key"), universe, size)
    block = cascade(rules.where("verdict <> 'allow'").select("key"), universe, size)
    more = cascade(blocked.select("key"), universe, size)
    fitting = rows.withColumn("keys", keys).select(
        "page_id",
        "host",
        "path",
        F.filter("keys", lambda k: listed(allow, k) | listed(block, k)).alias("fit"),
        F.exists("keys", lambda k: listed(more, k)).alias("blocked"),
    )
    longest = F.array_max(F.transform("fit", lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))
    return fitting.withColumn("rule", longest["k"]).select(
        "page_id",
        "host",
        "path",
        "rule",
        F.when(F.col("rule").isNull(), F.when(F.col("blocked"), "block").otherwise("allow"))
        .when(listed(allow, F.col("rule")), "allow")
        .otherwise("block")
        .alias("verdict"),
    )


def rows_of(spark: SparkSession, rows: tuple, *names: str) -> DataFrame:
    """A small table of texts, written out in the plan."""
    structs = [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))


RULES = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
BLOCKED = ("spam-farm.example.org/", "spam-farm.example.com/", "spam-farm.example.net/")

JUDGED_SQL = f"""
WITH rules(rule, verdict) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in RULES)}),
blocked(key) AS (VALUES {", ".join(f"('{k}')" for k in BLOCKED)}),
cut AS (SELECT page_id, row_number() OVER () AS rid,
               CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages),
hosts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
parts AS (SELECT page_id, rid, translate(h, '{ascii_uppercase}', '{ascii_lowercase}') AS host,
                 regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM hosts),
fit AS (SELECT rid, rule, verdict,
               row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, rule DESC) AS n
        FROM parts JOIN rules ON (ends_with('.' || host, '.' || split_part(rule, '/', 1))
             AND starts_with(path, substr(rule, strpos(rule, '/')))))
SELECT page_id, host, path, f.rule,
       coalesce(f.verdict, CASE WHEN EXISTS (
           SELECT 1 FROM blocked WHERE ends_with('.' || host, '.' || split_part(key, '/', 1))
                  AND starts_with(path, substr(key, strpos(key, '/')))) THEN 'block'
           ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN fit f ON f.rid = parts.rid AND f.n = 1
"""
