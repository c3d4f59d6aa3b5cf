"""URL filter, sharding, licence scan: plain versions and edge cases."""

import hashlib

import pytest
from pyspark.sql import functions as F

from tickloom.llm import urls
from tickloom.llm.common import hash_filter
from tickloom.llm.licenses import RULES, SENTENCES, normalised, scan
from tickloom.llm.sharding import assign, lookup_table, shard_names, write_shards

# URL filter


def plain_judgement(url, rules, blocked):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]

    def fits(key):
        at = key.find("/") if "/" in key else len(key)
        return (host == key[:at] or host.endswith("." + key[:at])) and path.startswith(key[at:])

    fitting = [k for k, _ in rules if fits(k)]
    if fitting:
        rule = max(fitting, key=lambda k: (len(k), k))
        return host, path, rule, dict(rules)[rule]
    return host, path, None, "block" if any(map(fits, blocked)) else "allow"


URLS = [
    "http://a.example.net/en/1?x=/fr/", "https://EXAMPLE.com/de/", "http://x.org/fr/a#b", "http://net/",
    "http://example.net", "http://example.net/", "http://myexample.com/de/1", "ftp://u.example.com/de",
    "no scheme.net/", None, "", "://", "http://?q", "http://spam-farm.example.org/fr/2", "http://É.net/ü/",
    "http://spam-farm.example.org/de/2", "http://a.spam-farm.example.org", "http://.net/", "http://x.org./fr/",
    "http://net://example.net/en/", "http://example.net:80/en/", "http://a\nb.net/x\ny?z", "http://x.net/" + "p" * 100_000,
    "http://" + "a." * 5000 + "net/en/",
]


@pytest.fixture(scope="module")
def lists(spark):
    rules = spark.createDataFrame(urls.RULES, "key string, verdict string")
    return rules, spark.createDataFrame([(k,) for k in urls.BLOCKED], "key string")


def test_urls(spark, lists):
    rows = [(i, u, "k") for i, u in enumerate(URLS)] + [(0, URLS[0], "k"), (None, URLS[2], "k")]
    pages = spark.createDataFrame(rows, "page_id long, url string, keys string")
    got = urls.judge(pages, *lists).collect()
    assert len(got) == len(rows)
    expected = {i: plain_judgement(u, urls.RULES, urls.BLOCKED) for i, u, _ in rows}
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == expected[r.page_id]
    assert urls.judge(pages.where("false"), *lists).count() == 0


def test_long_lists_are_exact(spark):
    """Thousands of listed keys, so that several levels are needed."""
    pages = spark.range(20_000).select(
        F.col("id").alias("page_id"), F.concat(F.lit("http://h"), "id", F.lit(".example/p/"), "id").alias("url")
    )
    rules = spark.range(0, 20_000, 9).select(
        F.concat(F.lit("h"), "id", F.lit(".example/p/")).alias("key"),
        F.when(F.col("id") % 2 == 0, "allow").otherwise("block").alias("verdict"),
    )
    blocked = spark.range(0, 20_000, 7).select(F.concat(F.lit("h"), "id", F.lit(".example")).alias("key"))
    got = {r.page_id: r for r in urls.judge(pages, rules, blocked).collect()}
    for i, r in got.items():
        if i % 9 == 0:
            assert (r.rule, r.verdict) == (f"h{i}.example/p/", "allow" if i % 2 == 0 else "block")
        else:
            assert (r.rule, r.verdict) == (None, "block" if i % 7 == 0 else "allow")


def test_cascade_levels_end(spark):
    universe = spark.range(5000).select(F.col("id").cast("string").alias("key"))
    keys = universe.where("key % 3 = 0")
    levels = urls.cascade(keys, universe, 5000)
    assert len(levels) > 1
    got = universe.select("key", urls.listed(levels, F.col("key")).alias("in")).collect()
    assert all(r["in"] == (int(r.key) % 3 == 0) for r in got)
    assert urls.cascade(keys.where("false"), universe, 5000) == []
    with pytest.raises(ValueError):
        urls._level(keys, 10**9, 0.01, 1)


# Sharding


def number(text):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16)


def plain_table(shards, slots):
    owner, turn = [-1] * slots, 0
    orders = [(number(s + ":offset") % slots, number(s + ":skip") % (slots - 1) + 1) for s in shards]
    while -1 in owner:
        offset, skip = orders[turn % len(shards)]
        at = offset
        while owner[at] >= 0:
            at = (at + skip) % slots
        owner[at] = turn % len(shards)
        turn += 1
    return owner


@pytest.mark.parametrize("shards, slots", [(shard_names(3), 13), (shard_names(7), 211), (["one"], 2)])
def test_lookup_table(spark, shards, slots):
    owner = list(lookup_table(spark, shards, slots).first()[0])
    assert owner == plain_table(shards, slots)
    counts = [owner.count(i) for i in range(len(shards))]
    assert max(counts) - min(counts) <= 1


def test_a_lost_shard_moves_few_slots():
    shards = shard_names(10)
    before, after = plain_table(shards, 1009), plain_table(shards[:-1], 1009)
    moved = sum(a != b for a, b in zip(before, after) if a != 9)
    assert moved < 0.15 * 1009


def test_lookup_table_refuses(spark):
    for shards, slots in ((["a"], 12), ([], 7), (["a", "a"], 7), (shard_names(8), 7)):
        with pytest.raises(ValueError):
            lookup_table(spark, shards, slots)


def test_assign(spark, tmp_path):
    rows = [(1, "a", "old"), (1, "b", "old"), (None, "text", "x"), (None, None, "y"), (5, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard string")
    shards = shard_names(4)
    got = assign(docs, shards, 101)
    assert got.columns == ["doc_id", "text", "shard", "slot"]
    owner = plain_table(shards, 101)
    for r in got.collect():
        key = str(r.doc_id) if r.doc_id is not None else r.text or ""
        assert r.slot == number(key) % 101 and r.shard == shards[owner[r.slot]]
    assert assign(docs.where("false"), shards, 101).count() == 0
    write_shards(got, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 5


# Licence scan


def test_sentences_and_rules_fit():
    assert all(part in SENTENCES for _, parts in RULES for part in parts)
    assert len({normalised(s) for s in SENTENCES.values()}) == len(SENTENCES)


def test_scan(spark):
    s = SENTENCES
    header = [s[k] for k in ("apache-licensed-the", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")]
    texts = {
        1: "Prose here. " + "\n".join(header) + " More prose.",
        2: s["apache-licensed-the"] + "\n" + s["apache-compliance"] + "\n" + s["mit-released"].upper(),
        3: s["mit-grant"] + "\n\nbut not at once.\n" + s["mit-notice"],
        4: "released  under THE mit-license. Released under the MIT License. All rights reserved.",
        5: "nothing known", 6: None, 7: "", 8: "x" * 200_000 + "\n" + s["cc-by-nc-4"],
        11: "# " + s["apache-licensed-the"].replace("Version", "\n# version") + "\n#\n# " + s["apache-compliance"],
        9: "\n".join([s["gpl-free"] + " " + s["gpl-redistribute-3"], s["gpl-version-3-later"]]),
    }
    rows = [(k, v, "n") for k, v in texts.items()] + [(None, s["reserved"], "n"), (8, texts[8], "m")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, name string")
    got = {r.doc_id: r for r in scan(docs).collect()}
    assert {k: (r.licenses, r.unmatched) for k, r in got.items()} == {
        1: ("Apache-2.0", ""),
        2: ("Apache-2.0,MIT", ""),
        3: ("", "mit-grant,mit-notice"),
        4: ("MIT,MIT,all-rights-reserved", ""),
        8: ("CC-BY-NC-4.0", ""),
        9: ("GPL-3.0-or-later", ""),
        11: ("Apache-2.0", ""),
        None: ("all-rights-reserved", ""),
    }
    assert (got[1].first_sentence, got[1].last_sentence, got[1].known_sentences) == (1, 5, 5)
    assert scan(docs).count() == 8
    assert scan(docs.where("false")).count() == 0


NOTICES = {
    "GPL-3.0-or-later": """Copyright (C) 2020 Someone

    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.

    This program is distributed in the hope that it will be useful,
    but WITHOUT ANY WARRANTY; without even the implied warranty of
    MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
    GNU General Public License for more details.
""",
    "LGPL-2.1-or-later": """/* This library is free software; you can redistribute it and/or
 * modify it under the terms of the GNU Lesser General Public
 * License as published by the Free Software Foundation; either
 * version 2.1 of the License, or (at your option) any later version.
 */""",
    "Apache-2.0": """Copyright 2020 Someone
# Licensed under the Apache License, Version 2.0 (the "License");
# you may not use this file except in compliance with the License.
# You may obtain a copy of the License at
#
#     http://www.apache.org/licenses/LICENSE-2.0
#
# Unless required by applicable law or agreed to in writing, software
# distributed under the License is distributed on an "AS IS" BASIS,
# WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
# See the License for the specific language governing permissions and
# limitations under the License.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED.""",
    "MPL-2.0": """// This Source Code Form is subject to the terms of the Mozilla Public
// License, v. 2.0. If a copy of the MPL was not distributed with this
// file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.""",
    "GPL-2.0-only": "/* SPDX-License-Identifier: GPL-2.0-only */\nint main;",
}


def test_official_notices_as_they_are_wrapped(spark):
    rows = list(enumerate(NOTICES.values()))
    rows.append((100, "Some title\nAll rights reserved\nReleased under the MIT License.\nMIT\n1.\nthe"))
    rows.append((101, "the\nlicense\n1. either\nWITHOUT"))
    got = {r.doc_id: r for r in scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    expected = {i: (name, "") for i, name in enumerate(NOTICES)}
    expected[100] = ("all-rights-reserved,MIT", "")
    assert {k: (r.licenses, r.unmatched) for k, r in got.items()} == expected
    assert (got[100].known_sentences, got[100].first_sentence, got[100].last_sentence) == (2, 1, 2)


# The bounded filter


def test_hash_filter_refuses_no_key(spark):
    keys = spark.range(0, 5000, 5).select(F.xxhash64("id").alias("k"))
    for bits in (1 << 24, 256):
        passes = hash_filter(keys, bits)
        assert keys.where(passes(F.col("k"))).count() == 1000
    passes = hash_filter(keys)
    others = spark.range(100_000, 120_000).select(F.xxhash64("id").alias("k"))
    assert others.where(passes(F.col("k"))).count() < 600
    assert others.where(hash_filter(keys.where("false"))(F.col("k"))).count() == 0


def test_a_key_that_is_allowed_and_blocked(spark):
    pages = spark.createDataFrame(
        [(1, "https://a.example.net/en/x"), (2, "https://other.com/"), (3, "https://free.com/")],
        "page_id long, url string",
    )
    both = (("example.net/en/", "allow"), ("example.net/en/", "block"))
    rules = urls.rows_of(spark, both, "key", "verdict")
    blocked = urls.rows_of(spark, (("other.com/",),), "key")
    got = {r.page_id: (r.rule, r.verdict) for r in urls.judge(pages, rules, blocked).collect()}
    assert got == {1: ("example.net/en/", "allow"), 2: (None, "block"), 3: (None, "allow")}
