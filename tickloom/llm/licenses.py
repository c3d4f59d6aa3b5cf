"""Licence scan by sentence rules.

A text is cut into sentences, which are normalised to their words in lower case. Sentences that are
known from licence texts become identifiers; between them a break stands for any other sentences.
The sequence of identifiers is then matched against an ordered list of rules: each rule is a
sequence of identifiers, and what an earlier rule has matched is no longer there for a later one.

A known sentence may be wrapped at any word, so the pieces of lines that make it up are put together
again if no sentence ends between them. Lines that are known by themselves stay sentences.
"""

from __future__ import annotations

import re
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, id_of, row_key, text_of

# Sentences of well-known licences and notices, by identifier.
SENTENCES = {
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-licensed-the": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-compliance": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": (
        "Unless required by applicable law or agreed to in writing, software distributed under the "
        "License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY "
        "KIND, either express or implied."
    ),
    "apache-see": (
        "See the License for the specific language governing permissions and limitations under "
        "the License."
    ),
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files (the \"Software\"), to deal in the Software "
        "without restriction, including without limitation the rights to use, copy, modify, merge, "
        "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
        "to whom the Software is furnished to do so, subject to the following conditions:"
    ),
    "mit-notice": (
        "The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software."
    ),
    "gpl3-licensed": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software;",
    "gpl-redistribute-3": (
        "you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation;"
    ),
    "gpl-version-3-later": "either version 3 of the License, or (at your option) any later version.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "Released under CC0 1.0.",
    "reserved": "All rights reserved.",
}

# Licences by their sentences; the first rule that matches takes its sentences.
RULES = (
    ("Apache-2.0", ("apache-licensed-the", "apache-compliance", "apache-copy", "apache-as-is", "apache-see")),
    ("Apache-2.0", ("apache-licensed-the", "apache-compliance")),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-redistribute-3", "gpl-version-3-later")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("Apache-2.0", ("apache-licensed",)),
    ("GPL-3.0-only", ("gpl3-licensed",)),
    ("CC-BY-NC-4.0", ("cc-by-nc-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC0-1.0", ("cc0",)),
    ("all-rights-reserved", ("reserved",)),
)
BREAK = "|"

# The free software notices by licence name, "this program" or "this library" apart.
_GNU = {
    "GPL-2.0": "General Public License",
    "GPL-3.0": "General Public License",
    "LGPL-2.0": "Library General Public License",
    "LGPL-2.1": "Lesser General Public License",
    "LGPL-3.0": "Lesser General Public License",
    "AGPL-3.0": "Affero General Public License",
}
_UNDER = "you can redistribute it and/or modify it under the terms of the GNU {} as published by the Free Software Foundation"

# Sentences of the licences' official texts and notices.
NOTICES = {
    "mit-as-is": (
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR "
        "PURPOSE AND NONINFRINGEMENT."
    ),
    "mit-no-event": (
        "IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR "
        "OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF "
        "OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-forms": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:"
    ),
    "bsd-source": (
        "Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer."
    ),
    "bsd-binary": (
        "Redistributions in binary form must reproduce the above copyright notice, this list of "
        "conditions and the following disclaimer in the documentation and/or other materials "
        "provided with the distribution."
    ),
    "bsd-names": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior written "
        "permission."
    ),
    "bsd-as-is": (
        "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
        "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF "
        "MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
        "without fee is hereby granted, provided that the above copyright notice and this permission "
        "notice appear in all copies."
    ),
    "isc-as-is": (
        "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
        "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS."
    ),
    "mpl-2": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."
    ),
    "mpl-copy": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "https://mozilla.org/MPL/2.0/."
    ),
    "mpl-copy-http": (
        "If a copy of the MPL was not distributed with this file, You can obtain one at "
        "http://mozilla.org/MPL/2.0/."
    ),
    "gnu-free-library": "This library is free software;",
    "gnu-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gnu-hope-library": "This library is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY;",
    "gnu-implied": (
        "without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
    ),
    "gnu-version-2-only": "version 2 of the License.",
    "gnu-version-2-later": "either version 2 of the License, or (at your option) any later version.",
    "gnu-version-2.1-later": "either version 2.1 of the License, or (at your option) any later version.",
}
NOTICES |= {f"gnu-under-{kind}": _UNDER.format(kind) + ";" for kind in _GNU.values() if kind != "General Public License"}
NOTICES |= {f"gnu-see-{kind}": f"See the GNU {kind} for more details." for kind in _GNU.values()}
NOTICES |= {
    f"gnu-{name}-later": f"{_UNDER.format(kind)}, either version {name[-3:].removesuffix('.0')} of the License, or (at your option) any later version."
    for name, kind in _GNU.items()
}
NOTICES |= {
    f"gnu-{name}-only": f"{_UNDER.format(kind)}, version {name[-3:].removesuffix('.0')} of the License."
    for name, kind in _GNU.items()
}

# Licences that a tag of one identifier names.
_TAGGED = (
    "0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause",
    "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0", "EPL-2.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0-only", "GPL-3.0-or-later", "ISC", "LGPL-2.0-only",
    "LGPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only",
    "LGPL-3.0-or-later", "MIT", "MPL-2.0", "Unlicense", "Zlib",
)
NOTICES |= {f"spdx-{name}": f"SPDX-License-Identifier: {name}" for name in _TAGGED}


def _gnu_rules() -> list[tuple[str, tuple[str, ...]]]:
    rules = []
    for name, kind in _GNU.items():
        version = name[-3:].removesuffix(".0")
        under = "gpl-redistribute-3" if kind == "General Public License" else f"gnu-under-{kind}"
        later = "gpl-version-3-later" if version == "3" else f"gnu-version-{version}-later"
        heads = [("or-later", (f"gnu-{name}-later",)), ("or-later", (under, later)), ("only", (f"gnu-{name}-only",))]
        if version == "2":
            heads.append(("only", (under, "gnu-version-2-only")))
        for which, head in heads:
            for free, hope in (("gpl-free", "gnu-hope"), ("gnu-free-library", "gnu-hope-library")):
                rules.append((f"{name}-{which}", (free, *head, hope, "gnu-implied", f"gnu-see-{kind}")))
                rules.append((f"{name}-{which}", (free, *head)))
    return rules


# Licences by the sentences of their notices, the longest first; they come before RULES.
NOTICE_RULES = (
    ("MIT", ("mit-grant", "mit-notice", "mit-as-is", "mit-no-event")),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-names", "bsd-as-is")),
    ("BSD-3-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-names")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary", "bsd-as-is")),
    ("BSD-2-Clause", ("bsd-forms", "bsd-source", "bsd-binary")),
    ("ISC", ("isc-grant", "isc-as-is")),
    ("ISC", ("isc-grant",)),
    ("MPL-2.0", ("mpl-2", "mpl-copy")),
    ("MPL-2.0", ("mpl-2", "mpl-copy-http")),
    ("MPL-2.0", ("mpl-2",)),
    *_gnu_rules(),
    *((name, (f"spdx-{name}",)) for name in _TAGGED),
)

COMMENT = "\n[ \t]*[#*/;]+[ \t]*"
WRAPPED = "([^.!?;:\n])\n+[ \t]*([a-z])"
END = "([.!?;:])[ \t]+"
TAG = "((?i)SPDX-License-Identifier:[^\n]*)"  # ends with its line, whatever comes next
# A line that does not end a sentence; the next one, if not blank, is marked as going on with it.
GOES_ON, MARK = "([^.!?;:\\s])[ \t\r]*\n(?=[ \t\r]*[^ \t\r\n])", "\x01"
LIST_SIGN = "(?:[0-9]{1,2}|[a-z])"


def _sentences(text: Column) -> Column:
    """Normalised sentences, with whether each may go on with the one before it.

    They end at line feeds and at .!?;: before white space. A line that begins in lower case,
    comment signs aside, goes on with the line before it, unless that one ends a sentence; what
    begins with any other sign may go on with it.
    """
    steps = (
        (COMMENT, "\n"), (TAG, "$1."), (WRAPPED, "$1 $2"), (END, "$1\n"), (GOES_ON, f"$1\n{MARK}")
    )
    for pattern, instead in steps:
        text = F.regexp_replace(text, pattern, instead)
    parts = F.split(F.translate(text, ascii_uppercase, ascii_lowercase), "\n")
    words = F.transform(
        parts,
        lambda s: F.struct(
            F.trim(F.regexp_replace(s, "[^a-z0-9]+", " ")).alias("words"),
            s.startswith(MARK).alias("goes_on"),
        ),
    )
    return F.filter(words, lambda s: s["words"] != "")


def _fragments(sentences: dict[str, str]) -> set[str]:
    """What a line can hold of a known sentence, and the signs that number a list."""
    found = {*map(str, range(100)), *ascii_lowercase}
    for text in sentences.values():
        words = normalised(text).split()
        ends = range(1, len(words) + 1)
        found |= {" ".join(words[a:b]) for b in ends for a in range(b)}
    return found


def _pattern(sentence: str) -> str:
    """Finds a known sentence among lines that are numbered like ``\\n7#words`` or ``~8#words``.

    A tilde stands before a line that goes on with the one before it.
    """
    parts = [normalised(part) for part in re.sub(END, r"\1\n", sentence).split("\n")]
    inner = "[~\n][0-9]+#".join(p.replace(" ", "(?: |~[0-9]+#)") for p in parts if p)
    return f"[~\n]([0-9]+)#{inner}(?=[~\n{BREAK}]|$)"


def normalised(sentence: str) -> str:
    """The same for one known sentence."""
    lower = "".join(c.lower() if c in ascii_uppercase else c for c in sentence)
    return " ".join("".join(c if c in ascii_lowercase or c.isdecimal() else " " for c in lower).split())


def scan(
    docs: DataFrame,
    sentences: dict[str, str] | None = None,
    rules: tuple[tuple[str, tuple[str, ...]], ...] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document that has a known sentence.

    ``doc_id``; ``licenses``, the licences in their order in the text, joined by commas, empty if no
    rule matches; ``unmatched``, the identifiers that no rule took, likewise; ``known_sentences``,
    their number; ``first_sentence`` and ``last_sentence``, where the first and last of them
    begin among the text's sentences, from 0; a wrapped sentence counts with each of its lines that
    does not begin in lower case. Null and empty texts have no sentences and give no row, nor
    does an empty table; rows without an id are told apart by their text; rows with the same id and
    text are one document. Other columns are not read.
    """
    sentences = SENTENCES | NOTICES if sentences is None else sentences
    rules = NOTICE_RULES + RULES if rules is None else rules
    spark = docs.sparkSession
    known = spark.createDataFrame([(f,) for f in sorted(_fragments(sentences))], "words string")
    # hashed before the sentences are taken apart, so that these do not carry the text along
    parts = docs.select(
        row_key(id_col, text_col).alias("key"),
        F.xxhash64(text_of(text_col)).alias("mark"),
        _sentences(text_of(text_col)).alias("parts"),
    )
    rows = parts.select("key", "mark", F.posexplode("parts").alias("at", "part"))
    rows = rows.select("key", "mark", "at", "part.words", "part.goes_on")
    # the known sentences' fragments are the arguments' own few rows
    found = rows.join(F.broadcast(known), "words").distinct()
    lines = found.groupBy("key", "mark").agg(
        F.sort_array(F.collect_list(F.struct("at", "words", "goes_on"))).alias("lines")
    )
    # consecutive lines stand side by side, a break between others
    sequence = F.array_join(
        F.transform(
            "lines",
            lambda h, i: F.concat(
                F.when((i == 0) | (F.get("lines", i - 1)["at"] != h["at"] - 1), f"{BREAK}\n")
                .when(h["goes_on"], "~")
                .otherwise("\n"),
                h["at"].cast("string"),
                F.lit("#"),
                h["words"],
            ),
        ),
        "",
    )
    # the longest first; then list signs go, and lines that make up no sentence are breaks
    for name in sorted(sentences, key=lambda n: -len(normalised(sentences[n]).split())):
        sequence = F.regexp_replace(sequence, _pattern(sentences[name]), f"\n<$1:{name}>")
    sequence = F.regexp_replace(sequence, f"[~\n][0-9]+#{LIST_SIGN}(?=[~\n{BREAK}]|$)", "")
    sequence = F.regexp_replace(sequence, "[~\n][0-9]+#[a-z0-9 ]+", BREAK)
    sequence = F.translate(sequence, "\n", "")
    # out of a generator it is not computed again for every column
    placed = lines.select("key", "mark", F.explode(F.array(sequence)).alias("sequence"))
    at = F.regexp_extract_all("sequence", F.lit("<([0-9]+):"), F.lit(1))
    hits = placed.withColumn("at", at).where(F.size("at") > 0)
    sequence = F.regexp_replace("sequence", "<[0-9]+:", "<")
    for name, parts in rules:
        wanted = "".join(f"<{p}>" for p in parts)
        sequence = F.replace(sequence, F.lit(wanted), F.lit(f"{{{name}}}"))
    resolved = hits.withColumn("sequence", sequence)

    def joined(opened: str, closed: str) -> Column:
        pattern = rf"\{opened}([^{closed}]*)\{closed}" if opened == "{" else f"{opened}([^{closed}]*){closed}"
        return F.array_join(F.regexp_extract_all("sequence", F.lit(pattern), F.lit(1)), ",")

    return resolved.select(
        id_of(F.col("key")).alias("doc_id"),
        joined("{", "}").alias("licenses"),
        joined("<", ">").alias("unmatched"),
        F.size("at").alias("known_sentences"),
        F.element_at("at", 1).cast("int").alias("first_sentence"),
        F.element_at("at", -1).cast("int").alias("last_sentence"),
    )


def _scan_sql() -> str:
    """The rules for sentences of one line. Wrapped notices and NOTICES are the operator's alone."""
    known = ", ".join(f"('{name}', '{normalised(text)}')" for name, text in SENTENCES.items())
    sequence = "string_agg(gap || '<' || name || '>', '' ORDER BY at_)"
    for name, parts in RULES:
        wanted = "".join(f"<{p}>" for p in parts)
        sequence = f"replace({sequence}, '{wanted}', '{{{name}}}')"
    text = "coalesce(text, '')"
    for pattern, instead in ((COMMENT, "chr(10)"), (WRAPPED, r"'\1 \2'"), (END, r"'\1' || chr(10)")):
        text = f"regexp_replace({text}, '{pattern}', {instead}, 'g')"
    return f"""
WITH known(name, sentence) AS (VALUES {known}),
parts AS (SELECT DISTINCT doc_id, text, list_filter(
              [trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'), ' ') FOR s IN string_split(
                  translate({text}, '{ascii_uppercase}', '{ascii_lowercase}'), chr(10))],
              lambda s: s <> '') AS sentences FROM documents),
rows_ AS (SELECT doc_id, text, unnest(sentences) AS sentence,
                 generate_subscripts(sentences, 1) - 1 AS at_ FROM parts),
hits AS (SELECT doc_id, text, name, at_,
                CASE WHEN at_ = lag(at_) OVER (PARTITION BY doc_id, text ORDER BY at_) + 1 THEN ''
                     ELSE '{BREAK}' END AS gap FROM rows_ JOIN known USING (sentence)),
done AS (SELECT doc_id, {sequence} AS sequence, count(*) AS n, min(at_) AS lo, max(at_) AS hi
         FROM hits GROUP BY doc_id, text)
SELECT doc_id, array_to_string(regexp_extract_all(sequence, '\\{{([^}}]*)\\}}', 1), ',') AS licenses,
       array_to_string(regexp_extract_all(sequence, '<([^>]*)>', 1), ',') AS unmatched,
       CAST(n AS INTEGER) AS known_sentences, CAST(lo AS INTEGER) AS first_sentence,
       CAST(hi AS INTEGER) AS last_sentence
FROM done
"""


SCAN_SQL = _scan_sql()
