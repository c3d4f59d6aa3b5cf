"""Line dedup with a tree of line templates, in DataFrame operations alone.

The tree has a fixed depth: a line goes down by its number of tokens and by its first LEADING
tokens, where a token with a digit counts as a variable field. A leaf holds as many templates as its
lines have forms: two of its lines belong to one template if at least SIMILARITY of the tokens behind
the leading ones are equal, and so do lines that a chain of such pairs joins. Other lines of the leaf
take no part in that. A template that occurs in two or more documents stays in the first of them and
is dropped from the others.

A line with fewer than LEAST_CONSTANT tokens without digits, or with more fields than such tokens,
says too little for its numbers to be forgotten: it recurs only word for word.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import col, fresh, hash_filter, id_of, row_key, stage, text_of
from tickloom.llm.components import components

LEADING = 5
SIMILARITY = 0.8
LEAST_CONSTANT = 3
FIELD = "<*>"
SHORTEST = LEADING + round(1 / (1 - SIMILARITY))  # tokens; in fewer, no other token may differ
SMALL_BLOCK = 64  # lines that are all compared with one another

# a token with a digit; each character is looked at once, however long the token
_FIELD_TOKEN = "(?<![^ ])[^ 0-9]*+[0-9][^ ]*+"


def _plain(raw: Column) -> Column:
    """A line's tokens with single spaces between them; spaces, tabs and returns separate tokens."""
    odd = raw.startswith(" ") | raw.endswith(" ")
    for sign in ("\t", "\r", "  "):
        odd = odd | raw.contains(sign)
    return F.when(odd, F.trim(F.regexp_replace(raw, "[ \t\r]+", " "))).otherwise(raw)


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.translate(text, sign, ""))


def _lines(docs: DataFrame, id_col: str, text_col: str, *also: str) -> DataFrame:
    """Every line that is not blank: its document's ``key`` and ``mark``, its place, its template.

    ``leaf`` and ``line`` are 64-bit hashes; ``line`` stands for the line with its fields masked, or
    as it is if it recurs only word for word. ``wide`` lines can share a template with others.
    ``also`` adds ``masked``, their text.
    """
    # hashed before the lines are taken apart, so that these do not carry the text along
    parts = docs.select(
        row_key(id_col, text_col).alias("key"),
        F.xxhash64(text_of(text_col)).alias("mark"),
        F.split(text_of(text_col), "\n").alias("parts"),
    )
    rows = parts.select("key", "mark", F.posexplode("parts").alias("at", "raw"))
    plain = rows.select("key", "mark", "at", _plain(F.col("raw")).alias("plain")).where("plain <> ''")
    tokens = _count(F.col("plain"), " ") + 1
    digits = F.col("plain").rlike("[0-9]")
    masked = F.when(digits, F.regexp_replace("plain", _FIELD_TOKEN, FIELD)).when(
        F.col("plain").contains(FIELD), F.col("plain")
    )
    known = plain.select("*", tokens.alias("tokens"), masked.alias("masked"))
    fields = F.size(F.filter(F.split("masked", " "), lambda t: t == FIELD))
    constant = F.col("tokens") - F.when(F.col("masked").isNotNull(), fields).otherwise(0)
    general = (constant >= LEAST_CONSTANT) & (2 * constant >= F.col("tokens"))
    # a line without fields is itself, general or not
    own = F.when(general, F.coalesce("masked", "plain")).otherwise(F.col("plain"))
    wide = general & (F.col("tokens") >= SHORTEST)
    lines = known.select("key", "mark", "at", "tokens", own.alias("masked"), wide.alias("wide"))
    leading = F.substring_index("masked", " ", LEADING)
    leaf = F.when(F.col("wide"), F.xxhash64("tokens", leading)).otherwise(F.lit(0))
    return lines.select(
        "key", "mark", "at", leaf.alias("leaf"), F.xxhash64("masked").alias("line"), "wide", *also
    )


def _similar(one: Column, other: Column) -> Column:
    """Whether two lines of a leaf, as arrays, have enough equal tokens behind the leading ones."""
    equal = F.size(F.filter(F.zip_with(one, other, lambda x, y: x == y), lambda t: t)) - LEADING
    return equal >= SIMILARITY * (F.size(one) - LEADING)


def _may_differ(tokens: Column) -> Column:
    """How many tokens behind the leading ones may differ in similar lines of that length."""
    return F.floor((F.size(tokens) - LEADING) * (1 - SIMILARITY) + 1e-9).cast("int")


def _cut(blocks: DataFrame, turn: int) -> DataFrame:
    """Smaller blocks: lines of a block that can be similar meet in at least one of them.

    Behind the leading tokens a line is cut into one segment more than tokens may differ, at the same
    places for all lines of a block; so two similar lines agree in one segment at least. From turn 1
    on the tokens are dealt to the segments in an order that changes with the turn.
    """
    tokens = F.col("tokens")
    size = F.size(tokens) - LEADING
    cuts = _may_differ(tokens) + 1
    behind = F.slice(tokens, LEADING + 1, size)
    if turn:
        dealt = F.transform(behind, lambda t, i: F.struct(F.xxhash64(F.lit(turn), i), i, t.alias("t")))
        behind = F.transform(F.array_sort(dealt), lambda x: x["t"])

    def segment(i: Column) -> Column:
        start = F.floor(i * size / cuts).cast("int")
        stop = F.floor((i + 1) * size / cuts).cast("int")
        return F.xxhash64("block", F.lit(turn), i, F.slice("behind", start + 1, stop - start))

    segments = F.transform(F.sequence(F.lit(0), cuts - 1), segment)
    rows = blocks.select("block", "line", "side", "tokens", behind.alias("behind"))
    return rows.select(F.explode(segments).alias("block"), "line", "side")


def _spokes(pairs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Compares lines with the first of their block: whether they are ``near`` it, and ``keys``.

    A key is a place at which the line differs from the first, with its token there. A line that is
    not near differs in more places than it may from a near one, so it has the same keys in some of
    them; any selection of one more key than tokens may differ holds one of those. Lines that differ
    from the first in more than twice as many places cannot be similar to a near one: null.
    ``pairs`` has ``first``, its ``rank`` and ``line``.
    """
    words = {c: tokens.toDF(c, f"{c}_tokens") for c in ("first", "line")}
    both = pairs.join(words["first"], "first").join(words["line"], "line")
    one, other = F.col("line_tokens"), F.col("first_tokens")
    own = F.zip_with(one, other, lambda x, y: F.when(x != y, x))
    places = F.transform(own, lambda x, i: F.when(x.isNotNull(), F.xxhash64(i, x)))
    found = both.select(
        "first", "rank", "line", _similar(one, other).alias("near"),
        F.filter(places, lambda x: x.isNotNull()).alias("keys"), _may_differ(one).alias("most"),
    )
    keys = F.when(F.col("near"), F.col("keys")).when(
        F.size("keys") <= 2 * F.col("most"), F.slice("keys", F.lit(1), F.col("most") + 1)
    )
    return found.select("first", "rank", "line", "near", keys.alias("keys"))


def _compared(small: DataFrame, tokens: DataFrame, hubs: DataFrame | None) -> DataFrame:
    """The similar pairs ``a``, ``b`` of small blocks, less those that share a ``hub``."""
    columns, apart = ["line", "side"], F.lit(True)
    if hubs is not None:
        small = small.join(hubs, "line", "left")
        columns += ["hub"]
        apart = ~F.coalesce(F.col("hub_a") == F.col("hub_b"), F.lit(False))
    one, other = (
        small.select("block", *(F.col(x).alias(c if x == "line" else f"{x}_{c}") for x in columns))
        for c in "ab"
    )
    sides = (F.col("side_a") == 0) | (F.col("side_a") != F.col("side_b"))
    pairs = one.join(other, "block").where((F.col("a") < F.col("b")) & sides & apart)
    words = {c: tokens.toDF(c, f"tokens_{c}") for c in "ab"}
    both = pairs.select("a", "b").distinct().join(words["a"], "a").join(words["b"], "b")
    return both.where(_similar(F.col("tokens_a"), F.col("tokens_b"))).select("a", "b")


def _links(lines: DataFrame) -> DataFrame:
    """Pairs ``a``, ``b`` of similar lines, from which every template follows.

    ``lines`` has ``leaf``, ``line`` and ``tokens`` of the wide lines of ambiguous leaves. In a block
    of up to SMALL_BLOCK lines all are compared. In a larger one, such as a form letter's with a
    name for each recipient, all are compared with the first; those near it are linked to it and to
    each other thereby. First is the line that met most others in the blocks of its leaf, as the
    letter itself does and a letter with many changes does not; so few are left that are not near it.
    Lines of small blocks that are near one first, their hub, are not compared again.

    The lines left make a smaller block, which is cut further if it is the greater part. Some of
    them may be similar to lines near the first. The two sides make a block in which only lines of
    different ``side`` are compared, if these are few pairs. Else two similar lines both differ from
    the first by an equal token at one place, and there is a block for each place and token; it is
    compared at once if one side has up to SMALL_BLOCK lines. So no pair is passed over whatever the size of its block; as the
    first line of a block is in none that comes of it, and all in it follow in one order of the
    lines, blocks run out.
    """
    leaves = lines.select(F.col("leaf").alias("block"), "line", F.lit(0).alias("side"), "tokens")
    blocks = stage(_cut(leaves, 0), "blocks")
    links = ranks = stars = hubs = None
    turn = 0
    tokens = lines.select("line", "tokens")
    while True:
        sides = [F.count_if(F.col("side") == i) for i in (1, 2)]
        sizes = blocks.groupBy("block").agg(
            F.count("*").alias("n"), F.min("side").alias("low"), F.max("side").alias("high"),
            F.least(*sides).alias("less"),
        )
        few = F.when(F.col("high") == 0, F.col("n")).otherwise(F.col("less"))
        sizes = sizes.where("n > 1 AND (high = 0 OR low < high)").select(
            "block", "n", (few <= SMALL_BLOCK).alias("small")
        )
        known = stage(blocks.join(sizes, "block"), "blocks")
        large = known.where("NOT small")
        last = large.isEmpty()
        if not last:
            if ranks is None:
                met = known.groupBy("line").agg(F.sum(-F.col("n")).alias("rank"))
                ranks = stage(met.join(large.select("line"), "line", "left_semi"), "ranks")
            least = large.join(ranks, "line").groupBy("block").agg(F.min(F.struct("rank", "line")).alias("x"))
            firsts = least.select("block", "x.rank", F.col("x.line").alias("first"))
            large = stage(large.join(firsts, "block").where("line <> first"), "blocks")
            spokes = stage(_spokes(large.select("first", "rank", "line").distinct(), tokens), "spokes")
            near = spokes.where("near")
            star = near.select(F.col("first").alias("a"), F.col("line").alias("b"))
            links = star if links is None else links.unionByName(star)
            around = near.select("rank", "first", F.explode(F.array("line", "first")).alias("line"))
            stars = around if stars is None else stars.unionByName(around)
            hubs = stars.groupBy("line").agg(F.min(F.struct("rank", "first")).alias("x"))
            hubs = stage(hubs.select("line", F.col("x.first").alias("hub")), "hubs")
        found = stage(_compared(known.where("small"), tokens, hubs), "links")
        links = found if links is None else links.unionByName(found)
        if last:
            return links
        turn += 1
        left = large.join(spokes.where("NOT near").select("first", "line"), ["first", "line"])
        shares = left.groupBy("block").agg(F.count("*").alias("left"))
        left = left.join(shares, "block").withColumn(
            "cut", (F.col("left") > SMALL_BLOCK) & (2 * F.col("left") > F.col("n"))
        )
        reach = spokes.where("keys IS NOT NULL")
        around = reach.groupBy("first").agg(
            (F.count_if(F.col("near")) * F.count_if(~F.col("near"))).alias("pairs")
        )
        whole = F.array(F.lit(0).cast("bigint"))
        keyed = reach.join(around.where("pairs > 0"), "first").select(
            F.explode(F.when(F.col("pairs") <= SMALL_BLOCK**2, whole).otherwise(F.col("keys"))).alias("key"),
            "first", "line", F.when(F.col("near"), 1).otherwise(2).alias("side"),
        ).select(F.xxhash64("first", "key").alias("block"), "line", "side")
        others = keyed.where("side = 2")
        met = keyed.where("side = 1").join(others.select("block"), "block", "left_semi")
        again = left.where("NOT cut").select("block", "line", "side")
        again = again.unionByName(_cut(left.where("cut").join(tokens, "line"), turn))
        blocks = stage(again.unionByName(met).unionByName(others), "blocks")


def recurring(docs: DataFrame, lines: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``line`` and ``first`` of lines whose template occurs in several documents.

    ``first`` is the key of the first document, which keeps them. ``lines`` are those of ``docs``.
    Words are read again only from the first documents of lines whose leaf holds several distinct
    ones; filters of bounded size spare the other documents the work.
    """
    distinct = stage(
        lines.groupBy("leaf", "line", "wide").agg(F.min("key").alias("lo"), F.max("key").alias("hi")),
        "distinct-lines",
    )
    leaves = (
        distinct.where("wide")
        .groupBy("leaf")
        .agg(F.min("lo").alias("least"), F.max("hi").alias("most"), F.count("*").alias("n"))
        .where("n > 1 AND least < most")
        .select("leaf")
    )
    asked = distinct.where("wide").join(leaves, "leaf", "left_semi").select("line", "lo")
    asked = stage(asked, "ambiguous-lines")
    first_docs, wanted = hash_filter(asked.select("lo").distinct()), hash_filter(asked.select("line"))
    some = docs.where(first_docs(row_key(id_col, text_col)))
    read = (
        # out of a generator the columns are not computed again for every probe of the filter
        _lines(some, id_col, text_col, "masked")
        .select(F.inline(F.array(F.struct("leaf", "line", "wide", "masked"))))
        .where("wide")
        .where(wanted(F.col("line")))
        .join(asked.select("line"), "line", "left_semi")
        .groupBy("leaf", "line")
        .agg(F.min("masked").alias("masked"))
    )
    words = stage(read.select("leaf", "line", F.split("masked", " ").alias("tokens")), "words")
    roots = components(_links(words)).select(F.col("node").alias("line"), "root")
    template = F.coalesce("root", "line")
    owned = stage(
        distinct.join(roots, "line", "left").select("line", "lo", "hi", template.alias("template")),
        "templates",
    )
    spread = owned.groupBy("template").agg(F.min("lo").alias("first"), F.max("hi").alias("last"))
    return owned.join(spread.where("first < last"), "template").select("line", "first")


def without_recurring_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    dropped_col: str | None = None,
) -> DataFrame:
    """``docs`` with the recurring lines dropped from all documents but the first that has them.

    Lines end at line feeds. Blank lines are never dropped; the lines that stay are joined by line
    feeds again, so a document that loses none keeps its text as it is, and one that loses all has
    an empty text. No document is removed. The first document is the one with the smallest id; rows
    without an id come after all others, told apart by their texts; rows that share an id are one
    document. A null text stays null and counts as empty. ``dropped_col`` adds the number of lines
    dropped. Columns of any other name are carried along, an empty table gives none. Only documents
    that may lose lines are shuffled.
    """
    key, mark, gone = fresh(docs, "key", "mark", "gone")
    lines = stage(_lines(docs, id_col, text_col), "lines")
    again = stage(recurring(docs, lines, id_col, text_col), "recurring-lines")
    drops = (
        lines.join(again, "line")
        .where("key <> first")
        .groupBy(F.col("key").alias(key), F.col("mark").alias(mark))
        .agg(F.collect_set("at").alias(gone))
    )
    drops = stage(drops, "dropped-lines")
    rows = docs.withColumns(
        {key: row_key(id_col, text_col), mark: F.xxhash64(text_of(text_col))}
    )
    changes = hash_filter(drops.select(mark).distinct())(F.col(mark))
    joined = rows.where(changes).join(drops, [key, mark], "left")
    parts = F.split(col(text_col), "\n")
    left = F.filter(parts, lambda _, i: ~F.array_contains(F.col(gone), i))
    text = F.when(F.col(gone).isNull(), col(text_col)).otherwise(F.array_join(left, "\n"))
    changed = joined.withColumn(text_col, text)
    same = rows.where(~changes).withColumn(gone, F.lit(None).cast("array<int>"))
    result = changed.select(*map(col, same.columns)).unionByName(same)
    if dropped_col:
        result = result.withColumn(dropped_col, F.coalesce(F.size(gone), F.lit(0)))
    return result.drop(key, mark, gone)


def cleaned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text`` and ``dropped_lines`` of every row."""
    rows = docs.select(col(id_col).alias("doc_id"), col(text_col).alias("text"))
    found = without_recurring_lines(rows, dropped_col="dropped_lines")
    return found.select(id_of(F.col("doc_id")).alias("doc_id"), "text", "dropped_lines")


CLEANED_SQL = f"""
WITH RECURSIVE docs AS (SELECT doc_id, text, row_number() OVER () AS rid FROM documents),
raw AS (SELECT rid, doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place FROM docs),
words AS (SELECT rid, doc_id, place,
                 string_split(trim(regexp_replace(line, '[ \\t\\r]+', ' ', 'g'), ' '), ' ') AS v
          FROM raw),
masked AS (SELECT *, [CASE WHEN regexp_matches(t, '[0-9]') THEN '{FIELD}' ELSE t END FOR t IN v] AS w
           FROM words WHERE v <> ['']),
counted AS (SELECT *, len([t FOR t IN w IF t <> '{FIELD}']) AS c FROM masked),
known AS (SELECT rid, doc_id, place,
                 c >= {LEAST_CONSTANT} AND 2 * c >= len(w) AS general,
                 CASE WHEN c >= {LEAST_CONSTANT} AND 2 * c >= len(w) THEN w ELSE v END AS w
          FROM counted),
dl AS (SELECT w, bool_or(general) AS general, min(doc_id) AS lo, max(doc_id) AS hi
       FROM known GROUP BY w),
wide AS (SELECT w, [len(w)::VARCHAR] || w[1:{LEADING}] AS leaf FROM dl
         WHERE general AND len(w) >= {SHORTEST}),
links AS (SELECT x.w AS a, y.w AS b FROM wide x JOIN wide y ON x.leaf = y.leaf AND x.w <> y.w
          WHERE len([i FOR i IN range({LEADING} + 1, len(x.w) + 1) IF x.w[i] = y.w[i]])
                >= {SIMILARITY} * (len(x.w) - {LEADING})),
reach AS (SELECT a AS w, a AS r FROM links UNION SELECT l.b, reach.r FROM reach JOIN links l ON l.a = reach.w),
roots AS (SELECT w, min(r) AS template FROM reach GROUP BY w),
owned AS (SELECT dl.w, lo, hi, coalesce(template, dl.w) AS template FROM dl LEFT JOIN roots USING (w)),
spread AS (SELECT template, min(lo) AS first, max(hi) AS last FROM owned GROUP BY template),
gone AS (SELECT rid, place FROM known JOIN owned USING (w) JOIN spread USING (template)
         WHERE first < last AND doc_id <> first),
kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY place) FILTER (WHERE g.rid IS NULL) AS text,
                count(g.rid) AS dropped_lines
         FROM raw LEFT JOIN gone g USING (rid, place) GROUP BY rid)
SELECT doc_id, CASE WHEN docs.text IS NULL THEN NULL ELSE coalesce(kept.text, '') END AS text,
       CAST(dropped_lines AS INTEGER) AS dropped_lines
FROM docs JOIN kept USING (rid)
"""
