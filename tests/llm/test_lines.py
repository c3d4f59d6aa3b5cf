"""Line dedup against a plain version of the template tree."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tickloom.llm import lines as operator
from tickloom.llm.components import components
from tickloom.llm.lines import cleaned, without_recurring_lines


def tokens(line):
    """The line's tokens, fields masked; as they are if they say too little without their numbers."""
    words = [w for w in line.replace("\t", " ").replace("\r", " ").split(" ") if w]
    masked = tuple("<*>" if any(c in "0123456789" for c in w) else w for w in words)
    constant = sum(w != "<*>" for w in masked)
    return masked if constant >= 3 and 2 * constant >= len(words) else tuple(words)


def alike(x, y):
    """One leaf, and eight of ten tokens behind the first five are equal."""
    if len(x) != len(y) or x[:5] != y[:5] or len(x) <= 5:
        return False
    if min(sum(w != "<*>" for w in z) for z in (x, y)) < 3:
        return False
    equal = sum(a == b for a, b in zip(x[5:], y[5:]))
    return 5 * equal >= 4 * (len(x) - 5)


def plain(docs):
    """Texts by key; ``docs`` maps keys to texts. Every pair of lines is compared."""
    where = defaultdict(set)
    for key, text in docs.items():
        for line in (text or "").split("\n"):
            if tokens(line):
                where[tokens(line)].add(key)
    leaves = defaultdict(list)
    for line in where:
        leaves[len(line), line[:5]].append(line)
    root = {line: line for line in where}

    def top(line):
        while root[line] != line:
            line = root[line]
        return line

    for lines in leaves.values():
        for i, x in enumerate(lines):
            for y in lines[:i]:
                if alike(x, y):
                    root[top(x)] = top(y)
    keys = defaultdict(set)
    for line in where:
        keys[top(line)] |= where[line]
    first = {line: min(keys[top(line)]) for line in where if len(keys[top(line)]) > 1}
    return {
        key: text if text is None else "\n".join(
            x for x in text.split("\n") if first.get(tokens(x), key) == key
        )
        for key, text in docs.items()
    }


def texts(spark, docs):
    rows = cleaned(spark.createDataFrame(list(docs.items()), "doc_id long, text string"))
    return {r.doc_id: r.text for r in rows.collect()}


TEN = "the river runs slowly home and people walk over bridges".split()


def line(*changes, words=TEN):
    words = list(words)
    for place, word in changes:
        words[place] = word
    return " ".join(words)


def test_strangers_do_not_undo_a_match(spark):
    docs = {1: line(), 2: line((7, "dogs")), 3: line(*((i, f"x{chr(97 + i)}") for i in range(5, 10)))}
    assert texts(spark, docs) == plain(docs) == {1: docs[1], 2: "", 3: docs[3]}


def test_lines_that_say_little_recur_word_for_word_only(spark):
    docs = {
        1: "2021\n12 45 67\nHe was born in the north\nUser 17 logged in at 10:45\n1.\npage 3 of 4",
        2: "1994\n99 1 3\nHe was born in the south\nUser 23 logged in at 11:02\n2.\npage 4 of 4",
        3: "2021\n12 45 67\n1.",
    }
    got = texts(spark, docs)
    assert got == plain(docs)
    assert got[2] == "1994\n99 1 3\nHe was born in the south\n2.\npage 4 of 4" and got[3] == ""


@pytest.mark.parametrize("small", [64, 3])
def test_many_forms_in_one_leaf(spark, monkeypatch, small):
    """A form letter with a name in it, unlike lines that begin as it does, chains of changes."""
    monkeypatch.setattr(operator, "SMALL_BLOCK", small)
    rng = random.Random(8)
    names = [f"n{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(150)]
    stock = [line((7, name)) for name in names]
    stock += [line(*((i, rng.choice(names)) for i in range(5, 10))) for _ in range(60)]
    long = TEN + [f"w{chr(97 + i)}" for i in range(20)]
    stock += [line((i, "other"), (i + 1, "other"), words=long) for i in range(5, 28)]
    docs = {i: "\n".join(rng.sample(stock, 4)) for i in range(70)}
    assert texts(spark, docs) == plain(docs)


def test_links_to_lines_that_left_a_large_block(spark):
    """Lines of the second document are similar to one line of the form letter each, and to no other."""
    names = [f"n{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(90)]
    docs = {
        1: "\n".join(line((7, name)) for name in names),
        2: "\n".join(line((7, name), (8, f"x{name}")) for name in names[::9]),
    }
    assert texts(spark, docs) == plain(docs) == {1: docs[1], 2: ""}


@pytest.mark.parametrize("small", [1, 4])
def test_size_of_blocks_changes_no_result(spark, monkeypatch, small):
    """Lines of few words, so that chains lead through many blocks."""
    monkeypatch.setattr(operator, "SMALL_BLOCK", small)
    rng = random.Random(small)
    docs = {}
    for key in range(60):
        rows = []
        for length, words in ((5, "abcdefghi"), (10, "abcde"), (15, "abc")):
            ends = [rng.choices(words, k=length) for _ in range(2)]
            rows += [" ".join(["the", "very", "same", "first", "words", *end]) for end in ends]
        docs[key] = "\n".join(rows)
    assert texts(spark, docs) == plain(docs)


def test_comparisons_of_near_copies_grow_with_their_number(spark, monkeypatch):
    """A letter, copies of it with one to eighteen changed words, often the same change; the copies
    with the most changes are unlike most others."""
    rng, n = random.Random(5), 400
    letter = TEN[:5] + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60)]
    forms = {tuple(letter)}
    while len(forms) < n:
        copy = list(letter)
        for place in rng.sample(range(5, 65), min(18, 1 + int(rng.expovariate(0.3)))):
            copy[place] = rng.choice(["same", f"x{rng.random()}"])
        forms.add(tuple(copy))
    forms = sorted(forms)
    compared = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def counted(one, other):
        compared.add(1)
        return sum(a == b for a, b in zip(one[5:], other[5:])) >= 0.8 * (len(one) - 5)

    monkeypatch.setattr(operator, "_similar", counted)
    # in an order that does not put the letter first
    rows = [(1, place, list(form)) for place, form in enumerate(rng.sample(forms, n))]
    links = operator._links(spark.createDataFrame(rows, "leaf long, line long, tokens array<string>"))
    found = {r.node: r.root for r in components(links).collect()}
    root = list(range(n))
    for i in range(n):
        for j in range(i):
            same = sum(a == b for a, b in zip(rows[i][2][5:], rows[j][2][5:]))
            if same >= 48 and root[i] != root[j]:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    assert [found.get(i, i) for i in range(n)] == root
    assert compared.value < 10 * n and links.count() < 2 * n


def test_a_very_long_token(spark):
    docs = {1: "a" * 300_000 + " b c d", 2: "a" * 300_000 + "7 b c d", 3: "b" * 200_000 + "9 b c d"}
    assert texts(spark, docs) == plain(docs) == {1: docs[1], 2: docs[2], 3: ""}


def test_random_texts(spark):
    rng = random.Random(6)
    stock = [" ".join(rng.choices("abcdefgh", k=rng.randint(1, 14))) for _ in range(60)]
    docs = {}
    for key in range(80):
        lines = []
        for _ in range(rng.randint(0, 8)):
            words = rng.choice(stock).split()
            if rng.random() < 0.4:
                words[rng.randrange(len(words))] = rng.choice(["x", "7", "v2"])
            lines.append("  ".join(words) if rng.random() < 0.2 else " ".join(words))
        docs[key] = "\n".join(lines)
    rows = cleaned(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    expected = plain(docs)
    assert {r.doc_id: r.text for r in rows} == expected
    for r in rows:
        assert r.dropped_lines == len(docs[r.doc_id].split("\n")) - (
            len(expected[r.doc_id].split("\n")) if expected[r.doc_id] or not docs[r.doc_id] else 0
        ) or not expected[r.doc_id]


LONG = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
ROWS = [
    (4, f"own line of four\n{LONG}\n\nUser 17 logged in at 10:45", "p"),
    (2, f"{LONG}\nsomething of two alone", "q"),
    (7, f"{LONG.replace('wordka', 'changed')}\nUser 23 logged in at 11:02\r\nown line of seven", "r"),
    (9, None, "s"),
    (10, "", "t"),
    (None, f"no id here\n{LONG}", "u"),
    (None, f"no id here\n{LONG}", "u"),
    (2, "something of two alone\nthe id is repeated", "v"),
    (11, "once\nonce", "w"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "doc_id long, text string, key string")


def test_cases(docs):
    got = without_recurring_lines(docs, dropped_col="dropped")
    assert got.columns == ["doc_id", "text", "key", "dropped"]
    rows = {r.key: r for r in got.collect()}
    assert rows["p"].text == "own line of four\n\nUser 17 logged in at 10:45"
    assert rows["q"].text == ROWS[1][1]
    assert rows["r"].text == "own line of seven"
    assert rows["s"].text is None and rows["s"].dropped == 0
    assert rows["t"].text == ""
    assert rows["u"].text == "no id here"
    assert rows["v"].text == ROWS[7][1]
    assert rows["w"].text == "once\nonce"
    assert got.count() == len(ROWS)


def test_no_rows(docs):
    assert without_recurring_lines(docs.where("false")).count() == 0


def test_long_text(spark):
    rows = [(1, "x y z\n" * 20_000 + "end"), (2, "x y z"), (3, "w" * 300_000)]
    got = {r.doc_id: r for r in cleaned(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[2].text == "" and got[1].dropped_lines == 0 and got[3].text == "w" * 300_000
