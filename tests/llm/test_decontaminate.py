"""Seeds cover two substitutions; overlaps against all alignments."""

import itertools
import random
import re

import numpy as np
import pytest

from tickloom.llm.decontaminate import (
    MASKS,
    SPAN,
    _known,
    _known_seeds,
    best_overlap,
    contamination,
    seeds,
    without_contaminated,
    word_hashes,
)


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]


def test_masks_cover_every_pair_of_substitutions():
    for pair in itertools.combinations(range(SPAN), 2):
        assert any(not set(pair) & set(mask) for mask in MASKS)


def test_stretches_with_two_substitutions_share_a_seed():
    rng = random.Random(1)
    item = words(rng, SPAN)
    for pair in itertools.combinations(range(SPAN), 2):
        copy = [f"new{i}" if i in pair else w for i, w in enumerate(item)]
        a, b = (list(seeds(word_hashes(" ".join(x)))) for x in (item, copy))
        assert any((p == q).all() for p, q in zip(a, b))


def test_words_of_ascii_and_other_texts():
    """Every ASCII sign between words, with a letter beyond ASCII behind it or not."""
    from xxhash import xxh64_intdigest

    text = "".join(f"Word{i}{chr(i)}" for i in range(128))
    expected = [xxh64_intdigest(w) for w in re.findall(r"\w+", text.lower())]
    assert word_hashes(text).tolist() == expected
    assert word_hashes(text + " \u00c9").tolist() == [*expected, xxh64_intdigest("\u00e9")]
    signs = word_hashes(text + " \u4f60\u597d").tolist()
    assert signs == [*expected, *map(xxh64_intdigest, "\u4f60\u597d")]


def test_seeds_of_many_texts_at_once():
    """As if each text were searched alone; no seed reaches into the next text."""
    rng = np.random.default_rng(7)
    texts = [rng.integers(0, 3, n).astype(np.uint64) for n in (0, 30, 9, 3, 0, 12, 1, 200, 4, 10, 2)]
    short = (3, 5, 9)
    bitmap = np.zeros(1 << 10, np.uint64)
    for seed in np.concatenate(list(seeds(texts[7][:60], short)))[::3]:
        for probe in range(3):
            bit = int(seed) >> 19 * probe & 0xFFFF
            bitmap[bit >> 6] |= np.uint64(1 << (bit & 63))
    expected = []
    for i, words in enumerate(texts):
        found = [(at, int(f[at])) for f in seeds(words, short) for at in _known(bitmap, f).tolist()]
        if found:
            expected.append((i, found))
    got = [(i, list(zip(at.tolist(), s.tolist()))) for i, at, s in _known_seeds(texts, bitmap, short)]
    assert got == expected and len(got) > 3
    assert list(_known_seeds(texts[:1], bitmap, short)) == []


def longest_by_hand(doc, item):
    least, best = min(SPAN, len(item)), None
    for diagonal in range(-len(item), len(doc)):
        begin, end = max(0, diagonal), min(len(doc), diagonal + len(item))
        for i in range(begin, end):
            for j in range(i + least, end + 1):
                equal = sum(doc[k] == item[k - diagonal] for k in range(i, j))
                if 5 * equal >= 4 * (j - i) and (best is None or j - i > best[0]):
                    best = (j - i, equal)
    return best


def test_best_overlap_is_the_longest():
    rng = np.random.default_rng(4)
    for _ in range(25):
        doc, item = rng.integers(0, 2, 30), rng.integers(0, 2, int(rng.integers(5, 25)))
        found = best_overlap(doc, item, list(range(-len(item), len(doc))))
        expected = longest_by_hand(doc, item)
        assert (found is None) == (expected is None)
        if found:
            start, item_start, length, matched = found
            assert length == expected[0]
            pairs = zip(doc[start : start + length], item[item_start : item_start + length])
            assert matched == sum(a == b for a, b in pairs) and 5 * matched >= 4 * length


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    items = [(0, " ".join(words(rng, 30))), (1, " ".join(words(rng, 6))), (2, "too short"), (3, None),
             (4, " ".join(words(rng, 12)).upper() + "."), (None, "an item that has no id of its own")]
    passage = items[0][1].split()
    swapped = [f"sub{i}" if i % 7 == 3 else w for i, w in enumerate(passage)]
    filler = lambda: " ".join(words(rng, 200))
    docs = [
        (10, f"{filler()} {items[0][1]} {filler()}"),
        (11, f"{filler()} {' '.join(swapped)} {filler()}"),
        (12, f"{filler()}, {items[1][1]}!"),
        (13, filler()),
        (14, None),
        (15, ""),
        (16, f"{items[4][1].lower()} {' '.join(passage[:5])}"),
        (17, f"too short {filler()}"),
        (None, items[0][1]),
        (18, "so: An Item that has no id of its own"),
        (10, f"{filler()} {items[0][1]} {filler()}"),
        (19, " ".join(words(rng, 30_000)) + " " + items[0][1]),
        (20, " ".join(passage[:9])),
    ]
    return (
        spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, digest int"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def test_contamination(tables):
    docs, items = tables
    rows = contamination(docs, items).collect()
    found = sorted((r.doc_id or -1, -1 if r.item_id is None else r.item_id) for r in rows)
    assert found == [(-1, 0), (10, 0), (10, 0), (11, 0), (12, 1), (16, 4), (18, -1), (19, 0)]
    by_doc = {r.doc_id: r for r in rows}
    assert (by_doc[11].length, by_doc[11].matched) == (30, 26)
    assert (by_doc[19].start, by_doc[19].length) == (30_000, 30)


def test_clean_documents_stay(tables):
    docs, items = tables
    kept = without_contaminated(docs, items)
    assert sorted(r.doc_id for r in kept.collect()) == [13, 14, 15, 17, 20]
    assert kept.columns == docs.columns


def test_empty_tables(tables):
    docs, items = tables
    assert contamination(docs.where("false"), items).count() == 0
    assert contamination(docs, items.where("false")).count() == 0
    assert without_contaminated(docs, items.where("false")).count() == docs.count()


SHORT_ITEMS = [
    (1, "seven wise owls watch quietly over nine sleeping foxes"),  # nine words
    (2, "copper kettles sing every morning"),  # five
    (3, "velvet harbour lantern"),  # three
    (4, "bare minimum"),  # too short to mean anything
    (5, "\u4f60\u597d\u4e16\u754c\u6b22\u8fce\u6765\u5230\u8fd9\u91cc\u5b66\u4e60"),  # twelve signs
]


def test_short_items(spark):
    """One substituted word is tolerated from five words on, at every place; shorter ones recur exactly."""
    docs, expected = [], set()
    for item, text in SHORT_ITEMS[:3]:
        words = text.split()
        for place in [None, *range(len(words))]:
            changed = [w if i != place else "other" for i, w in enumerate(words)]
            docs.append((100 * item + len(docs), f"before it all {' '.join(changed).upper()} and after"))
            if place is None or len(words) >= 5:
                expected.add((docs[-1][0], item))
    docs.append((900, "seven wise owls watch OTHER over nine ELSE foxes"))  # two substituted
    docs.append((901, "the bare minimum"))
    signs = SHORT_ITEMS[4][1]
    docs.append((902, "abc" + signs[:5] + "\u5929" + signs[6:] + "\u4e0d"))
    docs.append((903, signs[:6]))
    expected.add((902, 5))
    got = contamination(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(SHORT_ITEMS, "item_id long, text string"),
    ).collect()
    assert {(r.doc_id, r.item_id) for r in got} == expected and len(got) == len(expected)
