import random
import re
import zlib
from collections import Counter

import pytest

from reelstat.llm import spelling
from reelstat.llm.spelling import near_words, spelling_variants, word_counts

LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))


def lowered(s):
    return re.sub("[A-Z]", lambda m: m[0].lower(), s)


def brute_counts(rows, drop_one_in=199, min_length=6, min_count=5):
    n = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if drop_one_in and h % drop_one_in == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += len(run) >= min_length
    return {w: k for w, k in n.items() if k >= min_count}


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(n, ratio=5):
    forms, out = {}, {}
    for w in n:
        others = [x for x in n if near(w, x)]
        best = min(others, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= ratio * n[w] else None
        out[w] = len(others)
    rows = []
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        rows.append((w, forms[w], root, n[w], out[w], n[forms[w]] if forms[w] is not None else None))
    return sorted(rows)


def result(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("drop,length,least", [(199, 6, 5), (3, 2, 1), (0, 1, 2)])
def test_counts_equal_brute_force(odd, odd_rows, drop, length, least):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = {r["word"]: r["n"] for r in word_counts(odd, drop_one_in=drop, min_length=length, min_count=least).collect()}
    assert got == brute_counts(rows, drop, length, least)


def test_variants_equal_brute_force(spark):
    """Few letters, so that rows of equal letters, shared neighbours, ties and chains abound."""
    rng = random.Random(3)
    n = {"".join(rng.choice("aabé") for _ in range(rng.randint(1, 6))): rng.choice([1, 1, 2, 3, 5, 9, 25, 26, 130]) for _ in range(220)}
    n[""] = 700
    got = result(spelling_variants(spark.createDataFrame([*n.items()], "word string, n long")))
    assert got == brute(n)
    assert any(root not in (word, form) for word, form, root, *_ in got)        # a chain


def test_a_word_with_a_neighbour_for_every_letter(spark):
    base = "gewitter"
    n = {base: 5000} | {base[:3] + c + base[4:]: 10 + i for i, c in enumerate(LETTERS) if c != base[3]}
    got = {r[0]: r for r in result(spelling_variants(spark.createDataFrame([*n.items()], "word string, n long")))}
    assert all(r[4] == len(LETTERS) - 1 for r in got.values())
    assert got[base][1] is None and all(r[1] == base for w, r in got.items() if w != base)


def test_rotations_have_every_edit_as_one_range(spark):
    rows = spelling.rotations(spark.createDataFrame([("abb", 1)], "word string, n long")).collect()
    assert sorted((r["prefix"], r["skipped"], r["first"]) for r in rows) == sorted(
        [("abb\0", False, False), ("bb\0a", False, False), ("b\0ab", False, False), ("\0abb", False, False),
         ("bb\0", True, True), ("b\0a", True, True), ("\0ab", True, False)])


def test_odd_words(spark, none):
    words = spark.createDataFrame([("abc", 3, "x"), ("abc", 4, "y"), (None, 9, "z"), ("a\0c", 1, ""), ("ac", None, "")],
                                  "word string, n long, near string")
    assert {tuple(r) for r in spelling_variants(words).collect()} == {
        ("abc", None, "abc", 7, 1, None), (None, None, None, 9, 0, None), ("a\0c", None, "a\0c", 1, 0, None),
        ("ac", "abc", "abc", 0, 1, 7)}
    assert spelling_variants(word_counts(none)).count() == 0
    with pytest.raises(ValueError):
        spelling_variants(words, ratio=1)


def test_hot_word(spark):
    """A word with a third of all occurrences arrives as a count."""
    docs = spark.createDataFrame([(i, "wonder " * 500 + "wander wunder") for i in range(30)], "doc_id long, text string")
    words = word_counts(docs, drop_one_in=0)
    assert {r["word"]: r["n"] for r in words.collect()} == {"wonder": 15000, "wander": 30, "wunder": 30}
    assert {r["word"]: (r["near"], r["n_near"]) for r in near_words(words).collect()} == {
        "wonder": ("wander", 2), "wander": ("wonder", 2), "wunder": ("wonder", 2)}
