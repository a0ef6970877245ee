import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from reelstat.llm import divergence
from reelstat.llm.divergence import shares, source_divergence


def brute(rows, min_docs=3, top=200):
    """rows: (text, lang, source)."""
    counts, docs = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text or "")]
        counts[lang or "", source or ""].update(terms)
        docs[lang or ""].update(set(terms))
    out = []
    for lang in docs:
        kept = [t for t, n in docs[lang].items() if n >= min_docs]
        groups = {s: c for (x, s), c in counts.items() if x == lang}

        def p(count):
            total = sum(count(t) for t in kept) + len(kept)
            return {t: 1 + 10 ** 9 * (count(t) + 1) // total for t in kept}

        shares_of = {s: p(c.__getitem__) for s, c in groups.items()}
        q = p(lambda t: sum(c[t] for c in groups.values()))
        for s, own in shares_of.items():
            pairs = [(o, sum((own[t] - x[t]) ** 2 // x[t] for t in kept)) for o, x in shares_of.items() if o != s]
            terms = [(t, (own[t] - q[t]) ** 2 // q[t]) for t in kept if groups[s][t] and own[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                items = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out += [(lang, s, part, item, value, rank) for rank, (item, value) in enumerate(items, 1)]
    return sorted(out)


def result(df, **kw):
    out = source_divergence(df, **kw)
    assert out.columns == ["lang", "source", "part", "item", "value", "rank"]
    return sorted(map(tuple, out.collect()))


def corpus(seed=1, n=120):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdéñß漢") for _ in range(rng.randint(1, 4))) for _ in range(300)]
    rows = []
    for _ in range(n):
        text = " ".join(words[min(299, int(rng.expovariate(0.02)))] + rng.choice(["", ".", "'S", "7"]) for _ in range(rng.randint(0, 60)))
        rows.append((text, rng.choice(["en", "fr", None]), f"s{min(11, int(rng.expovariate(0.4)))}"))
    return rows + [("", "xx", "alone"), ("once only", "yy", "a"), (None, "yy", None), ("A a a", "zz", "b"), ("a", "zz", "b"), ("a B", "zz", "c")]


@pytest.mark.parametrize("kw", [{}, {"block_terms": 7, "tile": 3}, {"block_cells": 20, "tile": 1, "top": 4}, {"min_docs": 1}])
def test_equals_brute_force(spark, kw):
    rows = corpus()
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(5)
    assert result(docs, **kw) == brute(rows, kw.get("min_docs", 3), kw.get("top", 200))


def test_odd_rows(odd, odd_rows, none):
    assert result(odd) == brute([(r[1], r[2], r[3]) for r in odd_rows])
    assert result(odd, min_docs=1) == brute([(r[1], r[2], r[3]) for r in odd_rows], 1)
    assert result(none) == []


def test_groups_without_terms_have_pairs(spark):
    docs = spark.createDataFrame([("1 2 3", "en", "a"), (None, "en", "b"), ("", "en", None)], "text string, lang string, source string")
    assert result(docs) == sorted((("en", s, "pair", o, 0, r) for s in ("", "a", "b") for r, o in enumerate(
        sorted({"", "a", "b"} - {s}), 1)))


def test_hot_source_and_term(spark):
    rows = [("common " * 3000 + f"word{chr(97 + i % 9)}", "en", "hot" if i % 3 else f"s{i % 7}") for i in range(60)]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").repartition(6)
    assert result(docs) == brute(rows)


def test_shares_are_exact_for_large_counts():
    counts = np.array([0, 7, 9_300_000_000, 0], np.int64)
    assert shares(counts, 10 ** 13 + 7).tolist() == [1 + 10 ** 9 * (c + 1) // (10 ** 13 + 7) for c in counts.tolist()]


def test_runs_are_fewer_than_terms(spark, monkeypatch):
    """Terms of equal counts stand together: a column has fewer runs than terms."""
    seen = []
    tables = divergence.stored
    monkeypatch.setattr(divergence, "stored", lambda df, name: seen.append((name, tables(df, name))) or seen[-1][1])
    rows = [(" ".join(f"t{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(500) if (i + d) % 4), "en", f"s{d % 4}") for d in range(40)]
    result(spark.createDataFrame(rows, "text string, lang string, source string"))
    columns = dict(seen)["divergence-columns"].where("source IS NOT NULL").collect()
    assert columns and all(len(divergence.unpack(bytes(r["ends"]), np.int32)) <= 20 for r in columns)
