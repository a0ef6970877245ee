import random
import re

import numpy as np
import pytest

from reelstat.llm import minhash
from reelstat.llm.minhash import components, least_matches, near_duplicates


def shingles(text, words=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {" ".join(w)} - {""} if len(w) <= words else {" ".join(w[i:i + words]) for i in range(len(w) - words + 1)}


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and rows[i][0] is not None and rows[j][0] is not None and 100 * len(a & b) >= percent * len(a | b):
                group[find(i)] = find(j)
    out = []
    for i, (doc, _) in enumerate(rows):
        least = min((rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None), default=None)
        out.append((doc, len(sets[i]), least, doc == least))
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in near_duplicates(df).collect()), key=str)


def test_equals_brute_force(odd, odd_rows):
    assert result(odd) == brute([(r[0], r[1]) for r in odd_rows])


@pytest.mark.parametrize("block", [1024, 8])
def test_near_copies_and_chains(spark, monkeypatch, block):
    """Groups of near copies, a chain whose ends are unlike, and texts that share a passage."""
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", block)
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    rows, base = [], [word() for _ in range(120)]
    for i in range(60):
        copy = list(base)
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(120)] = word()
        rows.append((i * 7 % 1000, " ".join(copy)))
    chain = [word() for _ in range(200)]
    for i in range(12):
        rows.append((2000 - i, " ".join(chain)))
        chain[i * 15:i * 15 + 3] = [word() for _ in range(3)]
    passage = [word() for _ in range(60)]
    rows += [(3000 + i, " ".join([*passage, *(word() for _ in range(30))])) for i in range(40)]
    assert result(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_components_of_long_chains(spark):
    edges = [(i, i + 1) for i in range(60)] + [(200 + i * 3, 200 + (i * 7 % 40) * 3) for i in range(1, 40)] + [(900, 800)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    group = {x: x for e in edges for x in e}
    for _ in group:
        for a, b in edges:
            group[a] = group[b] = min(group[a], group[b])
    assert got == group


def test_posterior_bound():
    least = least_matches(0.85)
    size = minhash.BANDS * minhash.ROWS
    assert len(least) == size // minhash.BATCH and list(least) == sorted(least)
    # of pairs at the threshold hardly any is pruned; of unlike pairs nearly all, in the first batch
    rng = np.random.default_rng(0)
    left = rng.integers(0, 1 << 32, (3000, size), dtype=np.uint32)
    for share, low, high in ((0.85, 2999, 3000), (0.3, 0, 3)):
        right = np.where(rng.random(left.shape) < share, left, left + np.uint32(1))
        assert low <= len(minhash.survives(left, right, 0.85)) <= high


def test_empty_table(none):
    assert near_duplicates(none).collect() == []
