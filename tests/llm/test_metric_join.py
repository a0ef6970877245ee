import random

import numpy as np
import pytest

from reelstat.llm.metric_join import jaccard_components, join_region, part_keys, shells, shingle_set
from tests.llm.test_minhash import shingles


def brute(rows, words, percent):
    sets = [shingles(t, words) for _, t in rows]
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
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted(((doc, len(sets[i]), None if doc is None else least[find(i)]) for i, (doc, _) in enumerate(rows)), key=str)


def result(df, **kw):
    out = jaccard_components(df, **kw)
    assert out.columns == ["doc_id", "n_shingles", "component_id"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def planted(seed=5):
    """Copies with a few edits around several texts, chains whose ends are unlike, texts that
    share a passage, and texts too short to be linked."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    texts = []
    for size, copies, edits in ((150, 40, 4), (400, 25, 12), (30, 20, 2), (12, 20, 1), (60, 30, 9)):
        base = [word() for _ in range(size)]
        for _ in range(copies):
            copy = list(base)
            for _ in range(rng.randint(0, edits)):
                at = rng.randrange(len(copy))
                copy[at:at + rng.choice([0, 1, 1, 2])] = [word()]
            texts.append(copy)
    chain = [word() for _ in range(200)]
    for i in range(12):
        texts.append(list(chain))
        chain[i * 15:i * 15 + 3] = [word() for _ in range(3)]
    passage = [word() for _ in range(50)]
    texts += [passage + [word() for _ in range(rng.randint(5, 80))] for _ in range(40)]
    texts += [[rng.choice("ab") for _ in range(rng.randint(1, 9))] for _ in range(40)]
    ids = rng.sample(range(5000), len(texts))
    return [(i, " ".join(t)) for i, t in zip(ids, texts)]


@pytest.mark.parametrize("kw", [
    {},                                                     # every group is one task
    {"members": 4, "load": 100_000, "levels": 4},           # regions of regions
    {"members": 6, "load": 1500, "levels": 2},              # then pairs of blocks
    {"members": 5, "load": 100_000, "levels": 0},           # pairs of blocks alone
])
def test_equals_brute_force(spark, kw):
    rows = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert result(docs, **kw) == brute(rows, 3, 90)


@pytest.mark.parametrize("words,percent", [(1, 60), (5, 80), (2, 100), (3, 97)])
def test_other_thresholds(spark, words, percent):
    rows = planted(seed=words)[::2]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert result(docs, words=words, percent=percent, members=8) == brute(rows, words, percent)


def test_odd_rows(odd, odd_rows, none):
    assert result(odd) == brute([(r[0], r[1]) for r in odd_rows], 3, 90)
    assert result(none) == []


def test_repeated_ids_are_documents_of_their_own(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(40))
    docs = spark.createDataFrame([(1, a), (1, b), (2, b + " x"), (3, a), (3, a), (None, a)], "doc_id long, text string")
    assert result(docs) == sorted([(1, 38, 1), (1, 38, 1), (2, 39, 1), (3, 38, 1), (3, 38, 1), (None, 38, None)], key=str)


@pytest.mark.parametrize("percent", [60, 90, 97])
def test_linked_sets_share_a_key(percent):
    rng = np.random.default_rng(percent)
    checked = 0
    for size in [*range(3, 60), *rng.integers(60, 3000, 60)]:
        own = np.unique(rng.integers(0, 1 << 63, size, np.uint64))
        for union in range(len(own), len(own) * 100 // percent + 1):
            drop = int(rng.integers(0, union * (100 - percent) // 100 + 1))
            add = union - len(own)
            if add + drop == 0 or 100 * (len(own) - drop) < percent * union:
                continue
            other = np.unique(np.concatenate([rng.permutation(own)[drop:], rng.integers(0, 1 << 63, add, np.uint64)]))
            assert len(np.intersect1d(part_keys(own, percent), part_keys(other, percent))), (len(own), add, drop)
            checked += 1
    assert checked > 500


def test_shells_and_sets():
    assert shells(90)[0] == 9 and all(b >= a * 10 / 9 for a, b in zip(shells(90), shells(90)[1:]))
    assert len(part_keys(np.arange(8, dtype=np.uint64), 90)) == 0      # nothing but an equal set is near
    for text in ("", "One  two", "One two\tthree", "É a b c d É a b c", "x" * 9000):
        assert len(shingle_set(text.encode(), 3)) == len(shingles(text, 3))


def test_region_masks():
    """Replicas of the same level are not compared, those of different levels are."""
    same = np.arange(50, dtype=np.uint64)
    ids, sets = np.array([1, 2, 3]), [same, same[:-1], same[1:]]
    assert len(join_region(ids, np.array([0, 0, 0]), sets, 90)) == 2
    assert join_region(ids, np.array([1, 1, 1]), sets, 90) == []
    assert len(join_region(ids, np.array([1, 2, 1]), sets, 90)) == 2
