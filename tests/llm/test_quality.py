import math
import re
from collections import Counter

import pytest

from reelstat.llm import quality
from reelstat.llm.quality import BUCKETS, log_ratios, quality_rules, with_ngrams


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeats(w):
    seen, covered = {}, set()
    for i in range(len(w) - 7):
        seen.setdefault(tuple(w[i:i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered.update(p + k for p in places for k in range(8))
    return len(covered)


def brute(text):
    w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
    n = repeats(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), n,
            len(w) < 20 or 100 * n > 30 * len(w))


EXTRA = ["a b c d e f g h i j " * 4, "x " * 30, "\n".join(["same line here"] * 5 + ["", " ", "same line here "]), "## ** || <b>",
         "one two three four five six seven eight nine ten " * 2 + " ".join(f"w{i}" for i in range(80))]


def test_base_equals_brute_force(spark, odd, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + [(1000 + i, t) for i, t in enumerate(EXTRA)]
    docs = odd.select("doc_id", "text", "name").unionByName(spark.createDataFrame(
        [(i, t, "n") for i, t in rows[len(odd_rows):]], "doc_id long, text string, name string"))
    got = quality_rules(docs, [0.0] * BUCKETS).drop("mean_ratio", "kept").collect()
    assert sorted((tuple(r) for r in got), key=str) == sorted(((i, *brute(t)) for i, t in rows), key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    good = [(i, " ".join(f"word{(i * 7 + k * k) % 50}" for k in range(40))) for i in range(60)]
    junk = [(100 + i, " ".join(f"wq{i}x{k}%%%" for k in range(40))) for i in range(20)]
    return spark.createDataFrame(good + junk, "doc_id long, text string")


def test_ratio_equals_brute_force(spark, corpus):
    trusted = spark.createDataFrame([(i,) for i in range(0, 60, 2)] + [(None,), (0,)], "doc_id long")
    ratios = log_ratios(corpus, trusted)
    cells = {r["doc_id"]: r["ngrams"] for r in with_ngrams(corpus).collect()}
    raw, target = Counter(), Counter()
    for i, c in cells.items():
        raw.update(c)
        target.update(c if i < 60 and i % 2 == 0 else [])
    n, t = sum(raw.values()), sum(target.values())
    want = lambda c: math.log((target[c] + 1) / (t + BUCKETS)) - math.log((raw[c] + 1) / (n + BUCKETS))
    assert all(ratios[c] == pytest.approx(want(c)) for c in list(raw) + [0, 1])
    got = {r["doc_id"]: r for r in quality_rules(corpus, ratios).collect()}
    for i, c in cells.items():
        assert got[i]["mean_ratio"] == pytest.approx(sum(map(want, c)) / len(c), abs=1e-5)
        assert got[i]["kept"] == (got[i]["mean_ratio"] >= quality.THRESHOLD and not got[i]["base_failed"])
    assert min(got[i]["mean_ratio"] for i in range(60)) > max(got[100 + i]["mean_ratio"] for i in range(20))


@pytest.mark.parametrize("masks", [1 << 20, 0])
def test_all_trusted_rows_count(spark, monkeypatch, masks):
    """30,000 trusted documents with scattered, negative and neighbouring ids; of "beta" all, of "alpha" half."""
    monkeypatch.setattr(quality, "MASKS", masks, raising=False)
    rows = [((i - 30_000) * (1 if i % 3 else 7_777_777_777), "beta" if i % 2 else "alpha") for i in range(40_000)]
    assert len({i for i, _ in rows}) == 40_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    trusted = [r for i, r in enumerate(rows) if i % 4]
    ratios = log_ratios(docs, spark.createDataFrame([(i,) for i, _ in trusted] * 2 + [(None,)], "doc_id long"))
    cells = {r["text"]: r["ngrams"] for r in with_ngrams(docs.dropDuplicates(["text"])).collect()}
    share = lambda n, of: math.log((n + 1) / (2 * of + BUCKETS))  # noqa: E731  a word and its ending each
    for text, n in (("alpha", 10_000), ("beta", 20_000)):
        assert sum(t == text for _, t in trusted) == n and len(set(cells[text])) == 2
        assert all(ratios[c] == pytest.approx(share(n, 30_000) - share(20_000, 40_000)) for c in cells[text])


def test_plans_stay_native(corpus):
    plan = quality_rules(corpus, [0.0] * BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_no_trusted_and_empty(spark, corpus, none):
    nothing = spark.createDataFrame([], "doc_id long")
    assert set(log_ratios(corpus, nothing)) == {0.0}
    assert quality_rules(none, [0.0] * BUCKETS).collect() == []
    assert set(log_ratios(none, nothing)) == {0.0}
    assert quality.THRESHOLD < 0
