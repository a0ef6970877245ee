import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.llm.common import id_crc32
from reelstat.llm.lm_scoring import _weights, lm_scores


def tokens(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), "</s>"]


def code(i):
    return zlib.crc32(("" if i is None else str(i)).encode())


def counts(rows, use):
    uni, bi, ctx = Counter(), Counter(), Counter()
    for i, t in rows:
        if use(code(i)):
            t = tokens(t)
            before = ["</s>", *t[:-1]]
            uni.update(t), bi.update(zip(before, t)), ctx.update(before)
    return uni, bi, ctx


def bucket(k):
    return 64 + int(math.log2(k)) if k else 0


@pytest.fixture(scope="module")
def scored(odd):
    number = id_crc32("doc_id")
    df = lm_scores(odd, train=number % 7 != 2, fold=F.floor(number / 7) % 3 == 0)
    return sorted(df.collect(), key=str)


def brute(rows):
    train, tune = lambda c: c % 7 != 2, lambda c: c % 7 != 2 and c // 7 % 3 == 0
    uni, bi, ctx = counts(rows, lambda c: train(c) and not tune(c))
    n, v, events = sum(uni.values()), len(uni), defaultdict(list)
    for i, t in rows:
        if tune(code(i)):
            t = tokens(t)
            for b, w in zip(["</s>", *t[:-1]], t):
                events[bucket(ctx[b])].append((1 / (v + 1), uni[w] / n, bi[b, w] / ctx[b] if ctx[b] else 0))
    weights = {}
    for k, e in events.items():
        e, w = np.array(e), np.full(3, 1 / 3)
        for _ in range(200):
            s = e * w
            w = (s / s.sum(axis=1, keepdims=True)).mean(axis=0)
        weights[k] = (w + 1e-6 / 3) / (1 + 1e-6)
    uni, bi, ctx = counts(rows, train)
    n, v = sum(uni.values()), len(uni)
    out = []
    for i, t in rows:
        t, base, score = tokens(t), 0.0, 0.0
        for b, w in zip(["</s>", *t[:-1]], t):
            k = bucket(ctx[b])
            k = k if k in weights else min(weights, key=lambda q: (q // 64 != k // 64, abs(q - k)))
            l0, l1, l2 = weights[k]
            p = l0 / (v + 1) + l1 * uni[w] / n + (l2 * bi[b, w] / ctx[b] if ctx[b] else 0)
            score += math.log10(p / (l0 + l1 + (l2 if ctx[b] else 0)))
            base += math.log10((uni[w] + 1) / (n + v + 1))
        out.append((i, code(i) % 7 == 2, len(t), sum(uni[w] > 0 for w in t), n, v, base, score))
    return sorted(out, key=str)


def test_equals_brute_force(scored, odd_rows):
    want = brute([(r[0], r[1]) for r in odd_rows])
    assert len(scored) == len(want)
    for got, exp in zip(scored, want):
        assert tuple(got)[:6] == exp[:6]
        assert got["base_score"] == pytest.approx(exp[6], rel=1e-9)
        assert got["score"] == pytest.approx(exp[7], rel=0.02)          # ratios are rounded for the weights


def test_short_texts_hold_less_than_all_probability(spark):
    """Texts of at most two tokens and their end are disjoint events."""
    known = ["a", "b", "c", "zzz"]
    short = ["", *known, *(f"{x} {y}" for x in known for y in known)]
    rows = [(i, "a b a b a c b a c c a b") for i in range(20)] + [(100 + k, t) for k, t in enumerate(short)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lm_scores(docs, train=F.col("doc_id") < 20, fold=F.col("doc_id") < 5).where("doc_id >= 100").collect()
    assert 0 < sum(10 ** r["score"] for r in got) < 1
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[100 + short.index("a b")] > score[100 + short.index("c b")]        # c is never followed by b


def test_em_prefers_the_order_that_predicts():
    cells = np.array([[70, 20, 60, 90], [70, 20, -1_000_000, 10], [3, 20, -1_000_000, 50]])
    w = _weights(cells, 2)
    assert w[70][2] > 0.8 and w[3][2] < 1e-5 and w[3][1] > 0.9
    assert all(abs(x.sum() - 1) < 1e-9 for x in w.values())


def test_trigrams_and_no_training_rows(spark):
    docs = spark.createDataFrame([(i, "the cat sat on the mat " * 3) for i in range(12)] + [(50, "the cat sat on the mat")],
                                 "doc_id long, text string")
    two, three = ({r["doc_id"]: r["score"] for r in lm_scores(
        docs, train=F.col("doc_id") < 12, fold=F.col("doc_id") < 4, order=n).collect()} for n in (2, 3))
    assert three[50] >= two[50] - 1e-6
    nothing = lm_scores(docs, train=F.lit(False), fold=F.lit(True)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["score"] <= 0 for r in nothing)


def test_empty_table(none):
    assert lm_scores(none, train=F.col("doc_id") > 1, fold=F.col("doc_id") > 2).collect() == []
