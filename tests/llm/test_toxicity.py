import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from reelstat.llm.toxicity import (DECAY, SPAN, _vectors, fit_svm, margins, toxicity_scores, train, unit_lists)

INSULTS = ["grobnak", "snivelur", "plonkard", "zwartkop", "muttenhed"]


def corpus(n, seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["ka", "lo", "mi", "te", "ru", "sa", "ne"]) for _ in range(rng.randint(1, 4)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 80))]
        toxic = int(rng.random() < 0.25)
        if toxic:
            for _ in range(rng.randint(1, 3)):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        text = " ".join(words)
        rows.append((i, text.replace(" ru ", ". "), toxic))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(600, 1)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")
    return train(docs, labels, usable=F.lit(True))


def test_held_out_accuracy(spark, model):
    rows = corpus(300, 2)
    got = toxicity_scores(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), model, ["doc_id"])
    predicted = {r["doc_id"]: r["predicted"] for r in got.collect()}
    assert np.mean([predicted[i] == t for i, _, t in rows]) > 0.98


def test_gapped_and_inserted_characters(spark, model):
    base = "kalo mite rusa ne "
    texts = [base + w for w in ("grobnak", "gro.bnak", "g-robnak", "grobnnak", "s n i v e l u r", "plonkardli", "GROBNAK!!")]
    clean = [base * 30, "kalo " * 3, "mi te", base + "a b c d"]
    docs = spark.createDataFrame(list(enumerate(texts + clean)), "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in toxicity_scores(docs, model, ["doc_id"]).collect()}
    assert min(got[i] for i in range(len(texts))) > max(got[i] for i in range(len(texts), len(got)))


def test_kernel_equals_subsequences():
    """The sparse vectors hold all subsequences of three characters within the span."""
    def brute(word):
        s, out = f"^{word}$", {}
        for i in range(len(s)):
            for j in range(i + 1, len(s)):
                for k in range(j + 1, min(len(s), i + SPAN + 1)):
                    out[s[i] + s[j] + s[k]] = out.get(s[i] + s[j] + s[k], 0) + DECAY ** (k - i - 2)
        return out

    a, b = "abcab", "xabyc"
    (pa_, wa), (pb, wb) = _vectors([a, b])
    dense = np.zeros(97 ** 3)
    dense[pa_] = wa
    x, y = brute(a), brute(b)
    norm = lambda word: np.sqrt(sum(  # noqa: E731  every occurrence on its own
        DECAY ** (2 * (k - i - 2)) for i in range(len(word) + 2) for j in range(i + 1, len(word) + 2)
        for k in range(j + 1, min(len(word) + 2, i + SPAN + 1))))
    assert dense[pb] @ wb == pytest.approx(sum(v * y.get(k, 0) for k, v in x.items()) / norm(a) / norm(b))


def test_folded_table_equals_kernel_expansion():
    model = fit_svm(["grobnak", "snivelur"], ["kalo", "mite", "rusane"])
    got = margins(["grobnak", "kalo"], model)
    assert got[0] > 0.9 and got[1] < -0.9
    long = "kalo" * 40 + "grobnak" + "mite" * 40
    assert margins([long], model)[0] > margins(["kalomite" * 40], model)[0]


def test_units():
    units, owner = unit_lists(pa.array(["A b c! d word.", None or "", "x y", "one  two"]))
    assert sorted(zip(owner.tolist(), units.to_pylist())) == [(0, "abcd"), (0, "word"), (3, "one"), (3, "two")]


def test_odd_rows(spark, odd, odd_rows, model):
    got = toxicity_scores(odd, model, ["doc_id"]).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) for r in got)
    empty = {r["score"] for r in toxicity_scores(odd.where("coalesce(text, '') = ''"), model, ["doc_id"]).collect()}
    assert len(empty) == 1


def test_without_both_classes(spark, none, odd):
    labels = spark.createDataFrame([(1, 0), (2, 0), (3, None), (None, 1)], "doc_id long, toxic int")
    for given in (labels, labels.limit(0)):
        model = train(odd, given.where("doc_id IS NOT NULL"), usable=F.lit(True))
        assert all(r["predicted"] == 0 for r in toxicity_scores(odd, model, ["doc_id"]).collect())
    assert toxicity_scores(none, model, ["doc_id"]).collect() == []


def test_scoring_holds_few_units_at_once():
    """60,000 units of one text: their subsequences took tens of MB at a time."""
    import tracemalloc

    from reelstat.llm.toxicity import SYMBOLS, Model
    rng = np.random.default_rng(0)
    model = Model(table=rng.normal(size=SYMBOLS ** 3).astype(np.float32))
    units = ["".join(chr(97 + c) for c in word) for word in rng.integers(0, 26, (60_000, 20))]
    tracemalloc.start()
    got = margins(units, model)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(got) == 60_000 and np.isfinite(got).all() and peak < 16e6
