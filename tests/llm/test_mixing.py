import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from reelstat.llm.mixing import _draws, _quotas, mix_sources, mixed_documents, permuted, taken_words


def brute_targets(sizes, weights=(1, 2, 3), cap=3):
    """Reshare the excess again and again until none is above its cap."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, free, total = {}, set(names), sum(sizes.values())
    while free:
        left, share = total - sum(target.values()), sum(weight[s] for s in free)
        over = {s for s in free if left * weight[s] / share >= cap * sizes[s]}
        if not over:
            target |= {s: left * weight[s] / share for s in free}
            break
        target |= {s: cap * sizes[s] for s in over}
        free -= over
    return target


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 400))), ["a", "b", "Z", "é", None, "tiny"][min(5, int(i % 5) + (i % 97 == 0) * 5)])
            for i in range(1500)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_and_taken(docs):
    got = taken_words(mix_sources(docs, block_words=16, shard_slots=512)).collect()
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 3 * r["size"]
    want = brute_targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.02, abs=32)


def test_reruns_agree(docs):
    a, b = (sorted((tuple(r) for r in taken_words(mix_sources(d, block_words=16)).collect()), key=str)
            for d in (docs, docs.repartition(7)))
    assert a == b


def test_lanes(docs, monkeypatch):
    from reelstat.llm import mixing

    monkeypatch.setattr(mixing, "LANE_WORDS", 3000)
    mix = mix_sources(docs, block_words=16)
    by_block = Counter()
    for r in mix.pieces.collect():
        by_block[r["number"], r["block"]] += r["words"]
    assert max(by_block.values()) == 16
    total = Counter()
    for r in taken_words(mix).collect():
        total["size"] += r["size"]
        total["taken"] += r["taken"]
    assert sum(by_block.values()) == total["size"] and total["taken"] == pytest.approx(total["size"], rel=0.02)


def test_every_pass_is_a_permutation(docs):
    slots = mix_sources(docs, block_words=16).slots.collect()
    uses, blocks = Counter(), {}
    for r in slots:
        uses[r["number"], r["epoch"], r["block"]] += 1
        blocks.setdefault((r["number"], r["epoch"]), set()).add(r["block"])
    assert max(uses.values()) == 1                      # within a pass no block comes twice
    for n in (1, 2, 7, 64, 1000):
        assert sorted(permuted(np.arange(n), n, 99)) == list(range(n))
    assert (permuted(np.arange(1000), 1000, 1) != permuted(np.arange(1000), 1000, 2)).any()


def test_quotas_respect_the_cap():
    quota = _quotas(np.array([30.0, 300.0]), np.array([10, 1000]), np.array([1, 10]), 3)
    assert quota.tolist() == [3, 3]


def test_mixed_documents(spark, docs):
    got = mixed_documents(docs, block_words=16).collect()
    taken = Counter()
    for r in got:
        taken[r["doc_id"]] += len(re.findall(r"\S+", r["text"]))
    want = {r["doc_id"]: r["taken"] for r in taken_words(mix_sources(docs, block_words=16)).collect() if r["taken"]}
    assert taken == want
    assert {r["source"] for r in got} == {r["source"] for r in docs.collect()}


def test_odd_rows(odd, odd_rows, none):
    got = taken_words(mix_sources(odd)).collect()
    assert sorted(((r["doc_id"], r["source"], r["size"]) for r in got), key=str) == sorted(
        ((r[0], r[3], len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or ""))) for r in odd_rows), key=str)
    assert mixed_documents(odd).columns == odd.columns
    assert taken_words(mix_sources(none)).collect() == [] and mixed_documents(none).collect() == []


def test_draws_are_multinomial():
    """Counts of full shards have the variance of independent slots, not of rounded expectations."""
    quota = np.array([300_000, 100_000, 90_000, 10_000])
    run = _draws(quota, 500, 42)
    frame = next(run([pd.DataFrame({"id": range(1000)})]))
    counts = frame.pivot(index="shard", columns="number", values="count").fillna(0).to_numpy()
    assert (counts.sum(axis=1) == 500).all()
    share = quota / quota.sum()
    assert np.allclose(counts.mean(axis=0), 500 * share, rtol=0.06)
    assert np.allclose(counts.var(axis=0), 500 * share * (1 - share), rtol=0.2)
    again = next(run([pd.DataFrame({"id": [999, 3]})]))
    assert set(again["shard"]) == {3, 999}
    kept = frame[frame["shard"] == 3][["number", "count"]].to_numpy().tolist()
    assert again[again["shard"] == 3][["number", "count"]].to_numpy().tolist() == kept


def test_slots_are_dealt_to_many_tasks(docs, monkeypatch):
    from reelstat.llm import mixing

    monkeypatch.setattr(mixing, "TASK_SLOTS", 512)
    mix = mix_sources(docs, block_words=16, shard_slots=64)
    n = mix.slots.count()
    parts = [r[0] for r in mix.slots.groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(parts) > 5 and max(parts) < n / 3
