"""Partners of vectors beyond the plain blocked route: norm-pruned and approximate."""

import numpy as np
import pytest

from reelstat.functions.expressions import HASH_KEYS, HASH_MULT, HASH_PRIME, hash_bucket
from reelstat.operators import lsh, similarity, topk_kernel


def frame(spark, ids, mat):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, mat)], "id long, features array<double>")


def ranked(df):
    return sorted((r["i"], r["rank"], r["j"], round(r["score"], 9)) for r in df.collect())


def brute(left, right, k):
    out = []
    for i, u in enumerate(left):
        order = sorted(range(len(right)), key=lambda j: (-float(u @ right[j]), j))[:k]
        out += [(i, r + 1, j, round(float(u @ right[j]), 9)) for r, j in enumerate(order)]
    return sorted(out)


@pytest.fixture(scope="module")
def factors():
    """Movies whose vectors' lengths fall off steeply, as popular items' factors do."""
    rng = np.random.default_rng(1)
    items = rng.normal(size=(900, 8)) * (np.arange(900)[:, None] + 5.0) ** -0.7
    return rng.normal(size=(120, 8)), items[rng.permutation(900)]


@pytest.mark.parametrize("block_rows", [50, 200, 32768])
def test_pruned_rows_are_the_exact_rows(spark, factors, block_rows):
    users, items = factors
    u, i = frame(spark, range(len(users)), users), frame(spark, range(len(items)), items)
    assert ranked(similarity.pruned_dot_top_k(u, i, 5, block_rows=block_rows)) == brute(users, items, 5)


def test_pruning_skips_most_block_pairs(spark, factors):
    users, items = factors
    u, i = frame(spark, range(len(users)), users), frame(spark, range(len(items)), items)
    v = similarity._vectors(i, "id", "features")
    blocked, tops = similarity.norm_blocks(v, 50)
    assert 18 <= len(tops) <= 30 and tops == sorted(tops, reverse=True)
    assert blocked.groupBy("b").count().agg({"count": "max"}).first()[0] <= 100
    uv = similarity._vectors(u, "id", "features")
    first = similarity.dot_top_k(u, blocked.where("b = 0").select("id", blocked["v"].alias("features")), 5)
    reach = [r["reach"] for r in similarity.reached_blocks(first, uv, tops, 5).collect()]
    assert len(reach) == 120 and sum(reach) < 0.35 * 120 * len(tops)        # the rest is skipped


def test_pruned_ties_zero_vectors_and_equal_norms(spark):
    mat = np.zeros((300, 2))
    mat[:200, 0] = 1.0                                      # equal norms and equal scores: lowest ids win
    mat[200:250, 1] = 1.0
    users = np.array([[1.0, 0.0], [0.0, 0.0], [0.0, -1.0]])
    got = ranked(similarity.pruned_dot_top_k(frame(spark, range(3), users), frame(spark, range(300), mat), 4, block_rows=32))
    assert got == brute(users, mat, 4)
    few = frame(spark, range(3), mat[:3])
    assert ranked(similarity.pruned_dot_top_k(frame(spark, [0], users[:1]), few, 9, block_rows=2)) == brute(users[:1], mat[:3], 9)


def test_a_block_is_not_dealt_to_its_pairs_by_one_task(spark, factors):
    """The list of block pairs travels to the vectors, also where it would not be broadcast of itself:
    a join by block leaves a block's vectors, once for each left block, to one task."""
    users, items = factors
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = similarity.pruned_dot_top_k(frame(spark, range(len(users)), users), frame(spark, range(len(items)), items), 5, block_rows=50)
        plan = found._jdf.queryExecution().sparkPlan().toString()
        assert "BroadcastHashJoin [pb" in plan and ranked(found) == brute(users, items, 5)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_partitions_follow_the_pairs():
    assert similarity._parts(10, 10 ** 6, 96) == 10
    assert similarity._parts(10 ** 6, 10 ** 6, 96) == 96
    assert similarity._parts(10 ** 6, 2000 << 30, 96) == 2000
    assert similarity._parts(10 ** 7, 10 ** 16, 96) == similarity.MAX_PARTS


def test_fine_norm_blocks_do_not_multiply_what_travels(spark, factors, monkeypatch):
    """Blocks of one row would send every user to each movie in reach."""
    users, items = factors
    seen, cut = [], similarity.norm_blocks
    monkeypatch.setattr(similarity, "norm_blocks", lambda v, rows: seen.append(cut(v, rows)) or seen[-1])
    u, i = frame(spark, range(len(users)), users), frame(spark, range(len(items)), items)
    assert ranked(similarity.pruned_dot_top_k(u, i, 5, block_rows=1)) == brute(users, items, 5)
    assert len(seen[0][1]) <= 2 * similarity.NORM_BLOCKS


def test_large_sets_travel_in_few_blocks():
    """1.2 million vectors of 20 numbers against themselves: 14 blocks, not 37."""
    rows = min(similarity.BLOCK_ROWS, similarity.BLOCK_BYTES // (8 * 20))
    assert similarity._n_blocks(1_200_000, rows, 14) == 14


# ---- random-projection tables ------------------------------------------------------------------

def test_projections_are_the_key_hash(spark):
    got = topk_kernel.planes(3, 5, 42, HASH_PRIME, HASH_MULT, HASH_KEYS)
    rows = spark.range(15).selectExpr("id div 5 AS plane", "id % 5 AS dim").select(
        "plane", "dim", hash_bucket(["plane", "dim"], 42, topk_kernel.PLANE_STEPS).alias("h")).collect()
    assert all(got[r["plane"], r["dim"]] == r["h"] / (topk_kernel.PLANE_STEPS / 2) - 1.0 for r in rows)


@pytest.fixture(scope="module")
def clustered():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(60, 24))
    mat = np.repeat(centres, 20, axis=0) + 0.15 * rng.normal(size=(1200, 24))
    return mat / np.linalg.norm(mat, axis=1, keepdims=True)


def test_recall_and_work_on_clustered_vectors(spark, clustered):
    v = frame(spark, range(len(clustered)), clustered)
    found = lsh.approximate_top_k(v, 5, tables=8, bits=8, probes=3).cache()
    row = lsh.recall(found, similarity.cosine_top_k(v, 5)).first()
    assert row["pairs"] == 6000 and row["recall"] >= 0.97
    exact = clustered @ clustered.T
    assert all(abs(r["score"] - exact[r["i"], r["j"]]) < 1e-9 for r in found.collect())
    code = lsh.approximate_top_k(v, 1200, tables=8, bits=8, probes=3).count()        # all pairs that meet
    assert code < 0.2 * 1200 * 1200


def test_multi_probe_finds_more_than_single(spark, clustered):
    v = frame(spark, range(len(clustered)), clustered)
    truth = similarity.cosine_top_k(v, 5).cache()
    few, many = (lsh.recall(lsh.approximate_top_k(v, 5, tables=2, bits=10, probes=p), truth).first()["recall"] for p in (0, 4))
    assert many > few + 0.1


@pytest.mark.parametrize("block_rows", [32768, 40])
def test_hot_buckets_are_cut(spark, clustered, block_rows):
    """One bit: two buckets hold everything, so all pairs that agree in a sign are scored."""
    v, queries = frame(spark, range(300), clustered[:300]), spark.createDataFrame([(i,) for i in (3, 77, 500)], "id long")
    got = lsh.approximate_top_k(v, 5, queries, tables=1, bits=1, probes=1, block_rows=block_rows)
    exact = clustered[:300] @ clustered[:300].T
    np.fill_diagonal(exact, -2)
    want = sorted((i, r + 1, int(j)) for i in (3, 77) for r, j in enumerate(np.argsort(-exact[i], kind="stable")[:5]))
    assert sorted((r["i"], r["rank"], r["j"]) for r in got.collect()) == want       # both signs probed: exact


def test_odd_vectors(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [None, float("nan")]), (5, [2.0, 0.0])],
                              "id long, features array<double>")
    got = {(r["i"], r["j"]): r["score"] for r in lsh.approximate_top_k(v, 3, bits=2).collect()}
    assert got[1, 5] == 1.0 and got[3, 4] == 0.0 and not any(2 in p for p in got)
    assert lsh.approximate_top_k(v.limit(0), 3).count() == 0


def test_hashed_vectors_leave_in_bounded_batches():
    """2000 vectors of 64 numbers leave 60 times each: 61 MB at once before."""
    import pyarrow as pa
    rng = np.random.default_rng(5)
    mat = rng.normal(size=(2000, 64))
    batch = pa.RecordBatch.from_pydict({"id": np.arange(2000), "ask": np.ones(2000, bool), "v": pa.array(mat.tolist())})
    task = topk_kernel.hash_task(12, 6, 4, 42, (HASH_PRIME, HASH_MULT, HASH_KEYS))
    out = list(task([batch, batch.slice(0, 0)]))
    assert sum(b.num_rows for b in out) == 2000 * 60 and max(b.nbytes for b in out) < 12e6
