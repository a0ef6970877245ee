"""Split, ALS fit/evaluate/save, recommendations, cold start."""

import numpy as np
import pytest

from reelstat.operators import recommend
from reelstat.sources import schemas, testdata

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def planted(spark):
    """200 users x 150 items, true rank 3, 40 % observed, ratings clipped to 0.5 .. 5."""
    rng = np.random.default_rng(7)
    u, v = rng.uniform(0.3, 1.2, (200, 3)), rng.uniform(0.3, 1.2, (150, 3))
    full = np.clip(u @ v.T + 0.5, 0.5, 5.0)
    mask = rng.random(full.shape) < 0.4
    rows = [(int(a), int(b), float(full[a, b]), "") for a, b in zip(*np.nonzero(mask))]
    return spark.createDataFrame(rows, schemas.RATINGS_CLEAN)


@pytest.fixture(scope="module")
def model_and_split(planted):
    train, test = recommend.split_ratings(planted, 0.8, 42)
    return recommend.fit_als(train, rank=5, max_iter=10, reg_param=0.05), train, test


def test_hash_split_is_layout_independent(spark):
    r = testdata.ratings(spark, SF)
    a_tr, a_te = recommend.split_ratings(r)
    b_tr, b_te = recommend.split_ratings(r.repartition(13))
    assert sorted(a_tr.collect()) == sorted(b_tr.collect())
    n, ntr, nte = r.count(), a_tr.count(), a_te.count()
    assert ntr + nte == n and abs(ntr / n - 0.8) < 0.01
    s = {row.train: row.n for row in recommend.split_summary(r).collect()}
    assert s == {True: ntr, False: nte}
    # repeat ratings of one (user, movie) pair land on one side
    dup = a_tr.select("userId", "movieId").intersect(a_te.select("userId", "movieId"))
    assert dup.count() == 0


def test_random_split_parity_option(spark):
    r = testdata.ratings(spark, SF)
    tr, te = recommend.split_ratings(r, method="random")
    assert tr.count() + te.count() == r.count()


def test_cold_start_summary(spark):
    train = spark.createDataFrame([(1, 10, 4.0, ""), (2, 11, 3.0, "")], schemas.RATINGS_CLEAN)
    test = spark.createDataFrame([(1, 11, 4.0, ""), (3, 10, 2.0, ""), (1, 12, 1.0, ""), (2, 10, 5.0, "")],
                                 schemas.RATINGS_CLEAN)
    row = recommend.cold_start_summary(train, test).first()
    assert (row.test_rows, row.kept, row.dropped) == (4, 2, 2)


def test_planted_matrix_is_recovered(model_and_split):
    model, train, test = model_and_split
    m = recommend.als_metrics(model, train, test).first()
    sd = np.std([r.rating for r in test.collect()])
    assert m.rmse < 0.5 * sd
    assert m.train_n == train.count() and m.test_n == test.count()
    feats = np.array([r.features for r in model.itemFactors.collect()])
    assert (feats >= 0).all()                         # nonnegative factors


def test_predict_drops_cold_rows(spark, model_and_split):
    model, train, _ = model_and_split
    cold = spark.createDataFrame([(10_000, 1, 3.0, ""), (1, 10_000, 3.0, ""), (1, 1, 3.0, "")],
                                 schemas.RATINGS_CLEAN)
    assert recommend.predict(model, cold).count() == 1


def test_refit_is_repeatable_and_reload_identical(spark, planted, tmp_dir, model_and_split):
    model, train, _ = model_and_split
    again = recommend.fit_als(train.repartition(5), rank=5, max_iter=10, reg_param=0.05)
    f1 = sorted((r.id, tuple(r.features)) for r in model.itemFactors.collect())
    f2 = sorted((r.id, tuple(r.features)) for r in again.itemFactors.collect())
    assert f1 == f2
    path = tmp_dir + "/als"
    recommend.save_model(model, path)
    f3 = sorted((r.id, tuple(r.features)) for r in recommend.load_model(path).itemFactors.collect())
    assert f1 == f3


def test_recommendation_outputs(spark, model_and_split):
    model, _, _ = model_and_split
    movies = spark.createDataFrame([(i, f"m{i}", "", "G", "G") for i in range(150)], schemas.MOVIES_CLEAN)
    recs = sorted(recommend.user_recs(model, movies, k=5).collect(), key=lambda r: (r.userId, r.rank))
    per_user = {}
    for r in recs:
        per_user.setdefault(r.userId, []).append(r.predictedRating)
    assert len(per_user) == 200 and all(len(v) == 5 for v in per_user.values())
    assert all(v == sorted(v, reverse=True) for v in per_user.values())
    sub = recommend.user_recs(model, movies, k=5, users=10).collect()   # sorted (user, rank)
    assert sorted({r.userId for r in sub}) == list(range(10))
    assert [(r.userId, r.rank, r.movieId) for r in sub] == [
        (r.userId, r.rank, r.movieId) for r in recs if r.userId < 10]
    iu = recommend.item_users(model, k=3, items=5).collect()
    assert len(iu) == 15 and sorted({r.movieId for r in iu}) == list(range(5))
    sim = recommend.similar_items(model, movies, k=5).collect()
    assert len(sim) == 150 * 5 and all(r.origMovieId != r.similarMovieId for r in sim)
    sub = recommend.similar_items(model, movies, k=5, items=5).collect()
    full = {(r.origMovieId, r.similarMovieId) for r in sim if r.origMovieId < 5}
    assert {(r.origMovieId, r.similarMovieId) for r in sub} == full


def test_grid_runs(planted):
    train, test = recommend.split_ratings(planted)
    g = recommend.als_grid(train, test, reg_params=(0.05, 1.0), rank=3, max_iter=3).collect()
    assert [r.reg_param for r in g] == [0.05, 1.0]
    assert all(r.rmse > 0 for r in g)


def test_als_refuses_bad_ids(spark):
    bad = spark.createDataFrame([(3_000_000_000, 1, 4.0)], "userId long, movieId int, rating double")
    with pytest.raises(Exception):
        recommend.fit_als(bad, rank=2, max_iter=1)


def _spark_ml_recs(recs, key, other):
    out = {}
    for r in recs.collect():
        out[r[key]] = [(x[other], x["rating"]) for x in r["recommendations"]]
    return out


def test_blocked_recs_equal_spark_ml(spark, model_and_split):
    model, _, _ = model_and_split
    movies = spark.createDataFrame([(i, f"m{i}", "", "G", "G") for i in range(150)], schemas.MOVIES_CLEAN)
    for ours, ref, key, other in [
        (recommend.user_recs(model, movies, k=5, block_rows=64), model.recommendForAllUsers(5),
         "userId", "movieId"),
        (recommend.item_users(model, k=5, block_rows=64), model.recommendForAllItems(5),
         "movieId", "userId")]:
        exp = _spark_ml_recs(ref, key, other)
        got = {}
        for r in sorted(ours.collect(), key=lambda r: (r[key], r["rank"])):
            got.setdefault(r[key], []).append((r[other], r["predictedRating"]))
        assert set(got) == set(exp)
        for u in exp:
            # same scores (float32 vs float64 products); ids equal unless scores nearly tie
            assert np.allclose([s for _, s in got[u]], [s for _, s in exp[u]], atol=0.006)
            same = [a == b for (a, _), (b, _) in zip(got[u], exp[u])]
            assert all(same) or np.ptp([s for _, s in exp[u]]) < 0.01


def test_nested_recommendation_shape_round_trip(spark, model_and_split):
    model, _, _ = model_and_split
    flat = recommend.item_users(model, k=3)
    nested = recommend.recommendation_arrays(flat, "movieId", "userId")
    assert nested.schema["recommendations"].dataType.simpleString() == "array<struct<userId:int,rating:float>>"
    back = recommend.explode_recs(nested, "movieId", "userId")
    a = sorted((r.movieId, r.rank, r.userId) for r in flat.collect())
    b = sorted((r.movieId, r.rank, r.userId) for r in back.collect())
    assert a == b
    ml = recommend.explode_recs(model.recommendForAllItems(3), "movieId", "userId")
    assert ml.count() == flat.count()


def test_subsets_given_as_dataframes(spark, model_and_split):
    model, _, _ = model_and_split
    movies = spark.createDataFrame([(i, f"m{i}", "", "G", "G") for i in range(150)], schemas.MOVIES_CLEAN)
    users = spark.createDataFrame([(7,), (3,), (120,)], "userId int")
    recs = recommend.user_recs(model, movies, k=4, users=users).collect()
    assert [r.userId for r in recs] == [3] * 4 + [7] * 4 + [120] * 4
    assert [r.rank for r in recs[:4]] == [1, 2, 3, 4]
    full = {(r.userId, r.rank): r.movieId for r in recommend.user_recs(model, movies, k=4).collect()}
    assert all(full[(r.userId, r.rank)] == r.movieId for r in recs)
    items = spark.createDataFrame([(10,), (20,)], "movieId int")
    sim = recommend.similar_items(model, movies, k=3, items=items).collect()
    assert sorted({r.origMovieId for r in sim}) == [10, 20] and len(sim) == 6


def test_grid_side_by_side_equals_one_by_one(spark):
    rows = [(u, i, float((u * 7 + i * 3) % 10) / 2 + 0.5) for u in range(30) for i in range(20) if (u + i) % 3]
    train, test = recommend.split_ratings(spark.createDataFrame(rows, "userId int, movieId int, rating double"))
    got = {r["reg_param"]: r["rmse"] for r in recommend.als_grid(train, test, (0.05, 0.5, 2.0), rank=3, max_iter=3).collect()}
    for rp in (0.05, 0.5, 2.0):
        model = recommend.fit_als(train, reg_param=rp, rank=3, max_iter=3)
        assert got[rp] == recommend.evaluate_rmse(recommend.predict(model, test)).first()["rmse"]
    again = recommend.als_grid(train, test, (0.05, 0.5), {0.05: recommend.fit_als(train, reg_param=0.05, rank=3, max_iter=3)},
                               rank=3, max_iter=3)
    assert {r["reg_param"]: r["rmse"] for r in again.collect()} == {rp: got[rp] for rp in (0.05, 0.5)}


def test_scored_rows_move_no_factors(model_and_split):
    """Predictions are those of Spark ML's transform; where they are not asked for, joins carry ids alone."""
    model, _, test = model_and_split
    got = recommend.predict(model, test)
    ml = model.transform(recommend.to_als_input(test))
    assert got.columns == ml.columns and got.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, ml.collect()))
    plan = got.drop("prediction")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") >= 2 and "__u" not in plan and "__i" not in plan


def test_fits_leave_executor_memory_to_their_tasks(spark, planted, monkeypatch):
    """Rating blocks and factors of fits side by side wait on disk; in memory they took the tasks' room."""
    train, test = recommend.split_ratings(planted)
    fit, used = recommend.ALS.fit, []
    monkeypatch.setattr(recommend.ALS, "fit", lambda als, data: used.append(als) or fit(als, data))
    assert recommend.als_grid(train, test, reg_params=(0.05, 1.0), rank=3, max_iter=2).count() == 2
    assert [(a.getIntermediateStorageLevel(), a.getFinalStorageLevel()) for a in used] == [("DISK_ONLY", "DISK_ONLY")] * 2
    held = [x for x in spark.sparkContext._jsc.sc().getRDDStorageInfo() if x.name() in ("userFactors", "itemFactors")]
    assert held and all(x.memSize() == 0 and x.diskSize() > 0 for x in held)
