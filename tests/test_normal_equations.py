import numpy as np
import pytest
from pyspark.sql import functions as F

from reelstat.operators import normal_equations as ne
from reelstat.operators import recommend


@pytest.fixture(scope="module")
def planted():
    rng = np.random.default_rng(2)
    u, v = rng.uniform(0.2, 1.2, (60, 4)), rng.uniform(0.2, 1.2, (50, 4))
    rows = [(a, b, float(u[a] @ v[b])) for a in range(60) for b in range(50) if rng.random() < 0.4]
    rows += [(7, b % 50, float(u[7] @ v[b % 50])) for b in range(700)]            # a user with a third of all rows
    return u, v, rows


def frames(spark, planted):
    u, v, rows = planted
    ratings = spark.createDataFrame(rows, "userId int, movieId int, rating double").repartition(5)
    return ratings, spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "id long, features array<double>")


def solved(planted, reg, nonnegative):
    _, v, rows = planted
    out = {}
    for a in {r[0] for r in rows}:
        x = np.array([v[b] for c, b, _ in rows if c == a])
        r = np.array([z for c, _, z in rows if c == a])
        m, y = x.T @ x + reg * len(r) * np.eye(4), x.T @ r
        if nonnegative:                         # every set of zero components, the best feasible one
            best = None
            for bits in range(16):
                on = [i for i in range(4) if bits >> i & 1]
                s = np.zeros(4)
                if on:
                    s[on] = np.linalg.solve(m[np.ix_(on, on)], y[on])
                if (s >= 0).all() and (best is None or s @ m @ s / 2 - y @ s < best[0]):
                    best = s @ m @ s / 2 - y @ s, s
            out[a] = best[1]
        else:
            out[a] = np.linalg.solve(m, y)
    return out


@pytest.mark.parametrize("part_rows", [10, 100, 65536])
@pytest.mark.parametrize("nonnegative", [True, False])
def test_half_step_equals_numpy(spark, planted, part_rows, nonnegative):
    ratings, items = frames(spark, planted)
    if nonnegative:                             # some problems want components below zero
        ratings = ratings.withColumn("rating", F.col("rating") - F.col("movieId") % 5)
        u, v, rows = planted
        planted = u, v, [(a, b, r - b % 5) for a, b, r in rows]
    got = {r["id"]: np.array(r["features"]) for r in ne.half_step(ratings, items, 0.1, nonnegative, part_rows=part_rows).collect()}
    want = solved(planted, 0.1, nonnegative)
    assert got.keys() == want.keys() and all(np.allclose(got[a], want[a], atol=1e-7) for a in want)
    if nonnegative:
        assert any((x == 0).any() for x in want.values())


def test_a_hot_user_is_many_tasks(spark, planted):
    """The parts of the hot user's ratings are bounded, and so is every task call."""
    ratings, items = frames(spark, planted)
    parts = ne.partial_equations(ratings, items, part_rows=50).collect()
    hot = [r["n"] for r in parts if r["id"] == 7]
    assert sum(hot) >= 700 and len(hot) >= 8 and max(hot) <= 250
    assert sum(r["n"] for r in parts) == len(planted[2])


def test_fit_recovers_a_planted_matrix(spark, planted):
    ratings, _ = frames(spark, planted)
    train, test = recommend.split_ratings(ratings)
    users, items = ne.fit(train, rank=4, max_iter=8, reg_param=0.001, part_rows=100)
    assert users.count() == 60 and min(min(r["features"]) for r in items.collect()) >= 0
    mine = recommend.evaluate_rmse(recommend.predict_from_factors(test, users, items)).first()["rmse"]
    spark_ml = recommend.fit_als(train, rank=4, max_iter=8, reg_param=0.001)
    assert mine < 0.1 and mine < 2 * recommend.evaluate_rmse(recommend.predict(spark_ml, test)).first()["rmse"] + 0.02


def test_fit_is_repeatable_whatever_the_layout(spark, planted):
    ratings, _ = frames(spark, planted)
    runs = [{r["id"]: r["features"] for r in ne.fit(ratings.repartition(n), rank=3, max_iter=2)[0].collect()} for n in (1, 6)]
    assert all(np.allclose(runs[0][a], runs[1][a], atol=1e-6) for a in runs[0])


def test_odd_ratings(spark):
    items = spark.createDataFrame([(1, [1.0, 0.0]), (2, None)], "id long, features array<double>")
    ratings = spark.createDataFrame([(5, 1, 2.0), (5, 2, 9.0), (6, 3, 1.0), (None, 1, 1.0), (5, 1, None)],
                                    "userId int, movieId int, rating double")
    got = ne.half_step(ratings, items, 0.5).collect()
    assert len(got) == 1 and got[0]["id"] == 5 and np.allclose(got[0]["features"], [2.0 / 1.5, 0.0])
    assert ne.half_step(ratings.limit(0), items).count() == 0


def test_cold_pairs_are_dropped_by_the_join(spark):
    users = spark.createDataFrame([(1, [1.0, 2.0])], "id long, features array<double>")
    items = spark.createDataFrame([(10, [3.0, 0.5]), (11, None)], "id long, features array<double>")
    pairs = spark.createDataFrame([(1, 10, 5.0), (1, 10, 3.0), (1, 11, 1.0), (2, 10, 1.0), (None, 10, 1.0)],
                                  "userId int, movieId int, rating double")
    assert sorted(map(tuple, recommend.predict_from_factors(pairs, users, items).collect())) == [(1, 10, 3.0, 4.0), (1, 10, 5.0, 4.0)]
