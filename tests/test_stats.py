"""Statistics operators against brute force (pandas) and against the SQL route."""

from decimal import ROUND_HALF_UP, Decimal

import pytest

from reelstat.operators import stats
from reelstat.plans import warehouse_sql
from reelstat.sources import schemas, testdata

SF = "/root/testdata/sf0.001"


def r2(x, scale=2):
    d = Decimal(repr(float(x))).quantize(Decimal("0.00000001"), ROUND_HALF_UP)
    return float(d.quantize(Decimal(10) ** -scale, ROUND_HALF_UP))


@pytest.fixture(scope="module")
def frames(spark):
    r = testdata.ratings(spark, SF)
    m = testdata.movies(spark, SF)
    return r, m, r.toPandas(), m.toPandas()


def test_rating_distribution(frames):
    r, m, pr, pm = frames
    got = [(x.rating, x.cnt) for x in stats.rating_distribution(r).collect()]
    exp = pr.groupby("rating").size().sort_index(ascending=False)
    assert got == list(zip(exp.index, exp.values))
    pct = stats.rating_distribution_pct(r).collect()
    assert abs(sum(x.percentage for x in pct) - 100) < 0.1
    assert [x.percentage for x in pct] == [r2(c * 100.0 / len(pr)) for c in exp.values]


def test_popular_and_top_rated(frames):
    r, m, pr, pm = frames
    g = pr.groupby("movieId").rating.agg(["count", "mean"]).reset_index()
    g = g.merge(pm[["movieId", "title"]], on="movieId")
    exp = g.sort_values(["count", "movieId"], ascending=[False, True]).head(10)
    got = stats.popular(r, m).collect()
    assert [x.movieId for x in got] == list(exp.movieId)
    assert [x.avg_rating for x in got] == [r2(v) for v in exp["mean"]]
    g["avg"] = g["mean"].map(r2)
    exp = g[g["count"] >= 30].sort_values(["avg", "movieId"], ascending=[False, True]).head(10)
    assert [x.movieId for x in stats.top_rated(r, m, min_count=30).collect()] == list(exp.movieId)


def test_genre_and_year_rollups_match_join_first(frames):
    r, m, pr, pm = frames
    j = pr.merge(pm, on="movieId")
    jg = j[j.main_genre != "(no genres listed)"].groupby("main_genre").agg(
        movie_count=("movieId", "nunique"), rating_count=("rating", "count"), avg=("rating", "mean"))
    got = {x.main_genre: x for x in stats.genre_avg(r, m, min_count=1, n=100).collect()}
    assert set(got) == set(jg.index)
    for k, row in jg.iterrows():
        assert (got[k].movie_count, got[k].rating_count, got[k].avg_rating) == (
            row.movie_count, row.rating_count, r2(row.avg))
    jy = j[j.year != ""].groupby("year").agg(movie_count=("movieId", "nunique"),
                                              rating_count=("rating", "count"), avg=("rating", "mean"))
    jy = jy.sort_index(ascending=False).head(20)
    got = stats.year_production(r, m).collect()
    assert [(x.year, x.movie_count, x.rating_count, x.avg_rating) for x in got] == [
        (k, v.movie_count, v.rating_count, r2(v.avg)) for k, v in jy.iterrows()]
    got = stats.year_trend(r, m).collect()
    assert [(x.year, x.cnt) for x in got] == [(k, v.rating_count) for k, v in jy.head(15).iterrows()]


def test_user_stats(frames):
    r, m, pr, pm = frames
    per_user = pr.groupby("userId").size()
    s = stats.user_activity_stats(r).first()
    assert (s.max_per_user, s.min_per_user) == (per_user.max(), per_user.min())
    assert s.avg_per_user == r2(per_user.mean(), 1)
    a = stats.active_users(r).collect()
    exp = pr.groupby("userId").agg(n=("rating", "count"), v=("movieId", "nunique")).reset_index()
    exp = exp.sort_values(["n", "userId"], ascending=[False, True]).head(10)
    assert [(x.userId, x.rating_count, x.movie_variety) for x in a] == list(
        zip(exp.userId, exp.n, exp.v))


def test_summaries(frames):
    r, m, pr, pm = frames
    o = stats.overall_summary(r, m).first()
    assert (o.total_ratings, o.total_movies, o.total_users) == (len(pr), len(pm), pr.userId.nunique())
    assert o.avg_rating == r2(pr.rating.mean())
    d = stats.dataset_summary(r, m).first()
    dens = len(pr) * 100.0 / (pr.userId.nunique() * pr.movieId.nunique())
    assert d.density_pct == r2(dens) and d.n_rated == pr.movieId.nunique()
    a = stats.dataset_summary(r, m, approximate=True).first()
    assert abs(a.n_users - d.n_users) <= 0.05 * d.n_users


def test_genre_share_sums_to_100(frames):
    r, m, pr, pm = frames
    rows = stats.genre_share(m).collect()
    assert abs(sum(x.share_pct for x in rows) - 100) < 0.1
    assert all(x.main_genre != "(no genres listed)" for x in rows)


def test_high_score_thresholds_use_unrounded_mean(spark):
    # mean 3.995 rounds to 4.0 (shown) but fails ">= 4.0" on the unrounded value
    ratings = [(u, 1, v, "") for u, v in enumerate([4.0] * 199 + [3.0])]
    ratings += [(u, 2, 4.0, "") for u in range(100)]
    r = spark.createDataFrame(ratings, schemas.RATINGS_CLEAN)
    m = spark.createDataFrame([(1, "a", "", "X", "X"), (2, "b", "", "X", "X")], schemas.MOVIES_CLEAN)
    got = stats.high_score(r, m, min_count=100, min_avg=4.0).collect()
    assert [x.movieId for x in got] == [2]
    assert stats.high_score(r, m, min_count=100, min_avg=3.99).count() == 2


@pytest.mark.parametrize("name,kw,fn", [
    ("rating_distribution_pct", {}, lambda r, m: stats.rating_distribution_pct(r)),
    ("genre_avg", {"min_count": 50}, lambda r, m: stats.genre_avg(r, m, min_count=50)),
    ("year_production", {}, lambda r, m: stats.year_production(r, m)),
    ("high_score", {"min_count": 30, "min_avg": 3.0}, lambda r, m: stats.high_score(r, m, 30, 3.0)),
    ("active_users", {}, lambda r, m: stats.active_users(r)),
    ("movie_stats", {}, lambda r, m: stats.movie_stats(r, m)),
])
def test_sql_route_equals_dataframe_route(spark, frames, name, kw, fn):
    r, m, _, _ = frames
    with warehouse_sql.views(r, m) as names:
        a = warehouse_sql.run(spark, name, **names, **kw)
    assert not [t for t in spark.catalog.listTables() if t.name in names.values()]
    b = fn(r, m)
    assert a.columns == b.columns
    assert a.collect() == b.collect() if name != "movie_stats" else sorted(a.collect()) == sorted(b.collect())


def test_ties_break_on_entity_key(spark):
    # five movies with identical counts and means, offered in scrambled id order
    rows = [(u, mid, 4.0, "") for mid in (9, 3, 7, 1, 5) for u in range(3)]
    r = spark.createDataFrame(rows, schemas.RATINGS_CLEAN).repartition(4)
    m = spark.createDataFrame([(i, f"t{i}", "2000", "G", "G") for i in (1, 3, 5, 7, 9)], schemas.MOVIES_CLEAN)
    assert [x.movieId for x in stats.popular(r, m, n=3).collect()] == [1, 3, 5]
    assert [x.movieId for x in stats.top_rated(r, m, min_count=1, n=4).collect()] == [1, 3, 5, 7]
    assert [x.movieId for x in stats.high_score(r, m, min_count=1, min_avg=1.0).collect()] == [1, 3, 5, 7, 9]
    users = [(u, 1, 3.0, "") for u in (8, 2, 6, 4)]
    a = stats.active_users(spark.createDataFrame(users, schemas.RATINGS_CLEAN), n=3).collect()
    assert [x.userId for x in a] == [2, 4, 6]
