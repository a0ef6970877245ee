"""Hot keys: one user and one movie each hold a third of all ratings."""

import numpy as np
import pandas as pd
import pytest

from reelstat.operators import recommend, stats
from reelstat.sources import schemas


@pytest.fixture(scope="module")
def skewed(spark):
    rng = np.random.default_rng(11)
    n = 30_000
    users = rng.integers(1, 500, n)
    movies = rng.integers(1, 300, n)
    users[: n // 3] = 7                                  # hot user
    movies[n // 3: 2 * n // 3] = 42                      # hot movie
    ratings = rng.integers(1, 11, n) / 2.0
    pdf = pd.DataFrame({"userId": users.astype("int32"), "movieId": movies.astype("int32"),
                        "rating": ratings, "date": "2000-01-01"})
    mdf = pd.DataFrame({"movieId": np.arange(1, 300, dtype="int32")})
    mdf["title"] = "t" + mdf.movieId.astype(str)
    mdf["year"] = (1990 + mdf.movieId % 20).astype(str)
    mdf["genres"] = np.where(mdf.movieId % 4 == 0, "Drama", "Comedy|Drama")
    mdf["main_genre"] = mdf.genres.str.split("|").str[0]
    r = spark.createDataFrame(pdf, schemas.RATINGS_CLEAN).repartition(16)
    m = spark.createDataFrame(mdf, schemas.MOVIES_CLEAN)
    return r, m, pdf, mdf


def test_hot_user_and_movie_aggregates(skewed):
    r, m, pdf, mdf = skewed
    a = stats.active_users(r, n=3).collect()
    assert a[0].userId == 7 and a[0].rating_count == (pdf.userId == 7).sum()
    assert a[0].movie_variety == pdf[pdf.userId == 7].movieId.nunique()
    p = stats.popular(r, m, n=1).first()
    assert p.movieId == 42 and p.rating_count == (pdf.movieId == 42).sum()
    s = stats.user_activity_stats(r).first()
    assert s.max_per_user == pdf.groupby("userId").size().max()
    g = {x.main_genre: x.rating_count for x in stats.genre_avg(r, m, min_count=1).collect()}
    j = pdf.merge(mdf, on="movieId")
    assert g == j.groupby("main_genre").size().to_dict()


def test_hot_keys_in_cold_start(skewed):
    r, m, pdf, _ = skewed
    train, test = recommend.split_ratings(r)
    got = recommend.cold_start_summary(train, test).first()
    tr, te = train.toPandas(), test.toPandas()
    kept = te[te.userId.isin(set(tr.userId)) & te.movieId.isin(set(tr.movieId))]
    assert (got.test_rows, got.kept) == (len(te), len(kept))
