"""Descriptive statistics over ratings and the movie catalogue.

Plan shape used throughout: ratings are first reduced to one row per movie
(``per_movie``: count, sum, min, max), then joined to the catalogue, then
rolled up by genre or year.  The heavy aggregation runs with a map-side
partial aggregate, so even a movie that holds a large share of all ratings
leaves each map task as one row; the join then sees at most one row per
movie instead of one per rating.  The catalogue side is joined without a
forced hint: Spark broadcasts it only when its measured size is under the
broadcast threshold and otherwise shuffles both sides by movieId.

Means are rounded half-up through decimal(38,12) (``round_half_up``).
Every ORDER BY .. LIMIT ends with the entity key, so ties are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.functions import NO_GENRE, has_year, percent, round_half_up
from reelstat.sources.catalog import partition_values, qualified


def _mean(s: str, n: str, scale: int = 2) -> F.Column:
    return round_half_up(F.col(s) / F.col(n), scale)


def per_movie(ratings: DataFrame) -> DataFrame:
    """movieId, n, s, lo, hi - the partial aggregate every movie query starts from."""
    return ratings.groupBy("movieId").agg(
        F.count("rating").alias("n"), F.sum("rating").alias("s"),
        F.min("rating").alias("lo"), F.max("rating").alias("hi"))


def _per_movie_with(ratings: DataFrame, movies: DataFrame, *cols: str) -> DataFrame:
    return per_movie(ratings).join(movies.select("movieId", *cols), "movieId")


def _sum_scalars(parts: list[DataFrame], cols: list[str]) -> DataFrame:
    """Merge one-row aggregates of different tables into one row.

    Each part fills the columns it knows and leaves the others null; a union
    and a global sum put them side by side without a join.
    """
    aligned = [p.select(*[(F.col(c) if c in p.columns else F.lit(None)).alias(c) for c in cols])
               for p in parts]
    u = aligned[0]
    for a in aligned[1:]:
        u = u.unionByName(a)
    return u.agg(*[F.sum(c).alias(c) for c in cols])


# ---------------------------------------------------------------- distributions

def rating_distribution(ratings: DataFrame) -> DataFrame:
    """rating, cnt - one row per rating value, highest first."""
    return ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.desc("rating"))


def rating_distribution_pct(ratings: DataFrame) -> DataFrame:
    """rating, cnt, percentage of all ratings.

    The total is a window over the aggregate, so the table is scanned once.
    The window has no partition key; it runs on the grouped rows, one per
    distinct rating value (ten on the half-step scale), never on ratings.
    """
    g = ratings.groupBy("rating").agg(F.count(F.lit(1)).alias("cnt"))
    total = F.sum("cnt").over(Window.partitionBy())
    return g.select("rating", "cnt", percent(F.col("cnt"), total).alias("percentage")) \
            .orderBy(F.desc("rating"))


def genre_distribution(movies: DataFrame, n: int = 10) -> DataFrame:
    """main_genre, cnt - movies per main genre, top ``n``; no-genre sentinel excluded."""
    return (movies.where(F.col("main_genre") != F.lit(NO_GENRE))
                  .groupBy("main_genre").agg(F.count(F.lit(1)).alias("cnt"))
                  .orderBy(F.desc("cnt"), F.asc("main_genre")).limit(n))


def genre_share(movies: DataFrame, n: int = 10) -> DataFrame:
    """main_genre, cnt, share_pct - share of each genre within the top ``n``."""
    top = genre_distribution(movies, n)
    total = F.sum("cnt").over(Window.partitionBy())   # at most n rows
    return top.select("main_genre", "cnt", percent(F.col("cnt"), total).alias("share_pct")) \
              .orderBy(F.desc("cnt"), F.asc("main_genre"))


# ---------------------------------------------------------------- per movie

def popular(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """movieId, title, rating_count, avg_rating - most rated movies."""
    return (_per_movie_with(ratings, movies, "title")
            .select("movieId", "title", F.col("n").alias("rating_count"),
                    _mean("s", "n").alias("avg_rating"))
            .orderBy(F.desc("rating_count"), F.asc("movieId")).limit(n))


def top_rated(ratings: DataFrame, movies: DataFrame, min_count: int = 50, n: int = 10) -> DataFrame:
    """movieId, title, rating_count, avg_rating - best mean among movies with enough ratings."""
    agg = per_movie(ratings).where(F.col("n") >= F.lit(min_count))
    return (agg.join(movies.select("movieId", "title"), "movieId")
               .select("movieId", "title", F.col("n").alias("rating_count"),
                       _mean("s", "n").alias("avg_rating"))
               .orderBy(F.desc("avg_rating"), F.asc("movieId")).limit(n))


def high_score(ratings: DataFrame, movies: DataFrame, min_count: int = 100,
               min_avg: float = 4.0) -> DataFrame:
    """movieId, title, main_genre, rating_count, avg_rating.

    Both thresholds apply to the unrounded mean; the order uses the rounded one.
    """
    agg = per_movie(ratings).where(
        (F.col("n") >= F.lit(min_count)) & (F.col("s") / F.col("n") >= F.lit(min_avg)))
    return (agg.join(movies.select("movieId", "title", "main_genre"), "movieId")
               .select("movieId", "title", "main_genre", F.col("n").alias("rating_count"),
                       _mean("s", "n").alias("avg_rating"))
               .orderBy(F.desc("avg_rating"), F.desc("rating_count"), F.asc("movieId")))


def movie_stats(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """movieId, title, main_genre, rating_cnt, avg_rating, min_rating, max_rating."""
    return (_per_movie_with(ratings, movies, "title", "main_genre")
            .select("movieId", "title", "main_genre", F.col("n").alias("rating_cnt"),
                    _mean("s", "n").alias("avg_rating"),
                    F.col("lo").alias("min_rating"), F.col("hi").alias("max_rating")))


def movie_stats_top(stats: DataFrame, min_count: int = 100, n: int = 10) -> DataFrame:
    """Read-back of the materialised movie_stats: best rounded mean, enough ratings."""
    return (stats.select("*").where(F.col("rating_cnt") >= F.lit(min_count))
                 .orderBy(F.desc("avg_rating"), F.asc("movieId")).limit(n))


# ---------------------------------------------------------------- by genre / year

def _rollup(ratings: DataFrame, movies: DataFrame, key: str, keep) -> DataFrame:
    """key, movie_count, rating_count, s: per-movie partials rolled up by ``key``."""
    return (_per_movie_with(ratings, movies.where(keep), key)
            .groupBy(key).agg(F.count(F.lit(1)).alias("movie_count"),
                              F.sum("n").alias("rating_count"), F.sum("s").alias("s")))


def genre_avg(ratings: DataFrame, movies: DataFrame, min_count: int = 100, n: int = 10) -> DataFrame:
    """main_genre, movie_count, rating_count, avg_rating - genres with enough ratings."""
    g = _rollup(ratings, movies, "main_genre", F.col("main_genre") != F.lit(NO_GENRE))
    return (g.where(F.col("rating_count") >= F.lit(min_count))
             .select("main_genre", "movie_count", "rating_count",
                     _mean("s", "rating_count").alias("avg_rating"))
             .orderBy(F.desc("avg_rating"), F.asc("main_genre")).limit(n))


def year_production(ratings: DataFrame, movies: DataFrame, n: int = 20) -> DataFrame:
    """year, movie_count, rating_count, avg_rating - the ``n`` latest release years."""
    g = _rollup(ratings, movies, "year", has_year("year"))
    return (g.select("year", "movie_count", "rating_count",
                     _mean("s", "rating_count").alias("avg_rating"))
             .orderBy(F.desc("year")).limit(n))


def year_trend(ratings: DataFrame, movies: DataFrame, n: int = 15) -> DataFrame:
    """year, cnt, avg_rating - ratings of the ``n`` latest release years."""
    g = _rollup(ratings, movies, "year", has_year("year"))
    return (g.select("year", F.col("rating_count").alias("cnt"),
                     _mean("s", "rating_count").alias("avg_rating"))
             .orderBy(F.desc("year")).limit(n))


def year_trend_of_table(spark, name: str, n: int = 15) -> DataFrame:
    """``year_trend`` over a table partitioned by ``year`` (``register_partitioned``): which years are
    the latest is read from the catalog, and only their folders are scanned."""
    latest = partition_values(spark, name, "year")[-n:]
    rows = spark.table(qualified(spark, name)).where(F.col("year").isin(latest) if latest else F.lit(False))
    return (rows.groupBy("year").agg(F.count("rating").alias("cnt"), F.sum("rating").alias("s"))
                .select("year", "cnt", _mean("s", "cnt").alias("avg_rating")).orderBy(F.desc("year")).limit(n))


# ---------------------------------------------------------------- per user

def user_activity(ratings: DataFrame) -> DataFrame:
    """userId, rating_count."""
    return ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("rating_count"))


def user_activity_stats(ratings: DataFrame) -> DataFrame:
    """One row: mean (1 decimal), max and min of ratings per user."""
    return user_activity(ratings).agg(
        round_half_up(F.avg("rating_count"), 1).alias("avg_per_user"),
        F.max("rating_count").alias("max_per_user"),
        F.min("rating_count").alias("min_per_user"))


def active_users(ratings: DataFrame, n: int = 10) -> DataFrame:
    """userId, rating_count, avg_user_rating, movie_variety - most active users.

    The distinct count is planned by Spark as a two-level aggregate
    (user, movie) then user, each with a map-side partial step, so a user
    with a huge history is pre-reduced before every shuffle.
    """
    return (ratings.groupBy("userId").agg(
                F.count("rating").alias("rating_count"),
                round_half_up(F.avg("rating"), 2).alias("avg_user_rating"),
                F.countDistinct("movieId").alias("movie_variety"))
            .orderBy(F.desc("rating_count"), F.asc("userId")).limit(n))


# ---------------------------------------------------------------- totals

def _n_distinct(df: DataFrame, col: str, name: str, approximate: bool) -> DataFrame:
    """One row: the number of distinct values of ``col``.

    Exact: a de-duplicating aggregate (partial per map task, so each task
    ships each key once) then a count.  Kept apart from the other totals: a
    single ``agg`` with two distinct counts makes Spark expand every input
    row once per distinct column.  ``approximate`` uses HyperLogLog++.
    """
    if approximate:
        return df.agg(F.approx_count_distinct(col).alias(name))
    return df.select(col).distinct().agg(F.count(F.lit(1)).alias(name))


def overall_summary(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """total_ratings, total_movies, total_users, avg_rating - one row."""
    # one pass: per user first, then over the users
    users = ratings.groupBy("userId").agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("s"),
                                          F.count("rating").alias("c"))
    parts = [users.agg(F.sum("n").alias("total_ratings"), F.count(F.lit(1)).alias("total_users"),
                       F.sum("s").alias("s"), F.sum("c").alias("c")),
             movies.agg(F.count(F.lit(1)).alias("total_movies"))]
    t = _sum_scalars(parts, ["total_ratings", "total_movies", "total_users", "s", "c"])
    return t.select(F.coalesce("total_ratings", F.lit(0)).alias("total_ratings"), "total_movies", "total_users",
                    round_half_up(F.col("s") / F.col("c"), 2).alias("avg_rating"))


def dataset_summary(ratings: DataFrame, movies: DataFrame, approximate: bool = False) -> DataFrame:
    """n_ratings, n_movies, n_users, n_rated, density_pct, sparsity_pct - one row.

    density = ratings / (users x rated movies) x 100.  ``approximate=True``
    counts distinct users and movies with HyperLogLog++ (one pass, no
    shuffle of keys) for very large inputs.
    """
    if approximate:
        rows = ratings.agg(F.count(F.lit(1)).alias("n_ratings"), F.approx_count_distinct("userId").alias("n_users"))
    else:                               # the per-user pass also counts the rows
        rows = user_activity(ratings).agg(F.coalesce(F.sum("rating_count"), F.lit(0)).alias("n_ratings"),
                                          F.count(F.lit(1)).alias("n_users"))
    parts = [rows,
             _n_distinct(ratings, "movieId", "n_rated", approximate),
             movies.agg(F.count(F.lit(1)).alias("n_movies"))]
    t = _sum_scalars(parts, ["n_ratings", "n_movies", "n_users", "n_rated"])
    dens = F.try_divide(F.col("n_ratings").cast("double") * F.lit(100.0),
                        F.col("n_users").cast("double") * F.col("n_rated"))
    return t.select("n_ratings", "n_movies", "n_users", "n_rated",
                    round_half_up(dens, 2).alias("density_pct"),
                    round_half_up(F.lit(100.0) - dens, 2).alias("sparsity_pct"))
