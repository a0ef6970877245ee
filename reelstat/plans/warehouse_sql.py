"""The warehouse route: the analysis queries as Spark SQL over catalog tables.

``ratings_ext`` (userId, movieId, rating, date) and ``movies_ext`` (movieId,
title, year, genres, main_genre) are catalog tables of the current database, as
``register_external`` makes them; no temporary view can stand in for them.  Other tables or
views are read where the parameters ``ratings`` and ``movies`` name them (``views``).  The SQL
aggregates ratings per movie before joining the catalogue (the same plan
as the DataFrame operators), rounds means half-up through decimal(38,12) and
ends every ORDER BY .. LIMIT with the entity key.
"""

from __future__ import annotations

import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

from reelstat.sources.catalog import qualified

_R2 = "CAST(ROUND(CAST({} AS DECIMAL(38,12)), 2) AS DOUBLE)"

PER_MOVIE = """
  SELECT movieId, COUNT(rating) AS n, SUM(rating) AS s, MIN(rating) AS lo, MAX(rating) AS hi
  FROM {ratings} GROUP BY movieId"""

STATEMENTS = {
    "rating_distribution_pct": f"""
SELECT rating, COUNT(*) AS cnt,
       {_R2.format("COUNT(*) * CAST(100 AS DOUBLE) / SUM(COUNT(*)) OVER ()")} AS percentage
FROM {{ratings}} GROUP BY rating ORDER BY rating DESC""",

    "genre_avg": f"""
WITH pm AS ({PER_MOVIE})
SELECT m.main_genre, COUNT(*) AS movie_count, SUM(pm.n) AS rating_count,
       {_R2.format("SUM(pm.s) / SUM(pm.n)")} AS avg_rating
FROM pm JOIN {{movies}} m ON pm.movieId = m.movieId
WHERE m.main_genre != '(no genres listed)'
GROUP BY m.main_genre
HAVING SUM(pm.n) >= {{min_count}}
ORDER BY avg_rating DESC, main_genre
LIMIT {{n}}""",

    "year_production": f"""
WITH pm AS ({PER_MOVIE})
SELECT m.`year`, COUNT(*) AS movie_count, SUM(pm.n) AS rating_count,
       {_R2.format("SUM(pm.s) / SUM(pm.n)")} AS avg_rating
FROM pm JOIN {{movies}} m ON pm.movieId = m.movieId
WHERE m.`year` IS NOT NULL AND m.`year` != ''
GROUP BY m.`year`
ORDER BY m.`year` DESC
LIMIT {{n}}""",

    "high_score": f"""
WITH pm AS ({PER_MOVIE})
SELECT m.movieId, m.title, m.main_genre, pm.n AS rating_count,
       {_R2.format("pm.s / pm.n")} AS avg_rating
FROM pm JOIN {{movies}} m ON pm.movieId = m.movieId
WHERE pm.n >= {{min_count}} AND pm.s / pm.n >= {{min_avg}}
ORDER BY avg_rating DESC, rating_count DESC, m.movieId""",

    "active_users": f"""
SELECT userId, COUNT(rating) AS rating_count,
       {_R2.format("AVG(rating)")} AS avg_user_rating,
       COUNT(DISTINCT movieId) AS movie_variety
FROM {{ratings}}
GROUP BY userId
ORDER BY rating_count DESC, userId
LIMIT {{n}}""",

    "movie_stats": f"""
WITH pm AS ({PER_MOVIE})
SELECT m.movieId, m.title, m.main_genre, pm.n AS rating_cnt,
       {_R2.format("pm.s / pm.n")} AS avg_rating, pm.lo AS min_rating, pm.hi AS max_rating
FROM pm JOIN {{movies}} m ON pm.movieId = m.movieId""",

    "movie_stats_top": """
SELECT * FROM {table} WHERE rating_cnt >= {min_count} ORDER BY avg_rating DESC, movieId LIMIT {n}""",
}

DEFAULTS = {
    "genre_avg": {"min_count": 100, "n": 10},
    "year_production": {"n": 20},
    "high_score": {"min_count": 100, "min_avg": 4.0},
    "active_users": {"n": 10},
    "movie_stats_top": {"min_count": 100, "n": 10},
}


def statement(spark: SparkSession, name: str, **params) -> str:
    """The statement's text; tables that are not given are those of the current database."""
    tables = {"ratings": "ratings_ext", "movies": "movies_ext", "table": "movie_stats"}
    args = {k: qualified(spark, v) for k, v in tables.items()} | DEFAULTS.get(name, {}) | params
    return STATEMENTS[name].format(**{k: repr(v) if isinstance(v, float) else v for k, v in args.items()})


@contextlib.contextmanager
def views(ratings: DataFrame, movies: DataFrame):
    """DataFrames as temporary views under names of their own, dropped on exit: the parameters
    ``ratings`` and ``movies`` of ``run``.  Results planned inside stay valid after it."""
    tag = uuid.uuid4().hex[:12]
    names = {"ratings": f"ratings_view_{tag}", "movies": f"movies_view_{tag}"}
    ratings.createOrReplaceTempView(names["ratings"])
    movies.createOrReplaceTempView(names["movies"])
    try:
        yield names
    finally:
        for view in names.values():
            ratings.sparkSession.catalog.dropTempView(view)


def run(spark: SparkSession, name: str, **params) -> DataFrame:
    """Run one warehouse statement.

    ``movie_stats_top`` reads the table named by ``table`` (default
    ``movie_stats``; ``materialize`` it first).
    """
    return spark.sql(statement(spark, name, **params))
