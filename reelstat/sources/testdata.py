"""Adapter: the generated test tables in the shape of the ratings data set.

The test tables are not ratings, so both this module and the SQL oracle map
them the same way:

* ratings  - one per lineitem: user = the order's customer, item = the part,
             rating = ceil(quantity / 5) / 2 (the ten half steps 0.5 .. 5.0),
             timestamp = ship date in epoch seconds.
* movies   - one per part: a release year is appended to most names, genres
             are the part type, mostly followed by the brand.
* events   - raw ratings with values outside the valid range, for cleaning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.functions import NO_GENRE

# Fixed values of the adapter (shared with the SQL oracle).
NO_YEAR_MOD, NO_YEAR_REM = 20, 7        # p_partkey % 20 = 7 -> title without year
NO_GENRE_MOD, NO_GENRE_REM = 29, 3      # p_partkey % 29 = 3 -> '(no genres listed)'
ONE_GENRE_MOD = 3                       # p_partkey % 3 = 0 -> a single genre
YEAR_BASE = 1968                        # year = 1968 + p_size
EVENT_ITEMS = 100                       # event item = event_id % 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _epoch_seconds(ts_ntz) -> F.Column:
    # Parquet timestamps load as TIMESTAMP_NTZ; read them as UTC wall clock.
    return F.unix_timestamp(F.col(ts_ntz).cast("timestamp"))


def raw_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """userId, movieId, rating, timestamp - one row per lineitem."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (li.join(od, li.l_orderkey == od.o_orderkey)
              .select(F.col("o_custkey").cast("int").alias("userId"),
                      F.col("l_partkey").cast("int").alias("movieId"),
                      (F.ceil(F.col("l_quantity") / 5) / F.lit(2.0)).alias("rating"),
                      _epoch_seconds("l_shipdate").alias("timestamp")))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned ratings (userId, movieId, rating, date)."""
    from reelstat.operators.clean import clean_ratings
    return clean_ratings(raw_ratings(spark, sf_dir))


def raw_movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size")
    key = F.col("p_partkey")
    title = F.when(key % NO_YEAR_MOD == NO_YEAR_REM, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.lit(" ("), (F.lit(YEAR_BASE) + F.col("p_size")).cast("string"), F.lit(")")))
    genres = (F.when(key % NO_GENRE_MOD == NO_GENRE_REM, F.lit(NO_GENRE))
               .when(key % ONE_GENRE_MOD == 0, F.col("p_type"))
               .otherwise(F.concat(F.col("p_type"), F.lit("|"), F.col("p_brand"))))
    return p.select(key.cast("int").alias("movieId"), title.alias("title"), genres.alias("genres"))


def movies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned movies (movieId, title, year, genres, main_genre)."""
    from reelstat.operators.clean import clean_movies
    return clean_movies(raw_movies(spark, sf_dir))


def raw_event_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw ratings from ``events``: values spread beyond 0.5 .. 5.0."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "value", "ts")
    return ev.select(F.col("user_id").cast("int").alias("userId"),
                     (F.col("event_id") % EVENT_ITEMS).cast("int").alias("movieId"),
                     F.col("value").alias("rating"),
                     _epoch_seconds("ts").alias("timestamp"))


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, vector - ready item vectors for the cosine top-k operator."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("features"))
