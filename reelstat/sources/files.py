"""File sources and sinks.

CSV is read and written with a header, ``"`` as quote *and* escape (inner
quotes doubled, as the data set's own files do) and an explicit schema.
Parquet is the default format for derived tables: it keeps types, prunes
columns and takes pushed-down filters.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reelstat.sources import schemas

CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"'}
# On reading, a quoted empty field is the empty string and a bare one is null;
# Spark would make both null while its null text is the empty one.
NO_NULL_TEXT = "\x01"


def read_csv(spark: SparkSession, path: str, schema: StructType,
             mode: str = "FAILFAST") -> DataFrame:
    """Headered CSV with a fixed schema.

    ``mode='FAILFAST'`` aborts on a malformed record (a rating that is not a
    number), ``'DROPMALFORMED'`` drops it, ``'PERMISSIVE'`` nulls it.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS).options(nullValue=NO_NULL_TEXT, mode=mode).csv(path)


def read_ratings(spark, path, mode="FAILFAST"):
    """Raw ratings CSV: userId, movieId, rating, timestamp (epoch seconds)."""
    return read_csv(spark, path, schemas.RATINGS_RAW, mode)


def read_movies(spark, path, mode="FAILFAST"):
    """Raw movies CSV: movieId, title, genres (pipe-separated)."""
    return read_csv(spark, path, schemas.MOVIES_RAW, mode)


def read_ratings_clean(spark, path, fmt="csv", mode="FAILFAST"):
    """Cleaned ratings (userId, movieId, rating, date) in CSV or another format."""
    if fmt == "csv":
        return read_csv(spark, path, schemas.RATINGS_CLEAN, mode)
    return spark.read.schema(schemas.RATINGS_CLEAN).format(fmt).load(path)


def read_movies_clean(spark, path, fmt="csv", mode="FAILFAST"):
    """Cleaned movies (movieId, title, year, genres, main_genre); ``year`` stays a string."""
    if fmt == "csv":
        return read_csv(spark, path, schemas.MOVIES_CLEAN, mode)
    return spark.read.schema(schemas.MOVIES_CLEAN).format(fmt).load(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None) -> None:
    """Write a (possibly huge) table as many files, one per partition."""
    w = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        w = w.options(**CSV_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)


def write_result(df: DataFrame, path: str, fmt: str = "csv", mode: str = "overwrite",
                 single_file: bool = False) -> None:
    """Write an analysis result.

    ``single_file=True`` funnels the rows through one task and is meant for
    bounded results only (top-k tables, per-rating counts); per-user or
    per-movie results should stay split.
    """
    if single_file:
        df = df.coalesce(1)
    write_table(df, path, fmt=fmt, mode=mode)
