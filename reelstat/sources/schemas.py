"""Explicit schemas of every table the engine reads or writes.

Schemas are never inferred: inference turns ``year`` into an int and
``date`` into a DateType, which breaks the string filters downstream.
"""

from pyspark.sql import types as T

RATINGS_RAW = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

RATINGS_CLEAN = T.StructType([
    T.StructField("userId", T.IntegerType()),
    T.StructField("movieId", T.IntegerType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("date", T.StringType()),
])

MOVIES_RAW = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

MOVIES_CLEAN = T.StructType([
    T.StructField("movieId", T.IntegerType()),
    T.StructField("title", T.StringType()),
    T.StructField("year", T.StringType()),
    T.StructField("genres", T.StringType()),
    T.StructField("main_genre", T.StringType()),
])


def ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, e.g. ``userId INT, movieId INT``."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString().upper()}" for f in schema.fields)
