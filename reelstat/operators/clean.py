"""Cleaning: raw ratings and raw movies into their analysis shape.

Both are narrow row-wise transforms (no shuffle); Spark splits the input by
file block and runs them inside one codegen stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions import epoch_to_date, main_genre, release_year

MIN_RATING, MAX_RATING = 0.5, 5.0   # valid rating range of the data set


def clean_ratings(raw: DataFrame, min_rating: float = MIN_RATING, max_rating: float = MAX_RATING,
                  step: float | None = None, tz: str | None = None) -> DataFrame:
    """Keep ratings in ``[min_rating, max_rating]``; epoch seconds -> date.

    NaN, infinities and nulls fail the range test and are dropped.  ``step``
    (off by default) also requires the rating to be a multiple of it, up to the
    rounding of binary doubles (0.3 is a multiple of 0.1).
    ``tz`` names the zone of the date; ``None`` uses the session zone.
    """
    r = F.col("rating")
    keep = r.between(F.lit(min_rating), F.lit(max_rating)) & ~F.isnan(r)
    if step:
        q = r / F.lit(step)
        keep = keep & (F.abs(q - F.round(q)) <= F.lit(1e-9) * F.greatest(F.abs(q), F.lit(1.0)))
    return raw.where(keep).select(
        "userId", "movieId", "rating", epoch_to_date("timestamp", tz).alias("date"))


def clean_movies(raw: DataFrame) -> DataFrame:
    """Add ``year`` (first '(dddd)' in the title, '' if none) and ``main_genre``."""
    return raw.select("movieId", "title",
                      release_year("title").alias("year"),
                      "genres",
                      main_genre("genres").alias("main_genre"))
