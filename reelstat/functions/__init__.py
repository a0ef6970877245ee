"""Scalar column expressions (dates, titles, genres, rounding, hashing)."""

from reelstat.functions.expressions import (
    DATE_FORMAT, GENRE_SEPARATOR, NO_GENRE, YEAR_PATTERN, epoch_to_date, has_year,
    hash_bucket, hash_bucket_sql, main_genre, percent, release_year, round_half_up,
)

__all__ = [
    "DATE_FORMAT", "GENRE_SEPARATOR", "NO_GENRE", "YEAR_PATTERN", "epoch_to_date",
    "has_year", "hash_bucket", "hash_bucket_sql", "main_genre", "percent", "release_year", "round_half_up",
]
