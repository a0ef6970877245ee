"""Schemas, file sources/sinks, catalog tables and the test-table adapter."""

from reelstat.sources import schemas, testdata
from reelstat.sources.catalog import (
    cached, materialize, overwrite_partitions, partition_values, qualified, register_external, register_partitioned,
)
from reelstat.sources.files import (
    read_csv, read_movies, read_movies_clean, read_ratings, read_ratings_clean,
    write_result, write_table,
)

__all__ = [
    "schemas", "testdata", "cached", "materialize", "overwrite_partitions", "partition_values", "qualified",
    "register_external", "register_partitioned", "read_csv",
    "read_movies", "read_movies_clean", "read_ratings", "read_ratings_clean",
    "write_result", "write_table",
]
