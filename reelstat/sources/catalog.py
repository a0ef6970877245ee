"""Catalog tables: external tables over files, materialised aggregates, caching."""

from __future__ import annotations

import contextlib
import re

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from reelstat.session import absolute
from reelstat.sources.schemas import ddl


def _quote(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def table_location(spark: SparkSession, name: str) -> str | None:
    """Where a catalog table's files lie; None if there is no such table."""
    if not spark.catalog.tableExists(name):
        return None
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").collect()
    return rows[0]["data_type"] if rows else None


def qualified(spark: SparkSession, name: str) -> str:
    """The name with its database, which no temporary view can hide."""
    return name if "." in name else f"spark_catalog.{spark.catalog.currentDatabase()}.{name}"


def _same_place(a: str, b: str) -> bool:
    plain = lambda p: re.sub(r"^file:/+", "/", p).rstrip("/")
    return plain(a) == plain(b)


def register_external(spark: SparkSession, name: str, path: str, schema: StructType,
                      fmt: str = "csv", replace: bool = False) -> DataFrame:
    """Register an external table over a directory of files.

    Dropping the table keeps the files.  CSV tables use a header and ``"`` as
    escape, so titles with commas and quotes stay in their column.  A table of that
    name at another place is an error, or with ``replace`` is registered anew.  The
    scan returned is of the table even where a temporary view has its name.
    """
    path = absolute(path)                # LOCATION would resolve against the warehouse folder
    name = qualified(spark, name)
    known = table_location(spark, name)
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    elif known is not None and not _same_place(known, path):
        raise ValueError(f"table {name} already lies at {known}, not at {path}")
    opts = ""
    if fmt == "csv":
        opts = "OPTIONS (header 'true', quote '\"', escape '\"', nullValue '\x01', mode 'FAILFAST')"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING {fmt} {opts} "
              f"LOCATION {_quote(path)}")
    if known is not None:
        spark.catalog.refreshTable(name)          # files may have come or gone since
    return spark.table(name)


def overwrite_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Write ``df`` into a folder partitioned by ``by``, replacing the partitions that it has rows
    of and no others (dynamic overwrite).  Rows are gathered by partition first (rebalance), so a
    task writes few partitions and a partition few files; a hot partition is split by AQE."""
    (df.hint("rebalance", *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(*by).parquet(absolute(path)))


def register_partitioned(spark: SparkSession, name: str, path: str, schema: StructType, by: list[str]) -> DataFrame:
    """An external Parquet table over a partitioned folder, with its partitions as they are now.

    ``schema`` names all columns, those of ``by`` last.  Filters on them read only the
    folders they need.  Calling it again takes up partitions that came or went."""
    name = qualified(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({ddl(schema)}) USING parquet PARTITIONED BY ({', '.join(by)}) "
              f"LOCATION {_quote(absolute(path))}")
    spark.sql(f"MSCK REPAIR TABLE {name} SYNC PARTITIONS")
    spark.catalog.refreshTable(name)
    return spark.table(name)


def partition_values(spark: SparkSession, name: str, column: str) -> list[str]:
    """The values of a partition column, from the catalog alone (no file is read)."""
    rows = spark.sql(f"SHOW PARTITIONS {qualified(spark, name)}").collect()
    parts = (dict(p.split("=", 1) for p in r[0].split("/")) for r in rows)
    return sorted({p[column] for p in parts if p[column] != "__HIVE_DEFAULT_PARTITION__"})


def materialize(df: DataFrame, name: str, mode: str = "ignore", fmt: str = "parquet",
                bucket_by: tuple[int, str] | None = None, sort_by: str | None = None,
                path: str | None = None) -> DataFrame:
    """Save an aggregate as a catalog table and return a scan of it.

    ``mode='ignore'`` keeps an existing table (CREATE TABLE IF NOT EXISTS);
    ``'overwrite'`` refreshes it.  ``bucket_by=(n, col)`` stores it bucketed so
    later joins and aggregations on ``col`` need no shuffle.  ``path`` puts
    the files in a chosen (shared) folder instead of the warehouse folder.
    """
    w = df.write.mode(mode).format(fmt)
    if path:
        w = w.option("path", absolute(path))
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1])
        if sort_by:
            w = w.sortBy(sort_by)
    w.saveAsTable(name)
    return df.sparkSession.table(name)


@contextlib.contextmanager
def cached(*dfs: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK):
    """Persist inputs shared by several actions; on exit unpersist those that were not
    already persisted by the caller."""
    own = [d for d in dfs if not (d.storageLevel.useMemory or d.storageLevel.useDisk)]
    for d in own:
        d.persist(level)
    try:
        yield dfs if len(dfs) > 1 else dfs[0]
    finally:
        for d in own:
            d.unpersist()
