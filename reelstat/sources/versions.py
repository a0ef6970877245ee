"""Versioned tables: complete folders under a base, and a log that names the current one.

A writer fills a folder of its own and then adds the next numbered entry to the log: a small file
written aside and renamed to a name that must not exist yet, one atomic step of the file system.
The highest entry is the current version.  Readers look it up when they are planned and go on
reading their version while a newer one is written; a writer that dies leaves the log as it was;
of two writers that start from the same version the second is refused.  Old versions stay until
``prune`` is called.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

from reelstat.session import absolute

LOG = "_log"


class VersionConflict(RuntimeError):
    """Another writer published a version in the meantime."""


def _files(spark: SparkSession, base: str):
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(absolute(base))
    return hadoop, path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def latest(spark: SparkSession, base: str) -> int:
    """The number of the log's last entry; 0 if there is none."""
    hadoop, path, system = _files(spark, base)
    log = hadoop.fs.Path(path, LOG)
    if not system.exists(log):
        return 0
    names = [s.getPath().getName() for s in system.listStatus(log)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def current(spark: SparkSession, base: str, number: int | None = None) -> str | None:
    """The folder of the last version, or of entry ``number``; None if there is no version yet."""
    number = latest(spark, base) if number is None else number
    if not number:
        return None
    hadoop, path, system = _files(spark, base)
    entry = system.open(hadoop.fs.Path(path, f"{LOG}/{number:020d}"))
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(entry, "UTF-8").strip()
    finally:
        entry.close()
    return f"{absolute(base).rstrip('/')}/{name}"


def publish(spark: SparkSession, base: str, name: str, after: int | None = None) -> int:
    """Make folder ``name`` the current version, as the entry behind ``after`` (the last one, if
    not given); its number.  VersionConflict if that entry is there already."""
    hadoop, path, system = _files(spark, base)
    number = (latest(spark, base) if after is None else after) + 1
    aside, entry = hadoop.fs.Path(path, f"{LOG}/.{uuid.uuid4().hex}"), hadoop.fs.Path(path, f"{LOG}/{number:020d}")
    out = system.create(aside)
    out.write(bytearray(name, "utf-8"))
    out.close()
    context = hadoop.fs.FileContext.getFileContext(system.getUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(entry), options)
    except Py4JJavaError as error:
        system.delete(aside, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise VersionConflict(f"{base} has a version {number} already") from None
        raise
    return number


def write_version(spark: SparkSession, base: str, write: Callable[[str], None], after: int | None = None) -> str:
    """Run ``write(folder)`` on a new folder under ``base``, then publish it; its path."""
    name = f"v-{uuid.uuid4().hex}"
    folder = f"{absolute(base).rstrip('/')}/{name}"
    write(folder)
    publish(spark, base, name, after)
    return folder


def prune(spark: SparkSession, base: str) -> int:
    """Delete all versions but the current one (none may still be read); how many."""
    hadoop, path, system = _files(spark, base)
    keep = (current(spark, base) or "").rsplit("/", 1)[-1]
    gone = 0
    for status in system.listStatus(path):
        name = status.getPath().getName()
        if name.startswith("v-") and name != keep:
            system.delete(status.getPath(), True)
            gone += 1
    return gone
