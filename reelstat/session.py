"""Session helpers.

The library never creates a session behind the caller's back: operators use
the session of the DataFrames they receive.  ``build_session`` is for tests,
the bench and scripts; on a cluster the submitter's session is used as is.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Settings results depend on (dates are formatted in the session zone).
RESULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
}

# Execution settings: adaptive re-planning coalesces small shuffle
# partitions, splits skewed join partitions and switches joins to
# broadcast only once the runtime size of a side is known.
EXEC_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "reelstat",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {**RESULT_CONF, **EXEC_CONF}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    # getOrCreate may hand back a running session: apply SQL confs anyway.
    for k, v in conf.items():
        if k.startswith("spark.sql.") and spark.conf.isModifiable(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Point RDD/DataFrame checkpoints at the cluster's shared folder.

    The folder comes from ``spark.checkpoint.dir`` as the cluster sets it.
    Only when that is unset (local tests) is a private folder created.
    Iterative jobs (ALS) checkpoint there so a lost executor does not force
    a recompute of the whole lineage.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors "
                               "(a machine-local folder does not survive executor loss)")
        path = tempfile.mkdtemp(prefix="reelstat-ckpt-")   # local mode (tests) only
        spark.conf.set("spark.checkpoint.dir", path)
    sc.setCheckpointDir(path)
    return path


def has_scheme(path: str) -> bool:
    """True for URIs such as ``file:/x``, ``hdfs://nn/x``, ``s3a://b/x``."""
    return re.match(r"^[A-Za-z][A-Za-z0-9+.-]+:", path) is not None


def join_path(base: str, name: str) -> str:
    return base.rstrip("/") + "/" + name if has_scheme(base) else os.path.join(base, name)


def absolute(path: str) -> str:
    """Local relative paths made absolute; URIs and absolute paths unchanged."""
    return path if has_scheme(path) or path.startswith("/") else os.path.abspath(path)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return join_path(ensure_checkpoint_dir(spark), name)
