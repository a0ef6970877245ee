"""Approximate nearest vectors by random-projection hash tables with multi-probe.

Opt-in: ``similarity.cosine_top_k`` is exact and scores all pairs; this route scores only
pairs that meet in a bucket, and its recall is to be measured (``recall``) on the vectors at
hand.  In each of ``tables`` tables a unit vector's bucket is the signs of its projections on
``bits`` random vectors; close vectors differ in few signs, and those with small projections
first.  A vector is searched for in its own bucket and, by multi-probe, in the buckets that
differ in one of its ``probes`` least certain signs, which saves most of the tables that
single probes would need.

A bucket is one group of a shuffle, scored by the blocked kernel with k partners kept for each
vector; a bucket that outgrows a block is cut into block pairs as the exact operator's are, so
a hot bucket is many tasks.  No pairs are written, only k per vector and bucket.  The
projections are the integer key hash of (plane, dimension): the same in any engine, which is
how the result itself has an oracle.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.functions.expressions import HASH_KEYS, HASH_MULT, HASH_PRIME
from reelstat.operators import topk_kernel
from reelstat.operators.similarity import BLOCK_BYTES, _extent, _vectors

SEED = 42
#: Vectors of a bucket aimed at where the number of bits is left open.
BUCKET_ROWS = 2048
#: Asking or searched vectors of a bucket in one task; more are cut into block pairs.
BLOCK_ROWS = 16384


def approximate_top_k(vectors: DataFrame, k: int = 5, queries: DataFrame | None = None, *, tables: int = 12,
                      bits: int | None = None, probes: int = 4, seed: int = SEED, id_col: str = "id",
                      vec_col: str = "features", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """i, j, score, rank - up to k near ``j`` of each ``i`` by cosine, self excluded.  Approximate.

    A pair is scored if it meets in one of the tables; scores and the order of what is found
    are exact (ties to the lower id).  ``queries`` (column ``id_col``) restricts the ``i`` side.
    ``bits``: signs per table, by default so many that a bucket holds about BUCKET_ROWS vectors;
    fewer bits, more tables or probes raise recall and work.  A zero vector meets the vectors
    that share its bucket, at cosine 0.  One sizing job runs when this is called.
    """
    v = _vectors(vectors, id_col, vec_col)
    n, width = _extent(v)
    if bits is None:
        bits = max(1, math.ceil(math.log2(max(2, n / BUCKET_ROWS))))
    block_rows = max(1, min(block_rows, BLOCK_BYTES // (8 * max(1, width))))
    if queries is None:
        v = v.withColumn("ask", F.lit(True))
    else:
        ids = queries.select(F.col(id_col).cast("long").alias("id")).distinct().withColumn("ask", F.lit(True))
        v = v.join(ids, "id", "left").withColumn("ask", F.coalesce("ask", F.lit(False)))
    vec = v.schema["v"].dataType.simpleString()
    hashed = v.mapInArrow(
        topk_kernel.hash_task(tables, bits, probes, seed, (HASH_PRIME, HASH_MULT, HASH_KEYS)),
        f"id long, v {vec}, bucket long, role int")
    # a bucket's searched and asking vectors are cut into blocks; the sizes are at most
    # tables * 2**bits rows, and the join splits a hot bucket
    sizes = hashed.groupBy("bucket").agg(
        F.ceil(F.count(F.when(F.col("role") > 0, 1)) / block_rows).alias("have"),
        F.ceil(F.count(F.when(F.col("role") != 1, 1)) / block_rows).alias("asks")).where("have > 0 AND asks > 0")
    dealt = hashed.join(sizes, "bucket")
    whole = (F.col("have") == 1) & (F.col("asks") == 1)

    def blocks(of: str) -> F.Column:
        return F.sequence(F.lit(0).cast("long"), F.col(of) - 1)

    mine = F.xxhash64("id")
    asking = dealt.where(~whole & (F.col("role") != 1)).select(
        "bucket", F.pmod(mine, F.col("asks")).alias("x"), F.explode(blocks("have")).alias("y"), "id", "v", F.lit(0).alias("role"))
    searched = dealt.where(~whole & (F.col("role") > 0)).select(
        "bucket", F.explode(blocks("asks")).alias("x"), F.pmod(mine, F.col("have")).alias("y"), "id", "v", F.lit(1).alias("role"))
    small = dealt.where(whole).select("bucket", F.lit(0).cast("long").alias("x"), F.lit(0).cast("long").alias("y"), "id", "v", "role")
    found = small.unionByName(asking).unionByName(searched).groupBy("bucket", "x", "y").applyInArrow(
        topk_kernel.bucket_task(k, True, np.float64), "i long, j long, score double")
    # a pair met in several tables counts once
    once = found.groupBy("i", "j").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("i").orderBy(F.desc("score"), "j"))
    return once.withColumn("rank", rank).where(F.col("rank") <= k)


def recall(found: DataFrame, truth: DataFrame) -> DataFrame:
    """pairs, found, recall (4 decimals) - the share of the true pairs (i, j) that were found."""
    hit = truth.select("i", "j").join(found.select("i", "j", F.lit(1).alias("hit")), ["i", "j"], "left")
    return hit.agg(F.count(F.lit(1)).alias("pairs"), F.count("hit").alias("found")).select(
        "pairs", "found", F.round(F.col("found") / F.col("pairs"), 4).alias("recall"))
