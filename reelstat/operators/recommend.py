"""Collaborative filtering: split, ALS fit, evaluation, recommendations.

ALS is Spark ML's block-partitioned alternating least squares.  The fit
checkpoints its factor lineage every ``checkpoint_interval`` iterations into
the session's shared checkpoint folder, so a lost executor costs at most
that many iterations.  The number of factor blocks is part of the model: it decides
how the random start is laid out, so it is a fixed argument and never taken from the
cores at hand.
"""

from __future__ import annotations

import functools
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.util import inheritable_thread_target

from reelstat.functions import hash_bucket, round_half_up
from reelstat.operators.similarity import BLOCK_ROWS, cosine_top_k, pruned_dot_top_k
from reelstat.session import ensure_checkpoint_dir, shared_dir
from reelstat.sources import versions

SPLIT_BUCKETS = 10000


# ---------------------------------------------------------------- split

def split_flag(train_fraction: float = 0.8, seed: int = 42) -> F.Column:
    """True for the training side of the key-hash split."""
    cut = int(round(train_fraction * SPLIT_BUCKETS))
    return hash_bucket(["userId", "movieId"], seed, SPLIT_BUCKETS) < F.lit(cut)


def split_ratings(ratings: DataFrame, train_fraction: float = 0.8, seed: int = 42,
                  method: str = "hash") -> tuple[DataFrame, DataFrame]:
    """(train, test).

    ``method='hash'`` decides per (user, movie) key, independent of partition
    layout and executor count; repeat ratings of a pair stay on one side.
    ``'random'`` is ``randomSplit`` (depends on the input's partitioning).
    """
    if method == "random":
        tr, te = ratings.randomSplit([train_fraction, 1.0 - train_fraction], seed)
        return tr, te
    flag = split_flag(train_fraction, seed)
    return ratings.where(flag), ratings.where(~flag)


def split_summary(ratings: DataFrame, train_fraction: float = 0.8, seed: int = 42) -> DataFrame:
    """train, n, rating_sum - size and rating sum of both sides of the hash split."""
    return (ratings.groupBy(split_flag(train_fraction, seed).alias("train"))
            .agg(F.count(F.lit(1)).alias("n"), F.sum("rating").alias("rating_sum")))


def cold_start_summary(train: DataFrame, test: DataFrame) -> DataFrame:
    """test_rows, kept, dropped - test rows whose user and movie both occur in train.

    These are the rows a model with ``coldStartStrategy='drop'`` scores.
    The distinct key sets of train are small next to the ratings; Spark
    broadcasts them when they are under the threshold, else shuffles.
    """
    tu = train.select("userId").distinct().withColumn("_u", F.lit(True))
    ti = train.select("movieId").distinct().withColumn("_i", F.lit(True))
    # repeat ratings of a pair collapse (map-side) before the joins
    pairs = test.groupBy("userId", "movieId").agg(F.count(F.lit(1)).alias("_n"))
    t = pairs.join(tu, "userId", "left").join(ti, "movieId", "left")
    seen = F.col("_u").isNotNull() & F.col("_i").isNotNull()
    return (t.agg(F.sum("_n").alias("test_rows"),
                  F.sum(F.when(seen, F.col("_n")).otherwise(F.lit(0))).alias("kept"))
             .withColumn("dropped", F.col("test_rows") - F.col("kept")))


# ---------------------------------------------------------------- fit / predict

def _int_id(name: str) -> F.Column:
    exact = F.col(name).try_cast("decimal(38,6)")
    fits = (exact == F.floor(exact)) & exact.between(-(1 << 31), (1 << 31) - 1)
    refused = F.raise_error(F.concat(F.lit(f"{name} is no int: "), F.col(name).cast("string")))
    return F.when(F.col(name).isNull(), F.lit(None)).when(fits, exact.try_cast("int")).otherwise(refused).cast("int").alias(name)


def to_als_input(ratings: DataFrame) -> DataFrame:
    """userId int, movieId int, rating double; unusable ratings (null, NaN, <= 0) removed.

    Ids may be numbers or numeric strings; one with a fraction or outside the int
    range is an error, never truncated.
    """
    r = F.col("rating").cast("double")
    return ratings.select(_int_id("userId"), _int_id("movieId"), r.alias("rating")) \
                  .where(r.isNotNull() & ~F.isnan(r) & (r > F.lit(0.0)))


def fit_als(train: DataFrame, rank: int = 20, max_iter: int = 10, reg_param: float = 0.1,
            nonnegative: bool = True, seed: int = 42, cold_start: str = "drop",
            num_blocks: int = 10, checkpoint_interval: int = 2,
            layout_partitions: int | None = None, storage: str = "DISK_ONLY") -> ALSModel:
    """Explicit-feedback ALS.

    The input is laid out by a hash of (user, movie) and sorted inside each
    partition before fitting, so the same ratings refit to the same factors
    whatever partitioning they arrive in and whatever cores run it (with the fixed
    seed and ``num_blocks``).  Other ``num_blocks`` give another model; raise it for
    factors that outgrow a task, and keep it then.

    A task of a half-step holds one rating block and nearly all factors of the other side.
    ``storage`` is where rating blocks and finished factors wait meanwhile: on the executors'
    disks, since in memory they would take the room of those tasks, most of all where several
    fits run side by side.  It moves no result.
    """
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    parts = layout_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    data = (to_als_input(train).repartition(parts, "userId", "movieId")
            .sortWithinPartitions("userId", "movieId", "rating"))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg_param, nonnegative=nonnegative,
              userCol="userId", itemCol="movieId", ratingCol="rating",
              coldStartStrategy=cold_start, seed=seed, checkpointInterval=checkpoint_interval,
              numUserBlocks=num_blocks, numItemBlocks=num_blocks,
              intermediateStorageLevel=storage, finalStorageLevel=storage)
    return als.fit(data)


def predict(model: ALSModel, test: DataFrame) -> DataFrame:
    """Test rows with ``prediction``; rows of unseen users/movies dropped.

    The rows and float32 scores of ``model.transform``, by inner joins that drop cold rows
    themselves: where the predictions are not asked for, no factors travel.  A model of another
    cold-start strategy keeps Spark ML's joins."""
    rows = to_als_input(test)
    if model.getOrDefault("coldStartStrategy") != "drop":
        return model.transform(rows)

    def side(factors, name, vec):
        return factors.where(~F.exists("features", F.isnan)).select(F.col("id").alias(name), F.col("features").alias(vec))

    dot = F.aggregate(F.zip_with("__u", "__i", lambda x, y: x * y), F.lit(0.0).cast("float"), lambda s, x: s + x)
    return (rows.join(side(model.userFactors, "userId", "__u"), "userId").join(side(model.itemFactors, "movieId", "__i"), "movieId")
                .select(*rows.columns, dot.alias("prediction")))


def predict_from_factors(pairs: DataFrame, user_factors: DataFrame, item_factors: DataFrame) -> DataFrame:
    """pairs (userId, movieId, ..) with ``prediction``, the dot product of given factors (id, features).

    The joins drop cold rows: pairs of a user or a movie without factors.  All in the JVM;
    factors travel once per side, and a hot user's or movie's pairs are split by AQE."""
    def side(factors, name, vec):
        return factors.select(F.col("id").cast("long").alias(name), F.col("features").cast("array<double>").alias(vec)).where(
            F.col(vec).isNotNull())

    dot = F.aggregate(F.zip_with("__u", "__i", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    keyed = pairs.withColumn("__user", F.col("userId").cast("long")).withColumn("__item", F.col("movieId").cast("long"))
    return (keyed.join(side(user_factors, "__user", "__u"), "__user").join(side(item_factors, "__item", "__i"), "__item")
                 .select(*pairs.columns, dot.alias("prediction")))


def evaluate_rmse(predictions: DataFrame) -> DataFrame:
    """One row: rmse (8 decimals), scored.

    The distributed sum's order varies the 15th digit between runs; rounding
    at 8 decimals keeps the reported value repeatable.
    """
    err = F.col("rating") - F.col("prediction").cast("double")
    return predictions.agg(round_half_up(F.sqrt(F.avg(err * err)), 8).alias("rmse"),
                           F.count(F.lit(1)).alias("scored"))


def als_metrics(model: ALSModel, train: DataFrame, test: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """One row: rmse, train_n, test_n (the evaluation chart's series).

    ``sizes`` (train, n: ``split_summary``) saves counting the two sides one by one."""
    return split_metrics(predict(model, test), train, test, sizes)


def split_metrics(predictions: DataFrame, train: DataFrame, test: DataFrame, sizes: DataFrame | None = None) -> DataFrame:
    """``als_metrics`` of predictions that are already there, by a model or from given factors."""
    counts = [train.agg(F.count(F.lit(1)).alias("train_n")), test.agg(F.count(F.lit(1)).alias("test_n"))]
    if sizes is not None:
        side = lambda train: F.coalesce(F.sum(F.when(F.col("train") == train, F.col("n"))), F.lit(0))
        counts = [sizes.agg(side(True).alias("train_n"), side(False).alias("test_n"))]
    parts = [evaluate_rmse(predictions).select("rmse"), *counts]
    cols = ["rmse", "train_n", "test_n"]
    u = None
    for p in parts:
        p = p.select(*[(F.col(c) if c in p.columns else F.lit(None)).alias(c) for c in cols])
        u = p if u is None else u.unionByName(p)
    return u.agg(F.max("rmse").alias("rmse"), F.sum("train_n").alias("train_n"),
                 F.sum("test_n").alias("test_n"))


def als_grid(train: DataFrame, test: DataFrame, reg_params=(0.01, 0.1, 1.0), fitted: dict | None = None,
             parallelism: int = 3, **fit_args) -> DataFrame:
    """reg_param, rmse - one fit per value, up to ``parallelism`` of them side by side.

    One ALS fit leaves most of a cluster idle (``num_blocks`` tasks in each half-step), so fits are
    submitted from threads of their own over one written copy of the training side; values and
    RMSEs are those of fits one by one.  The fits run when this is called, the evaluations with
    the result.  ``fitted`` maps values to models that are already there (same other arguments)."""
    spark, models = train.sparkSession, dict(fitted or {})
    todo = [rp for rp in reg_params if rp not in models]
    if len(todo) > 1:
        folder = shared_dir(spark, f"grid/{uuid.uuid4().hex}")
        to_als_input(train).write.parquet(folder)
        train = spark.read.parquet(folder)
    if todo:
        fit = inheritable_thread_target(lambda rp: fit_als(train, reg_param=rp, **fit_args))
        with ThreadPoolExecutor(max(1, min(parallelism, len(todo)))) as pool:
            models |= zip(todo, pool.map(fit, todo))
    rows = [evaluate_rmse(predict(models[rp], test)).select(F.lit(float(rp)).alias("reg_param"), "rmse") for rp in reg_params]
    return functools.reduce(DataFrame.unionByName, rows)


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def save_factors(user_factors: DataFrame, item_factors: DataFrame, base: str) -> str:
    """Write both sides (id, features) as a new version under ``base`` and publish it; its folder.

    Readers see the old model or the new one, never half of either, whenever a writer dies."""
    def write(folder: str) -> None:
        for name, factors in (("users", user_factors), ("items", item_factors)):
            factors.select(F.col("id").cast("long").alias("id"), "features").write.parquet(f"{folder}/{name}")
    return versions.write_version(user_factors.sparkSession, base, write)


def load_factors(spark, base: str) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) of the published version."""
    folder = versions.current(spark, base)
    if folder is None:
        raise ValueError(f"no model at {base}")
    return spark.read.parquet(f"{folder}/users"), spark.read.parquet(f"{folder}/items")


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)


# ---------------------------------------------------------------- recommendations

def _first_ids(factors: DataFrame, n: int, name: str) -> DataFrame:
    return factors.select(F.col("id").alias(name)).orderBy(name).limit(n)


def _subset(factors: DataFrame, which, name: str) -> DataFrame:
    """Factor rows of the chosen ids: all (None), the n lowest ids (int), or a DataFrame."""
    if which is None:
        return factors
    ids = _first_ids(factors, which, "id") if isinstance(which, int) else \
        which.select(F.col(name).alias("id"))
    return factors.join(ids.distinct(), "id", "left_semi")


def titled_recs(top: DataFrame, movies: DataFrame) -> DataFrame:
    """Top-k rows (i, j, score, rank) of users and movies with the movie's title."""
    return (top.join(movies.select(F.col("movieId").cast("long").alias("j"), "title"), "j")
               .select(F.col("i").cast("int").alias("userId"), "rank", F.col("j").cast("int").alias("movieId"),
                       "title", round_half_up("score", 2).alias("predictedRating")))


def named_users(top: DataFrame) -> DataFrame:
    """Top-k rows (i, j, score, rank) of movies and users."""
    return top.select(F.col("i").cast("int").alias("movieId"), "rank", F.col("j").cast("int").alias("userId"),
                      round_half_up("score", 2).alias("predictedRating"))


def titled_pairs(top: DataFrame, movies: DataFrame) -> DataFrame:
    """Top-k rows (i, j, score, rank) of movies with both titles."""
    titles = movies.select("movieId", "title")
    return (top.join(titles.select(F.col("movieId").cast("long").alias("i"), F.col("title").alias("origTitle")), "i")
               .join(titles.select(F.col("movieId").cast("long").alias("j"), F.col("title").alias("similarTitle")), "j")
               .select(F.col("i").cast("int").alias("origMovieId"), "origTitle", "rank",
                       F.col("j").cast("int").alias("similarMovieId"), "similarTitle",
                       round_half_up("score", 2).alias("similarityScore")))


def user_recs(model: ALSModel, movies: DataFrame, k: int = 5, users=None,
              block_rows: int = BLOCK_ROWS) -> DataFrame:
    """userId, rank, movieId, title, predictedRating - top-k movies per user.

    Score = dot product of the user's and the movie's factors (the ALS
    prediction, in float32 like the factors), by the blocked top-k operator.
    ``users``: None for every user, an int n for the n lowest user ids, or a
    DataFrame with ``userId``; subsets are scored alone and come sorted
    (user, rank).  The all-users result is not globally sorted (``rank``
    carries the order); movies missing from the catalogue drop out (inner
    join for the title).
    """
    top = pruned_dot_top_k(_subset(model.userFactors, users, "userId"), model.itemFactors, k,
                           block_rows=block_rows, precise=False)
    out = titled_recs(top, movies)
    return out if users is None else out.orderBy("userId", "rank")


def item_users(model: ALSModel, k: int = 5, items=None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """movieId, rank, userId, predictedRating - the k users predicted to rate each movie highest."""
    top = pruned_dot_top_k(_subset(model.itemFactors, items, "movieId"), model.userFactors, k,
                           block_rows=block_rows, precise=False)
    out = named_users(top)
    return out if items is None else out.orderBy("movieId", "rank")


def similar_items(model: ALSModel, movies: DataFrame, k: int = 5, items=None,
                  block_rows: int = BLOCK_ROWS) -> DataFrame:
    """origMovieId, origTitle, rank, similarMovieId, similarTitle, similarityScore.

    Cosine of the learned item factors, self excluded, top k per movie
    (ties to the lower id).  Subsets come sorted by (origTitle, rank).
    """
    queries = None
    if items is not None:
        queries = _subset(model.itemFactors, items, "movieId").select("id")
    top = cosine_top_k(model.itemFactors, k, queries=queries, block_rows=block_rows)
    out = titled_pairs(top, movies)
    return out if items is None else out.orderBy("origTitle", "origMovieId", "rank")


# ---------------------------------------------------------------- nested form

def recommendation_arrays(flat: DataFrame, key: str, other: str, score: str = "predictedRating") -> DataFrame:
    """key, recommendations: array<struct<other:int, rating:float>> (best first).

    The nested table shape of Spark ML's ``recommendForAll*``; each array
    holds the k rows of one entity (bounded by k).
    """
    rec = F.struct(F.col(other).cast("int").alias(other), F.col(score).cast("float").alias("rating"))
    ranked = F.array_sort(F.collect_list(F.struct(F.col("rank").alias("rank"), rec.alias("rec"))))
    return (flat.groupBy(key)
                .agg(ranked.alias("_r"))
                .select(key, F.transform("_r", lambda x: x["rec"]).alias("recommendations")))


def explode_recs(nested: DataFrame, key: str, other: str, score: str = "predictedRating") -> DataFrame:
    """key, rank, other, score - one row per element of a recommendations array."""
    return (nested.select(key, F.posexplode("recommendations").alias("pos", "rec"))
                  .select(key, (F.col("pos") + 1).alias("rank"), F.col("rec." + other).alias(other),
                          F.col("rec.rating").cast("double").alias(score)))

