"""ALS half-steps from split normal equations.

Spark ML solves a user's least-squares problem in the one task that holds all of the user's
ratings.  Here a problem is a sum: A = sum of x x', b = sum of r x over the user's ratings, x the
rated item's factors.  A user's ratings are cut into parts of bounded size, each part gives a
partial A and b, and partials are added before the solve.  A user with a third of all ratings
is thus many tasks of the same size as any other, and only partials (rank * (rank + 1) / 2 + rank
numbers each) meet in one.

The regularisation is the weighted one that Spark ML uses: reg_param times the number of ratings.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.functions import hash_bucket
from reelstat.operators.topk_kernel import matrix
from reelstat.session import ensure_checkpoint_dir

#: Ratings of one part, and about the ratings and the problems of one task call.
PART_ROWS, TASK_PROBLEMS = 65_536, 4096
SWEEPS, TOLERANCE = 2000, 1e-12


def _sums(table: pa.Table) -> pa.Table:
    """Rows (id, v, rating) of some problems' parts -> their partial sums."""
    order = np.argsort(table.column("id").to_numpy(), kind="stable")
    ids, x = table.column("id").to_numpy()[order], matrix(table.column("v"))[order]
    r = table.column("rating").to_numpy()[order]
    cuts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
    upper = np.triu_indices(x.shape[1])
    spans = list(zip(cuts, [*cuts[1:], len(ids)]))
    return _partials(ids[cuts], [b - a for a, b in spans], np.stack([(x[a:b].T @ x[a:b])[upper] for a, b in spans]),
                     np.stack([r[a:b] @ x[a:b] for a, b in spans]))


def _partials(ids, n, gram, rhs) -> pa.Table:
    def lists(m):
        return pa.ListArray.from_arrays(np.arange(0, m.size + 1, m.shape[1], dtype=np.int32), pa.array(m.reshape(-1), pa.float64()))
    return pa.table({"id": pa.array(ids, pa.int64()), "n": pa.array(n, pa.int64()), "gram": lists(gram), "rhs": lists(rhs)})


def _added(table: pa.Table) -> pa.Table:
    ids, at = np.unique(table.column("id").to_numpy(), return_inverse=True)
    out = []
    for name in ("gram", "rhs"):
        m = matrix(table.column(name))
        total = np.zeros((len(ids), m.shape[1]))
        np.add.at(total, at, m)
        out.append(total)
    n = np.zeros(len(ids), np.int64)
    np.add.at(n, at, table.column("n").to_numpy())
    return _partials(ids, n, *out)


_SCHEMA = "id long, n long, gram array<double>, rhs array<double>"


def partial_equations(ratings: DataFrame, factors: DataFrame, by: str = "userId", other: str = "movieId",
                      part_rows: int = PART_ROWS) -> DataFrame:
    """id, n, gram (upper triangle by rows), rhs - a row for every part of every ``by`` id.

    ``factors``: (id, features) of the other side; ratings of ids without factors are left out,
    as are null ids and ratings.  Parts hold about ``part_rows`` ratings.  Only ids of more than
    one part are counted on (at most ratings / part_rows); one sizing job runs here."""
    rows = ratings.select(F.col(by).cast("long").alias("id"), F.col(other).cast("long").alias("other"),
                          F.col("rating").cast("double").alias("rating")).where("id IS NOT NULL AND rating IS NOT NULL")
    n = rows.count()
    large = rows.groupBy("id").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > part_rows).select(
        "id", F.ceil(F.col("rows") / part_rows).alias("parts"))
    part = F.pmod(F.xxhash64("other"), F.coalesce("parts", F.lit(1).cast("long")))
    dealt = rows.join(large, "id", "left").withColumn("deal", F.pmod(F.xxhash64("id", part), F.lit(max(1, math.ceil(n / part_rows)))))
    given = factors.select(F.col("id").cast("long").alias("other"), F.col("features").cast("array<double>").alias("v")).where(
        "v IS NOT NULL")
    return dealt.join(given, "other").groupBy("deal").applyInArrow(_sums, _SCHEMA)


def normal_equations(ratings: DataFrame, factors: DataFrame, by: str = "userId", other: str = "movieId",
                     part_rows: int = PART_ROWS) -> DataFrame:
    """id, n, gram (upper triangle by rows), rhs of every ``by`` id: the partials added up."""
    ids = ratings.select(F.approx_count_distinct(by)).first()[0] or 0
    deal = F.pmod(F.xxhash64("id"), F.lit(max(1, math.ceil(ids / TASK_PROBLEMS))))
    return partial_equations(ratings, factors, by, other, part_rows).withColumn("deal", deal).groupBy("deal").applyInArrow(
        _added, _SCHEMA)


def nonnegative_solution(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Many small problems min x'Ax / 2 - b'x, x >= 0 at once, by coordinate descent."""
    x = np.zeros_like(b)
    diagonal = np.maximum(np.einsum("nii->ni", a), 1e-300)
    scale = np.abs(b).max(axis=1) / diagonal.max(axis=1) + 1e-300
    for _ in range(SWEEPS):
        moved = np.zeros(len(b))
        for j in range(b.shape[1]):
            new = np.maximum(0.0, x[:, j] - (np.einsum("ni,ni->n", a[:, j], x) - b[:, j]) / diagonal[:, j])
            moved = np.maximum(moved, np.abs(new - x[:, j]))
            x[:, j] = new
        if (moved <= TOLERANCE * scale).all():
            break
    return x


def _solved(reg_param: float, nonnegative: bool):
    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            rhs, gram, n = matrix(batch.column("rhs")), matrix(batch.column("gram")), batch.column("n").to_numpy()
            rank = rhs.shape[1]
            a = np.zeros((len(n), rank, rank))
            i, j = np.triu_indices(rank)
            a[:, i, j] = gram
            a[:, j, i] = gram
            a[:, np.arange(rank), np.arange(rank)] += reg_param * n[:, None]
            x = nonnegative_solution(a, rhs) if nonnegative else np.linalg.solve(a, rhs[:, :, None])[:, :, 0]
            yield pa.RecordBatch.from_pydict({"id": batch.column("id"), "features": pa.ListArray.from_arrays(
                np.arange(0, x.size + 1, rank, dtype=np.int32), pa.array(x.reshape(-1), pa.float64()))})
    return run


def half_step(ratings: DataFrame, factors: DataFrame, reg_param: float = 0.1, nonnegative: bool = True,
              by: str = "userId", other: str = "movieId", part_rows: int = PART_ROWS) -> DataFrame:
    """id, features of the ``by`` side that fit the ratings best, given the other side's factors.

    ``reg_param`` over 0 keeps every problem solvable.  An empty input gives an empty result."""
    return normal_equations(ratings, factors, by, other, part_rows).mapInArrow(
        _solved(reg_param, nonnegative), "id long, features array<double>")


def start_factors(ids: DataFrame, rank: int, seed: int = 42) -> DataFrame:
    """id, features: unit vectors from the key hash of (id, dimension), no component negative."""
    raw = F.transform(F.sequence(F.lit(0), F.lit(rank - 1)), lambda d: hash_bucket(["id", d], seed, 1 << 20) + 1.0)
    size = F.sqrt(F.aggregate("raw", F.lit(0.0), lambda s, x: s + x * x))
    return ids.withColumn("raw", raw).select("id", F.transform("raw", lambda x: x / size).alias("features"))


def fit(train: DataFrame, rank: int = 20, max_iter: int = 10, reg_param: float = 0.1, nonnegative: bool = True,
        seed: int = 42, part_rows: int = PART_ROWS) -> tuple[DataFrame, DataFrame]:
    """(user factors, item factors) by alternating half-steps, each written as a checkpoint.

    The start depends on ids and seed alone, so neither the ratings' order nor the cluster moves
    the model beyond the last digits of sums."""
    ensure_checkpoint_dir(train.sparkSession)
    items = start_factors(train.select(F.col("movieId").cast("long").alias("id")).where("id IS NOT NULL").distinct(), rank, seed)
    users = None
    for _ in range(max_iter):
        users = half_step(train, items, reg_param, nonnegative, part_rows=part_rows).checkpoint()
        items = half_step(train, users, reg_param, nonnegative, "movieId", "userId", part_rows).checkpoint()
    return users, items
