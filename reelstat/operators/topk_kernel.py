"""Per-task kernel of the blocked top-k operator: NumPy and Arrow only.

Kept free of Spark imports so Python workers load it quickly.
"""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

TILE_ROWS, TILE_COLS = 1024, 512    # scores held at once per task: 2 MiB of float32, which stays in a core's cache
HELD = 64               # candidates of a row (on average) that are held before they are cut to the k best


def unit(m: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norm, out=np.zeros_like(m), where=norm > 0)


def matrix(lists: pa.ChunkedArray, dtype=np.float64) -> np.ndarray:
    """An Arrow list column of equal-length vectors as an (n, d) array.

    The list values are one contiguous buffer, reshaped without a per-row loop.
    """
    arr = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = len(arr)
    if n == 0:
        return np.zeros((0, 0), dtype)
    offsets = arr.offsets.to_numpy()
    d = int(offsets[1] - offsets[0])
    if not (np.diff(offsets) == d).all():
        raise ValueError("all vectors must have the same length")
    flat = arr.values.slice(offsets[0], n * d).to_numpy(zero_copy_only=False)
    # missing or NaN components count as 0 so every score is finite
    return np.nan_to_num(flat.astype(dtype, copy=False)).reshape(n, d)


def _first(rows: np.ndarray, ids: np.ndarray, vals: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the k best values of every row (ties to the lower id), in order, and their ranks."""
    order = np.lexsort((ids, -vals, rows))
    rows = rows[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") + 1
    keep = rank <= k
    return order[keep], rank[keep]


def best(lid: np.ndarray, lmat: np.ndarray, rid: np.ndarray, rmat: np.ndarray, k: int,
          exclude_self: bool = True, least: np.ndarray | None = None):
    """For each left row, the k right rows of highest score (then lowest id).

    Scores are made in tiles of float32, and a row keeps what reaches its k-th best so far.  Right
    rows come by falling norm, so that a row is done once norms rule the rest out (a score is at
    most the product of both norms).  Float64 vectors are scored again in float64 where float32,
    less its largest error, does not rule a pair out: the result is that of float64.  ``least``:
    scores of each left row below which nothing is asked for."""
    m = len(rid)
    if len(lid) == 0 or m == 0:
        return
    lnorm, rnorm = (np.sqrt(np.einsum("ij,ij->i", x, x, dtype=np.float64)) for x in (lmat, rmat))
    exact = lmat.dtype == np.float64
    tiles = np.float32 if not exact or max(lnorm.max(), rnorm.max()) < 1e15 else np.float64     # what float32 holds
    nothing = -np.finfo(tiles).max                      # a row's own id scores less
    mixed = np.random.default_rng(0).permutation(m)     # no order of ids may make candidates of everything
    mixed = mixed[np.argsort(-rnorm[mixed], kind="stable")]
    rid, rmat, rnorm = rid[mixed], rmat[mixed], rnorm[mixed]
    by_id = np.argsort(rid, kind="stable")
    sorted_id = rid[by_id]
    right = np.ascontiguousarray(rmat.T.astype(tiles, copy=False))
    slack = (lmat.shape[1] + 8) * 2.0 ** -22            # largest error of a score in float32, a part of the norms
    error = np.nan_to_num(slack * lnorm * rnorm[0], nan=np.inf, posinf=np.inf) + 1e-24 if exact else np.zeros(len(lid))
    reach = lnorm * (1 + slack)
    first_cols = min(m, max(TILE_COLS, 4 * k))
    buffer = np.empty(min(TILE_ROWS, len(lid)) * first_cols, tiles)
    for s in range(0, len(lid), TILE_ROWS):
        li, lm, err, far = (x[s:s + TILE_ROWS] for x in (lid, lmat, error, reach))
        left, n = lm.astype(tiles, copy=False), len(li)
        own = np.full(n, -1)
        if exclude_self:                                # a row's own id is no partner
            at = np.minimum(np.searchsorted(sorted_id, li), m - 1)
            own = np.where(sorted_id[at] == li, by_id[at], -1)
        floor = np.full(n, -np.inf) if least is None else least[s:s + TILE_ROWS].copy()
        rows, cols, vals = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        rank, found, held, done, cut = rows, [], 0, 0, 0
        active, part, bounds = np.arange(n), left, floor - err
        while done < m and len(active):
            to = min(m, done + TILE_COLS) if done else first_cols
            width = to - done
            score = buffer[:len(active) * width].reshape(len(active), width)
            np.matmul(part, right[:, done:to], out=score)
            hit = np.flatnonzero((own[active] >= done) & (own[active] < to))
            score[hit, own[active][hit] - done] = -np.inf
            bound = bounds[active]
            if not done and width > k:                  # at most one score of a row is -inf
                bound = np.maximum(bound, np.partition(score, width - k, axis=1)[:, width - k] - 2 * err[active])
            bound = np.maximum(np.nextafter(np.maximum(bound, nothing).astype(tiles), tiles(-np.inf)), nothing)
            hot = np.flatnonzero(np.maximum.reduce(score, axis=1) >= bound)
            score = score[hot]
            flat = np.flatnonzero(score >= bound[hot, None])
            r, c = np.divmod(flat, width)
            found.append((active[hot[r]], c + done, score.reshape(-1)[flat]))
            held += len(flat)
            done = to
            if done >= m or done >= cut or done % (16 * TILE_COLS) == 0 or held > max(HELD, 4 * k) * n:
                if exact:
                    found = [(r, c, np.einsum("ij,ij->i", lm[r], rmat[c])) for r, c, _ in found]
                rows, cols, vals = (np.concatenate(x) for x in zip((rows, cols, vals), *found))
                keep, rank = _first(rows, rid[cols], vals, k)
                rows, cols, vals = rows[keep], cols[keep], vals[keep]
                full = rank == k
                floor[rows[full]] = np.maximum(floor[rows[full]], vals[full])
                bounds, found, held, cut = floor - err, [], 0, done + done // 2
            if done < m and not found:                  # rows that the norms of what is left cannot reach are done
                active = np.flatnonzero(~(far * rnorm[done] + err < floor))
                part = left[active]
        yield li[rows], rid[cols], vals, rank


def pair_task(k: int, symmetric: bool, normalize: bool, exclude_self: bool, dtype):
    """The k best partners within a pair of blocks; a column ``least`` bounds the scores of left rows."""
    def run(key: tuple, table: pa.Table) -> pa.Table:
        pa_, pb_ = key[1].as_py(), key[2].as_py()
        role = table.column("role").to_numpy()
        ids = table.column("id").to_numpy()
        mat = matrix(table.column("v"), dtype)
        if normalize:
            mat = unit(mat)
        lsel = role == 0
        lid, lmat = ids[lsel], mat[lsel]
        least = pc.fill_null(table.column("least"), -np.inf).to_numpy()[lsel] if "least" in table.column_names else None
        if symmetric and pa_ == pb_:
            rid, rmat = lid, lmat
        else:
            rid, rmat = ids[~lsel], mat[~lsel]
        del mat, table
        parts = list(best(lid, lmat, rid, rmat, k, exclude_self, least))
        if symmetric and pa_ != pb_:
            parts += list(best(rid, rmat, lid, lmat, k, exclude_self))
        types = (np.int64, np.int64, np.float64, np.int32)
        cols = [np.concatenate(c).astype(t, copy=False) if parts else np.zeros(0, t)
                for c, t in zip(zip(*parts) if parts else ([],) * 4, types)]
        return pa.table({"i": pa.array(cols[0], pa.int64()), "j": pa.array(cols[1], pa.int64()),
                         "score": pa.array(cols[2], pa.float64()),
                         "rank": pa.array(cols[3], pa.int32())})
    return run


# ---- random-projection hash tables -----------------------------------------------------------

PLANE_STEPS = 1 << 20
HASH_BYTES = 8 << 20     # of vectors that a task holds to send them to their buckets


def planes(count: int, width: int, seed: int, prime: int, mult: int, keys: tuple) -> np.ndarray:
    """Projection vectors with components in [-1, 1): the key hash of (plane, dimension),
    so that every engine derives the same ones."""
    plane, dim = np.divmod(np.arange(count * width, dtype=np.int64), max(1, width))
    x = np.full(count * width, seed % prime, np.int64)
    for part in (plane, dim):
        x = x ^ part
        for key in keys:
            x = (x ^ key) % prime * mult % prime
    return ((x % PLANE_STEPS) / (PLANE_STEPS / 2) - 1.0).reshape(count, width)


def give_back() -> None:
    """Return freed memory to the system: workers share the executor's, and idle ones keep theirs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):          # not on every C library
        ctypes.CDLL(None).malloc_trim(0)


def hash_task(tables: int, bits: int, probes: int, seed: int, fixed: tuple):
    """Vectors -> (id, v, bucket, role): in every table the bucket of a vector (role 2 where it
    is asked for and searched, 1 where only searched) and, where it is asked for, the buckets
    whose code differs in one of the ``probes`` least certain bits (role 0).  A vector leaves as
    often as tables and probes say, so batches are cut to HASH_BYTES of what leaves."""

    def sliced(batches):
        for batch in batches:
            out = tables * (1 + min(probes, bits)) * batch.column("v").nbytes
            rows = max(1, HASH_BYTES * batch.num_rows // max(1, out))
            for at in range(0, batch.num_rows, rows):
                yield batch.slice(at, rows)
        give_back()

    def run(batches):
        for batch in sliced(batches):
            ids, ask = batch.column("id"), batch.column("ask").to_numpy(zero_copy_only=False).astype(bool)
            mat = matrix(batch.column("v"))
            n = len(mat)
            if not n:
                continue
            cuts = mat @ planes(tables * bits, mat.shape[1], seed, *fixed).T
            cuts = cuts.reshape(n, tables, bits)
            code = ((cuts >= 0) << np.arange(bits)).sum(axis=2)
            base = np.arange(tables, dtype=np.int64) << bits
            row, bucket = [np.repeat(np.arange(n), tables)], [(base + code).reshape(-1)]
            role = [np.where(ask, 2, 1).repeat(tables)]
            asked = np.flatnonzero(ask)
            unsure = np.argsort(np.abs(cuts[asked]), axis=2, kind="stable")[:, :, :probes]
            if len(asked) and unsure.shape[2]:
                other = base[None, :, None] + (code[asked][:, :, None] ^ (1 << unsure))
                row.append(np.repeat(asked, other[0].size))
                bucket.append(other.reshape(-1))
                role.append(np.zeros(other.size, np.int64))
            row = np.concatenate(row)
            yield pa.RecordBatch.from_pydict({
                "id": ids.take(pa.array(row)), "v": batch.column("v").take(pa.array(row)),
                "bucket": pa.array(np.concatenate(bucket), pa.int64()),
                "role": pa.array(np.concatenate(role).astype(np.int32), pa.int32())})
    return run


def bucket_task(k: int, normalize: bool, dtype):
    """The k best searched vectors of a bucket for each vector that asks there."""

    def run(table: pa.Table) -> pa.Table:
        role, ids = table.column("role").to_numpy(), table.column("id").to_numpy()
        mat = matrix(table.column("v"), dtype)
        if normalize:
            mat = unit(mat)
        ask, have = role != 1, role != 0
        parts = list(best(ids[ask], mat[ask], ids[have], mat[have], k))
        i, j, score = (np.concatenate(c) if parts else np.zeros(0) for c in zip(*(p[:3] for p in parts))) if parts else \
            (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        del table, mat
        give_back()
        return pa.table({"i": pa.array(i, pa.int64()), "j": pa.array(j, pa.int64()), "score": pa.array(score, pa.float64())})
    return run
