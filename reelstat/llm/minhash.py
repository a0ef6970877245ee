"""MinHash near-duplicates with sequential Bayesian verification (BayesLSH).

A document is its set of word shingles.  Documents with equal sets form a class, and
one document of each class goes on.  Its MinHash signature is banded; documents that
share a band are candidates.  A candidate pair's signatures are compared batch by
batch: under a uniform prior of the similarity, the matches seen so far give a posterior,
and the pair is pruned as soon as the probability of reaching the threshold falls below
MISS.  Survivors are verified exactly on their full sets, and links are joined to
components.

Nothing emits all pairs of a bucket.  First every member of a bucket is compared with
the bucket's pivot (as many pairs as rows); the links found already join a large group of
near copies to one component.  Then, in buckets that still hold several components,
members of different components are compared, in block pairs of bounded size: first by
signatures, which leaves the members with a pair to verify, then these on their full sets,
likeliest pairs first, and only links that join components are emitted.  Pairs within a
component need no comparison, so the components are those of all candidate links.

With BANDS bands of ROWS rows a pair at the threshold s shares no band with probability
(1 - s**5)**24: 8e-7 at 0.85, 7e-5 at 0.8 (1.5e-5 at 0.82); MISS adds 1e-6.
"""

from __future__ import annotations

import functools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import CHUNK_BYTES, chunked, discard, id_bit, id_marks, is_marked, stored, text_of

BANDS, ROWS = 24, 5
#: Signature values compared at a time, and the miss probability of pruning.
BATCH, MISS = 24, 1e-6
#: Members of a bucket that one side of a block pair holds.
BLOCK_MEMBERS = 1024
#: Shingles of all sets that one side of a block pair holds.
BLOCK_SHINGLES = 4_000_000
#: Members of small buckets that one task call looks at.
TASK_MEMBERS = 2048
SEED = 20240229

_LOWER = re.compile("[A-Z]+")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


# ---- sets and signatures ---------------------------------------------------------------------

def shingle_set(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's shingles of so many words (fewer words:
    the whole sequence as one; none: empty)."""
    found = _WORD.findall(_LOWER.sub(lambda m: m[0].lower(), text))
    if len(found) <= words:
        parts = [" ".join(found)] if found else []
    else:
        parts = map(" ".join, zip(*(found[i:] for i in range(words))))
    return np.unique(np.fromiter((xxhash.xxh3_64_intdigest(p) for p in parts), np.uint64))


@functools.lru_cache(maxsize=1)
def _multipliers(size: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(SEED)
    return rng.integers(1, 1 << 63, size, np.uint64) | np.uint64(1), rng.integers(0, 1 << 63, size, np.uint64)


def signature(shingles: np.ndarray, size: int) -> np.ndarray:
    """The smallest of each of ``size`` multiply-shift hashes, 32 bits."""
    a, b = _multipliers(size)
    out = np.full(size, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(shingles), 4096):
        part = (shingles[at:at + 4096, None] * a + b) >> np.uint64(32)
        out = np.minimum(out, part.min(axis=0).astype(np.uint32))
    return out


def _signed(words: int):
    def run(batches):
        for _, t in chunked(batches, CHUNK_BYTES):
            count, same, sign = [], [], []
            for text in t.column("text").to_pylist():
                own = shingle_set(text, words)
                count.append(len(own))
                same.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                sign.append(signature(own, BANDS * ROWS).tobytes() if len(own) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": t.column("doc_id").combine_chunks(), "n_shingles": pa.array(count, pa.int64()),
                "same": pa.array(same, pa.binary()), "signature": pa.array(sign, pa.binary())})
    return run


def _sets(words: int, marked):
    """The sets of the texts whose bit is set in the broadcast bitmap."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").filter(is_marked(marked, batch.column("bit")))
            sets = [shingle_set(t, words).tobytes() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_pydict({"same": pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()),
                                              "shingles": pa.array(sets, pa.binary())})
    return run


def _marked(marked):
    """The rows whose bit is set in the broadcast bitmap, without the bit."""

    def run(batches):
        for batch in batches:
            yield batch.drop_columns(["bit"]).filter(is_marked(marked, batch.column("bit")))
    return run


# ---- Bayesian pruning and exact verification -------------------------------------------------

@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, size: int = BANDS * ROWS, batch: int = BATCH, miss: float = MISS) -> tuple[int, ...]:
    """After each batch of n compared values: the fewest matches m for which
    P(similarity >= threshold | m of n) >= miss, the posterior under a uniform prior."""
    s = (np.arange(20_000) + 0.5) / 20_000
    out = []
    for n in range(batch, size + 1, batch):
        for m in range(n + 1):
            log = m * np.log(s) + (n - m) * np.log1p(-s)
            like = np.exp(log - log.max())
            if like[s >= threshold].sum() / like.sum() >= miss:
                break
        out.append(m)
    return tuple(out)


def survives(left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which pairs of signatures (rows of both arrays) no batch prunes."""
    alive, matches = np.arange(len(left)), np.zeros(len(left), np.int64)
    for k, least in enumerate(least_matches(threshold)):
        part = slice(k * BATCH, (k + 1) * BATCH)
        matches = matches + (left[alive, part] == right[alive, part]).sum(axis=1)
        keep = matches >= least
        alive, matches = alive[keep], matches[keep]
    return alive


def _signatures(column) -> np.ndarray:
    values = column.to_pylist()
    return np.frombuffer(b"".join(values), np.uint32).reshape(len(values), BANDS * ROWS)


def _pruned(threshold: float):
    def run(batches):
        for batch in batches:
            alive = survives(_signatures(batch.column("left")), _signatures(batch.column("right")), threshold)
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").take(pa.array(alive)),
                                              "b": batch.column("b").take(pa.array(alive))})
    return run


def _alike(left: np.ndarray, right: np.ndarray, percent: int) -> bool:
    both = len(np.intersect1d(left, right, assume_unique=True))
    return 100 * both >= percent * (len(left) + len(right) - both)


def _verified(percent: int):
    def run(batches):
        for batch in batches:
            keep = [_alike(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                    for x, y in zip(batch.column("left"), batch.column("right"))]
            yield pa.RecordBatch.from_pydict({"a": batch.column("a").filter(pa.array(keep, pa.bool_())),
                                              "b": batch.column("b").filter(pa.array(keep, pa.bool_()))})
    return run


# ---- components ------------------------------------------------------------------------------

def components(edges: DataFrame) -> DataFrame:
    """(a, b) -> (id, component): the smallest id reachable, for every id of an edge.

    Every round joins each id's smallest neighbour label (hooking) and then the label of
    its label (jumping), so the rounds are about the logarithm of the longest chain.
    Each round is a written table."""
    both = stored(edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "minhash-edges")
    labels = stored(both.groupBy(F.col("a").alias("id")).agg(F.min(F.least("a", "b")).alias("component")), "minhash-labels")
    while True:
        near = both.join(labels.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("component").alias("near"))
        # an id takes the smallest label around it, and tells its old label of it
        told = labels.join(near.withColumnRenamed("a", "id"), "id").groupBy("component").agg(F.min("near").alias("told"))
        best = labels.join(told, "component").join(near.withColumnRenamed("a", "id"), "id").select(
            "id", F.col("component").alias("old"), F.least("component", "near", "told").alias("best"))
        root = labels.select(F.col("id").alias("best"), F.col("component").alias("jump"))
        new = stored(best.join(root, "best", "left").select(
            "id", "old", F.least("best", F.coalesce("jump", F.col("best"))).alias("component")), "minhash-labels")
        labels = new.select("id", "component")
        if not new.where("component <> old").limit(1).count():
            return labels


# ---- candidates ------------------------------------------------------------------------------

def _band_key(values: np.ndarray, band: int) -> int:
    return xxhash.xxh3_64_intdigest(values.tobytes(), seed=band) >> 1


def _bands(batches):
    for batch in batches:
        sign = _signatures(batch.column("signature"))
        n = len(sign)
        keys = np.empty((n, BANDS), np.int64)
        for band in range(BANDS):
            part = np.ascontiguousarray(sign[:, band * ROWS:(band + 1) * ROWS])
            keys[:, band] = [_band_key(r, band) for r in part]
        yield pa.RecordBatch.from_pydict({"id": np.repeat(batch.column("id").to_numpy(), BANDS), "key": keys.reshape(-1)})


def _segments(t: pa.Table, threshold: float):
    """Buckets, or block pairs of one -> (rows a, rows b, matching signature values) of the
    pairs of different components that no batch prunes.  A pair is looked at only in
    the first band that it shares."""
    ids, of, side, keys = (t.column(c).to_numpy() for c in ("id", "component", "side", "key"))
    sign = _signatures(t.column("signature"))
    bands = sign.reshape(len(sign), BANDS, ROWS)
    for at in np.split(np.arange(len(keys)), np.flatnonzero(np.diff(keys)) + 1):
        own = next(b for b in range(BANDS) if _band_key(bands[at[0], b], b) == keys[at[0]])
        first, second, found = at[side[at] != 1], at[side[at] != 0], []
        for i in first:
            others = second[(of[second] != of[i]) & ((side[i] != 2) | (ids[second] > ids[i]))]
            if own and len(others):
                others = others[~(bands[others, :own] == bands[i, :own]).all(axis=2).any(axis=1)]
            if len(others):
                others = others[survives(np.broadcast_to(sign[i], (len(others), sign.shape[1])), sign[others], threshold)]
                found.append(np.stack([np.full(len(others), i), others, (sign[others] == sign[i]).sum(axis=1)]))
        if found:
            yield np.concatenate(found, axis=1)


def _doubtful(threshold: float):
    """The members that have a pair to verify."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        rows = [np.unique(p[:2]) for p in _segments(t, threshold)]
        return t.take(pa.array(np.concatenate(rows) if rows else np.zeros(0, np.int64))).select(["deal", "x", "y", "key", "id"])
    return run


def _forest(threshold: float, percent: int):
    """Verify a block's pairs on full sets, the likeliest first, and emit links that join
    components only: fewer than members, however many pairs there are."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        ids, of = t.column("id").to_pylist(), t.column("component").to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in t.column("shingles")]
        up: dict[int, int] = {}

        def root(x: int) -> int:
            while up.get(x, x) != x:
                up[x] = x = up.get(up[x], up[x])
            return x

        links = []
        for pairs in _segments(t, threshold):
            for i, j, _ in pairs[:, np.argsort(-pairs[2], kind="stable")].T.tolist():
                x, y = root(of[i]), root(of[j])
                if x != y and _alike(sets[i], sets[j], percent):
                    up[max(x, y)] = min(x, y)
                    links.append((ids[i], ids[j]))
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def _blocks(members: DataFrame) -> DataFrame:
    """members: (key, id, component, shingle_count) of the open buckets.  A bucket is cut into
    blocks of bounded members and bounded total set size, and a member is sent once to
    each pair of blocks that its block is in; small buckets share a task call."""
    sizes = stored(members.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("shingle_count").alias("load")),
                   "minhash-sizes").withColumn("blocks", F.greatest(
                       F.ceil(F.col("size") / F.lit(BLOCK_MEMBERS)), F.ceil(F.col("load") / F.lit(BLOCK_SHINGLES))))
    size, load = sizes.agg(F.sum("size"), F.sum("load")).first()
    calls = max(1, -(-(size or 0) // TASK_MEMBERS), -(-(load or 0) // BLOCK_SHINGLES))
    dealt = members.join(sizes.drop("size", "load"), "key").withColumn(
        "block", F.pmod(F.xxhash64("id"), F.col("blocks"))).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.select(
        "key", "id", "component", F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
        F.when(F.col("blocks") == 1, F.pmod(F.col("key"), F.lit(calls))).otherwise(F.col("key")).alias("deal"),
        F.when(F.col("block") == F.col("other"), 2).when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5,
                    percent: int = 85) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id
    reachable over links, itself included) and kept (doc_id = component_id).

    Linked are documents whose sets of distinct ``words``-word shingles (ASCII letters
    lower-cased) have 100 * intersection >= ``percent`` * union.  Null or empty text has
    the empty set and no links.  A null doc_id has no links: component null, kept.  Rows
    that repeat a doc_id count as documents of their own and get a row each.  An empty
    table gives an empty result; other columns are not read.
    """
    threshold = percent / 100
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    signed = stored(rows.mapInArrow(_signed(words), "doc_id long, n_shingles long, same binary, signature binary"),
                    "minhash-signed")
    # equal sets are one class; its number is its place in the table, its document the smallest
    classes = stored(signed.where("doc_id IS NOT NULL AND same IS NOT NULL").groupBy("same").agg(
        F.min(F.struct("doc_id", "signature", "n_shingles")).alias("of")).select(
        F.monotonically_increasing_id().alias("id"), "same", F.col("of.doc_id").alias("first"), F.col("of.signature").alias("signature"),
        F.col("of.n_shingles").alias("shingle_count")), "minhash-classes")
    signs = classes.select("id", "signature")

    bands = stored(signs.mapInArrow(_bands, "id long, key long"), "minhash-bands")
    sizes = stored(bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "minhash-buckets")
    shared = stored(bands.join(sizes, "key"), "minhash-shared")
    # the pivot of a bucket is the member that meets most others over all bands: of a
    # text and its variants mostly the text, which is linked where two variants are not
    weight = stored(shared.groupBy("id").agg(F.sum("members").alias("weight")), "minhash-weights")
    # only signatures of documents that share a bucket travel (a bounded bitmap, as for texts)
    marked, bits = id_marks(weight, "id")
    signs = stored(signs.withColumn("bit", id_bit("id", bits)).mapInArrow(_marked(marked), "id long, signature binary"),
                   "minhash-candidates")
    # what no later step reads goes: bands, and the tables that hold all signatures
    signed, whole = stored(signed.drop("signature"), "minhash-documents"), signed
    classes, numbered = stored(classes.drop("signature"), "minhash-numbered"), classes
    discard(bands, sizes, whole, numbered)
    pivots = stored(shared.select("key", "id").join(weight, "id").groupBy("key").agg(
        F.max(F.struct("weight", "id"))["id"].alias("pivot")), "minhash-pivots")
    stars = shared.select("key", "id").join(pivots, "key").where("id <> pivot").select(
        F.col("pivot").alias("a"), F.col("id").alias("b")).distinct()

    def pruned(pairs: DataFrame) -> DataFrame:
        left = signs.select(F.col("id").alias("a"), F.col("signature").alias("left"))
        right = signs.select(F.col("id").alias("b"), F.col("signature").alias("right"))
        return pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
            _pruned(threshold), "a long, b long")

    def sets_of(ids: DataFrame) -> DataFrame:
        """The full sets of some classes, taken again from the texts of their documents."""
        wanted = stored(ids.distinct().join(classes.select("id", "same", "first"), "id"), "minhash-wanted")
        # a bounded bitmap of the documents leaves most texts where they are; the join on
        # the set's digest is exact
        marked, bits = id_marks(wanted, "first")
        found = rows.select(id_bit("doc_id", bits).alias("bit"), "text").mapInArrow(
            _sets(words, marked), "same binary, shingles binary")
        return stored(found.join(wanted.select("id", "same"), "same").dropDuplicates(["id"]).select("id", "shingles"),
                      "minhash-sets")

    pairs = stored(pruned(stars), "minhash-pairs")
    sets = sets_of(pairs.select(F.col("a").alias("id")).union(pairs.select("b")))
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("right"))
    links = stored(pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(
        _verified(percent), "a long, b long"), "minhash-links")
    labels = components(links)

    # buckets that still hold several components: compare across them
    labelled = stored(shared.select("key", "id").join(labels, "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("component")), "minhash-labelled")
    open_keys = stored(labelled.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
                       .where("x < y").select("key"), "minhash-open")
    blocks = stored(_blocks(labelled.join(open_keys, "key").join(classes.select("id", "shingle_count"), "id")),
                    "minhash-blocks")
    doubtful = stored(blocks.join(signs, "id").groupBy("deal", "x", "y").applyInArrow(
        _doubtful(threshold), "deal long, x long, y long, key long, id long"), "minhash-doubtful")
    if doubtful.limit(1).count():
        full = blocks.join(doubtful, ["deal", "x", "y", "key", "id"], "left_semi").join(signs, "id").join(
            sets_of(doubtful.select("id")), "id")
        more = stored(full.groupBy("deal", "x", "y").applyInArrow(_forest(threshold, percent), "a long, b long"), "minhash-links")
        labels = components(links.unionByName(more))

    of = classes.select("id", "same", "first").join(labels, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    smallest = stored(of.groupBy("component").agg(F.min("first").alias("component_id")), "minhash-smallest")
    named = stored(of.join(smallest, "component").select("same", "component_id"), "minhash-named")
    return signed.select("doc_id", "n_shingles", "same").join(named, "same", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
