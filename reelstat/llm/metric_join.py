"""Exact n-gram Jaccard join by recursive Voronoi regions of the Jaccard metric.

A document is its set of word shingles, equal sets are one class, and d(A, B) = 1 - |A & B| /
|A | B| is a metric.  With r the largest distance of a link:

1. *Shells.*  The empty set is the first pivot: by the triangle inequality linked sets differ
   little in size, so sizes are cut into shells, and a set near the upper edge of its shell is
   replicated into the next.
2. *Parts.*  Far from every pivot all distances are close to 1 and no window prunes; most
   documents of a corpus are so.  They are told apart exactly before: the shingle universe
   is cut by hash into more parts than a linked pair of the shell can have differing shingles,
   so linked sets agree in a whole part.  Sets that share no part with another have no link and
   go no further; the others fall into disjoint groups joined by shared parts.
3. *Regions.*  A group that outgrows a task gets pivots.  Every set goes to the Voronoi region of
   its nearest pivot, or to the far region if none is within FAR.  If x has a link into the
   region of a pivot p, then d(x, p) <= d(x, nearest) + 2r and d(x, p) <= FAR + r: a boundary
   document is replicated into the regions whose windows it is in.  Regions are joined the same
   way, level by level, until they fit a task, and each is joined exactly on full sets.  A
   region that pivots do not shrink is cut into blocks, and pairs of blocks are tasks.

Pairs are never listed: a task emits links that join components, fewer than members.  A mask
holds the levels at which a row is a replica; two replicas of a level meet elsewhere.

Every step is a written table.  Part keys are sums of mixed hashes, so a chance match adds
work, not links; sets are 64-bit shingle hashes.
"""

from __future__ import annotations

import functools
import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import CHUNK_BYTES, chunked, discard, id_bit, id_marks, is_marked, stored, text_of
from reelstat.llm.minhash import components

#: Sizes of a shell grow by this factor at least.
SHELL = 1.25
#: Parts of so few shingles are no keys while a set has enough others.
WEAK = 1
#: Share of sets with too many weak parts that the layout of a shell aims at.
MISFITS = 1e-4
#: Members and shingles of a region that one task joins.
MEMBERS, LOAD = 1024, 1_000_000
#: Pivots of a region, levels of regions, and the distance from which a set is far.
PIVOTS, LEVELS, FAR = 32, 6, 0.5
#: A region above this share of the one it comes from is not cut by pivots again.
SHRINK = 0.75

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, words: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a UTF-8 text's shingles of so many words (A-Z
    lower-cased; fewer words: the whole sequence as one; none: empty)."""
    found = _WORD.findall(text.lower())                 # of bytes only A-Z change
    if len(found) <= words:
        parts = [b" ".join(found)] if found else []
    else:
        parts = map(b" ".join, zip(*(found[i:] for i in range(words))))
    return np.unique(np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64))


# ---- shells and parts ------------------------------------------------------------------------

@functools.lru_cache(maxsize=8)
def shells(percent: int) -> tuple[int, ...]:
    """Lower bounds of the shells; below the first, different sets cannot be linked."""
    if percent >= 100:
        return (1 << 62,)
    out = [max(1, -(-percent // (100 - percent)))]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, math.ceil(out[-1] * max(SHELL, 100 / percent))))
    return tuple(out)


@functools.lru_cache(maxsize=1024)
def layout(shell: int, percent: int) -> tuple[int, int, int]:
    """(parts, slack, seeds): linked sets of a shell agree in more than ``slack`` of the parts
    under every seed.  The cheapest with at most MISFITS of sets with more weak parts than
    slack under all seeds; results do not depend on the choice."""
    low, top = max(1, shells(percent)[shell] * percent // 100), shells(percent)[shell + 1] - 1
    budget, best = 2 * top * (100 - percent) // (100 + percent), None
    for slack in range(4 + budget // 4):
        parts = budget + 1 + slack
        mean = low / parts
        weak = parts * math.exp(-mean) * (1 + mean)
        misfit = 1 - sum(math.exp(-weak + i * math.log(weak) - math.lgamma(i + 1)) for i in range(slack + 1))
        seeds = 1 if misfit <= MISFITS else min(4, math.ceil(math.log(MISFITS) / math.log(min(misfit, 0.9))))
        if best is None or parts * seeds < best[0]:
            best = parts * seeds, parts, slack, seeds
    return best[1:]


def part_keys(own: np.ndarray, percent: int) -> np.ndarray:
    """Keys of a set's parts: linked different sets share one.

    At most budget shingles differ, so more than ``slack`` parts agree under each seed.  If
    either set has at most ``slack`` weak parts (empty ones too) under some seed, a part that is
    not weak agrees and both have its key.  Else both give all parts of seed 0."""
    bounds = shells(percent)
    if len(own) < bounds[0]:
        return np.zeros(0, np.uint64)
    at = int(np.searchsorted(bounds, len(own), side="right")) - 1
    mixed = (own ^ (own >> np.uint64(31))) * _MIX
    keys = []
    for shell in (at, at + 1) if 100 * len(own) >= percent * bounds[at + 1] else (at,):
        parts, slack, seeds = layout(shell, percent)
        fits = False
        for seed in range(seeds):
            place = (((own ^ np.uint64(seed * 0x5851F42D4C957F2D & (1 << 64) - 1)) * _MIX) >> np.uint64(33)) % np.uint64(parts)
            size = np.bincount(place.astype(np.int64), minlength=parts)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, place.astype(np.int64), mixed)
            strong = size > WEAK
            fits |= parts - int(strong.sum()) <= slack
            name = np.arange(parts, dtype=np.uint64) * np.uint64(64) + np.uint64(seed * 8 + 1)
            all_keys = (total ^ (total >> np.uint64(29))) * _MIX + name * np.uint64(0xD6E8FEB86659FD93) + np.uint64(shell)
            if seed == 0:
                first, strong0 = all_keys, strong
            keys.append(all_keys[strong])
        if not fits:
            keys.append(first[~strong0])
    out = np.concatenate(keys)
    return out ^ (out >> np.uint64(32))


def _sketched(words: int, percent: int):
    def run(batches):
        for _, t in chunked(batches, CHUNK_BYTES):
            count, same, keys = [], [], []
            for text in t.column("text").cast(pa.binary()).to_pylist():
                own = shingle_set(text, words)
                count.append(len(own))
                same.append(xxhash.xxh3_128_digest(own.tobytes()) if len(own) else None)
                keys.append(part_keys(own, percent).tobytes())
            yield pa.RecordBatch.from_pydict({
                "doc_id": t.column("doc_id").combine_chunks(), "n_shingles": pa.array(count, pa.int64()),
                "same": pa.array(same, pa.binary()), "keys": pa.array(keys, pa.binary())})
    return run


def _exploded(marked=None, bits: int = 0):
    """(id, keys) -> (id, key), or only the keys whose bit is set in the broadcast bitmap."""

    def run(batches):
        for batch in batches:
            lists = [np.frombuffer(k, np.int64) for k in batch.column("keys").to_pylist()]
            ids = np.repeat(batch.column("id").to_numpy(), [len(x) for x in lists])
            out = pa.RecordBatch.from_pydict({"id": ids, "key": np.concatenate([*lists, np.zeros(0, np.int64)])})
            yield out if marked is None else out.filter(is_marked(marked, pa.array(out.column("key").to_numpy() & (bits - 1))))
    return run


def _key_bit(column: str, bits: int):
    """Keys are hashes: their low bits."""
    return F.col(column).bitwiseAND(F.lit(bits - 1))


# ---- full sets -------------------------------------------------------------------------------

def _sets(words: int, marked):
    """The sets of the texts whose bit is set in the broadcast bitmap."""

    def run(batches):
        for batch in batches:
            texts = batch.column("text").filter(is_marked(marked, batch.column("bit"))).cast(pa.binary())
            sets = [shingle_set(t, words).tobytes() for t in texts.to_pylist()]
            yield pa.RecordBatch.from_pydict({"same": pa.array([xxhash.xxh3_128_digest(x) for x in sets], pa.binary()),
                                              "shingles": pa.array(sets, pa.binary())})
    return run


def _full_sets(rows: DataFrame, wanted: DataFrame, words: int) -> DataFrame:
    """wanted: (id, same, first); (id, shingles), taken again from the texts.  A bitmap of
    hashed document ids leaves most other texts where they are; the join on the digest is exact."""
    marked, bits = id_marks(wanted, "first")
    found = rows.select(id_bit("doc_id", bits).alias("bit"), "text").mapInArrow(
        _sets(words, marked), "same binary, shingles binary")
    return stored(found.join(wanted.select("id", "same"), "same").dropDuplicates(["id"]).select("id", "shingles"),
                  "metric-sets")


# ---- regions ---------------------------------------------------------------------------------

_MEMBER = "cell long, id long, mask long, before long, n long, shingles binary"
_ASSIGNED = _MEMBER + ", a long, b long"


def _array(column) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _assigned(percent: int, level: int):
    """(members of a slice of a region, the region's pivots) -> the members in the region of
    their nearest pivot and in the windows of others, and links (a, b) to pivots."""
    r, eps = (100 - percent) / 100, 1e-9

    def run(members: pa.Table, pivots: pa.Table) -> pa.Table:
        schema = pa.schema([(c, pa.binary() if c == "shingles" else pa.int64()) for c in
                            ("cell", "id", "mask", "before", "n", "shingles", "a", "b")])
        if not members.num_rows:
            return schema.empty_table()
        pivots = pivots.sort_by("id")
        sets, n = _array(members.column("shingles")), members.column("n").to_numpy()
        flat, starts = np.concatenate(sets), np.concatenate([[0], np.cumsum(n)[:-1]])
        ids, names = members.column("id").to_numpy(), pivots.column("id").to_pylist()
        both = np.stack([np.add.reduceat(np.isin(flat, p).astype(np.int64), starts) for p in _array(pivots.column("shingles"))], 1)
        union = n[:, None] + pivots.column("n").to_numpy()[None, :] - both
        away = 1 - both / union
        home = away.argmin(axis=1)
        least = away[np.arange(len(n)), home]
        home = np.where(least > FAR, len(names), home)          # the far region comes last
        window = (away <= np.where(least > FAR, 1.0, least + 2 * r)[:, None] + eps) & (away <= FAR + r + eps)
        window &= np.arange(len(names))[None, :] < home[:, None]
        row, region = np.nonzero(window)
        row, region = np.concatenate([np.arange(len(n)), row]), np.concatenate([home, region])
        replica = np.arange(len(row)) >= len(n)
        cell = members.column("cell")[0].as_py()
        number = np.array([xxhash.xxh3_64_intdigest(f"{cell}/{level}/{j}") >> 1 for j in range(len(names) + 1)], np.int64)
        out = pa.table({
            "cell": number[region], "id": ids[row], "mask": members.column("mask").to_numpy()[row] | (replica.astype(np.int64) << level),
            "before": members.column("size").to_numpy()[row], "n": n[row],
            "shingles": members.column("shingles").take(pa.array(row)), "a": pa.nulls(len(row), pa.int64()),
            "b": pa.nulls(len(row), pa.int64())}, schema=schema)
        x, p = np.nonzero((100 * both >= percent * union) & (ids[:, None] != np.array(names)[None, :]))
        links = pa.table({c: pa.nulls(len(x), schema.field(c).type) for c in schema.names[:6]}
                         | {"a": pa.array(np.array(names, np.int64)[p]), "b": pa.array(ids[x])}, schema=schema)
        return pa.concat_tables([out, links])
    return run


def join_region(ids: np.ndarray, masks: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Exact join of a region: links that join components, compared as bitsets of the
    shingles that two members share."""
    order = np.argsort([len(s) for s in sets], kind="stable")
    ids, masks, sets = ids[order], masks[order], [sets[i] for i in order]
    n = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets)
    _, code, count = np.unique(flat, return_inverse=True, return_counts=True)
    column = np.cumsum(count > 1) - 1
    shared, cuts = np.where(count > 1, column, -1)[code.reshape(-1)], np.cumsum(n)[:-1]
    width = 64 * (int(column[-1]) // 64 + 1)
    bits = np.zeros((len(n), width // 64), np.uint64)
    for i, own in enumerate(np.split(shared, cuts)):
        row = np.zeros(width, np.uint8)
        row[own[own >= 0]] = 1
        bits[i] = np.packbits(row).view(np.uint64)
    of, links = np.arange(len(n)), []
    for i in range(len(n) - 1):
        to = int(np.searchsorted(percent * n, 100 * n[i], side="right"))     # larger ones are too far
        other = np.arange(i + 1, to)
        other = other[(of[other] != of[i]) & (masks[other] & masks[i] == 0) & (ids[other] != ids[i])]
        if not len(other):
            continue
        both = np.bitwise_count(bits[other] & bits[i]).sum(axis=1, dtype=np.int64)
        for j in other[100 * both >= percent * (n[i] + n[other] - both)]:
            if of[j] != of[i]:
                of[of == of[j]] = of[i]
                links.append((int(ids[i]), int(ids[j])))
    return links


def _joined(percent: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("cell")
        cells, ids, masks = (t.column(c).to_numpy() for c in ("cell", "id", "mask"))
        sets, links = _array(t.column("shingles")), []
        for at in np.split(np.arange(len(cells)), np.flatnonzero(np.diff(cells)) + 1):
            links += join_region(ids[at], masks[at], [sets[i] for i in at], percent)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()), "b": pa.array([b for _, b in links], pa.int64())})
    return run


def _region_links(members: DataFrame, percent: int, most: int, load: int, levels: int) -> list[DataFrame]:
    """members: (cell, id, mask, before, n, shingles); the links of all regions."""
    out, level = [], 0
    while True:
        sizes = stored(members.groupBy("cell").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("load"),
                                                   F.max("before").alias("was")), "metric-sizes")
        sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("size") / most), F.ceil(F.col("load") / load)))
        cut = (F.col("blocks") > 1) & (F.col("size") > 1)
        if level < levels:
            cut = cut & ((level == 0) | (F.col("size") <= SHRINK * F.col("was")))
            large = sizes.where(cut)
            small = sizes.where(~cut)
        else:
            large, small = sizes.limit(0), sizes
        # regions that fit a task share one; those that pivots do not cut go as pairs of blocks
        rows, weight = small.agg(F.sum("size"), F.sum("load")).first()
        calls = max(1, -(-(rows or 0) // (2 * most)), -(-(weight or 0) // load))
        dealt = members.join(small.select("cell", "blocks"), "cell").withColumn(
            "block", F.pmod(F.xxhash64("id", F.lit(level)), F.col("blocks"))).withColumn(
            "other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        # the two sides of a pair of blocks are replicas of a level of their own
        side = F.when(F.col("block") == F.col("other"), 0).when(F.col("block") < F.col("other"), 1 << 61).otherwise(1 << 62)
        dealt = dealt.select(
            "cell", "id", F.col("mask").bitwiseOR(side.cast("long")).alias("mask"), "n", "shingles",
            F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
            F.when(F.col("blocks") == 1, F.pmod(F.xxhash64("cell"), F.lit(calls))).otherwise(F.col("cell")).alias("deal"))
        out.append(stored(dealt.groupBy("deal", "x", "y").applyInArrow(_joined(percent), "a long, b long"), "metric-links"))
        if level >= levels or not large.limit(1).count():
            return out
        large = stored(large.withColumn("pivots", F.least(F.lit(PIVOTS), F.greatest(
            F.lit(2), F.least(F.ceil(4 * F.col("blocks")), F.floor(load * F.col("size") / F.col("load")))))), "metric-large")
        inside = members.join(large, "cell")
        ranked = inside.select("cell", "id", "n", "shingles", "blocks", "pivots", F.row_number().over(
            Window.partitionBy("cell").orderBy(F.xxhash64("id", F.lit(level)), "id")).alias("rank")).where(F.col("rank") <= PIVOTS)
        chosen = stored(ranked.where("rank <= pivots").dropDuplicates(["cell", "id"]).drop("pivots", "rank"), "metric-pivots")
        pivots = chosen.select(
            "cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("slice"), "id", "n", "shingles")
        sliced = inside.withColumn("slice", F.pmod(F.xxhash64("id", F.lit(-1 - level)), F.col("blocks"))).select(
            "cell", "slice", "id", "mask", "size", "n", "shingles")
        found = stored(sliced.groupBy("cell", "slice").cogroup(pivots.groupBy("cell", "slice")).applyInArrow(
            _assigned(percent, level), _ASSIGNED), "metric-regions")
        out.append(found.where("a IS NOT NULL").select("a", "b"))
        members = found.where("a IS NULL").drop("a", "b")
        level += 1


# ---- the join --------------------------------------------------------------------------------

def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 3,
                       percent: int = 90, members: int = MEMBERS, load: int = LOAD, levels: int = LEVELS) -> DataFrame:
    """One row per document: doc_id, n_shingles and component_id, the smallest doc_id reachable
    over links, itself included.

    Linked are documents whose sets of distinct ``words``-word shingles (A-Z lower-cased) have
    100 * intersection >= ``percent`` * union; the join is exact.  Null or empty text has the
    empty set and no links.  A null doc_id has no links: component null.  Rows that repeat a
    doc_id count as documents of their own and get a row each.  An empty table gives an empty
    result; other columns are not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    sketched = stored(rows.mapInArrow(_sketched(words, percent), "doc_id long, n_shingles long, same binary, keys binary"),
                      "metric-sketches")
    classes = stored(sketched.where("doc_id IS NOT NULL AND same IS NOT NULL").groupBy("same").agg(
        F.min(F.struct("doc_id", "keys", "n_shingles")).alias("of")).select(
        F.monotonically_increasing_id().alias("id"), "same", F.col("of.doc_id").alias("first"), F.col("of.keys").alias("keys"),
        F.col("of.n_shingles").alias("n")), "metric-classes")
    whole, sketched = sketched, stored(sketched.drop("keys"), "metric-documents")
    discard(whole)
    # sets that share a part; the second time only keys that (a bitmap says) are shared travel, and
    # their table is written, so a hot key is split
    shared = stored(classes.select("id", "keys").mapInArrow(_exploded(), "id long, key long").groupBy("key").agg(
        F.min("id").alias("a"), F.max("id").alias("last")).where("a < last").select("key", "a"), "metric-keys")
    again = classes.select("id", "keys").mapInArrow(_exploded(*id_marks(shared, "key", _key_bit)), "id long, key long")
    edges = stored(again.join(shared, "key").where("id <> a").select("a", F.col("id").alias("b")).distinct(), "metric-edges")
    whole, classes = classes, stored(classes.drop("keys"), "metric-numbered")
    discard(whole, shared)
    groups = components(edges)
    wanted = stored(groups.join(classes, "id"), "metric-wanted")
    sets = _full_sets(rows, wanted, words)
    start = stored(wanted.join(sets, "id").select(
        F.col("component").alias("cell"), "id", F.lit(0).cast("long").alias("mask"), F.lit(0).cast("long").alias("before"),
        "n", "shingles"), "metric-members")
    links = functools.reduce(DataFrame.unionByName, _region_links(start, percent, members, load, levels))
    labels = components(stored(links, "metric-all-links"))
    of = classes.select("id", "same", "first").join(labels, "id", "left").withColumn("component", F.coalesce("component", "id"))
    smallest = stored(of.groupBy("component").agg(F.min("first").alias("component_id")), "metric-smallest")
    named = stored(of.join(smallest, "component").select("same", "component_id"), "metric-named")
    return sketched.select("doc_id", "n_shingles", "same").join(named, "same", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
