"""Mixing sources to target weights with fixed-length blocks.

Every source's documents, in a pseudorandom but fixed order, are one stream of
words cut into blocks of equal length.  An output shard has a fixed number of slots
and draws how many of them each source fills, a multinomial of the sources' shares from a
generator seeded by the shard.  A slot's
number within its source (a prefix sum over the shards) is mapped through the
source's pseudorandom permutation of block numbers, one permutation per pass over the
source, and blocks are joined by that index.  Slots that would take a source beyond
its quota go to the sources that the draws left short, so no block is used more often
than the target allows.

A source is split into lanes of bounded size before its running sums, so a source
with a third of all rows is not one task's work.  Only the table of sources (one row
each, at most MAX_SOURCES, checked) reaches the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import stored, text_of

#: Words of a block.
BLOCK_WORDS = 128
#: Slots of an output shard.
SHARD_SLOTS = 4096
#: Words of a lane, whose running sum one task computes.
LANE_WORDS = 1 << 20
#: Documents whose words are cut at a time.
CUT_ROWS = 256
#: Slots that one task makes, about.
TASK_SLOTS = 1 << 18
#: More sources than this are refused: their table is broadcast and held on the driver.
MAX_SOURCES = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Mix:
    """sized: uid, doc_id, source, size, source_size, target.  pieces: where each
    document's words lie (uid, number, block, first_word, words).  slots: shard, number,
    block, epoch.  ``number`` is the source's place by code point."""

    sized: DataFrame
    pieces: DataFrame
    slots: DataFrame


def source_targets(sources: DataFrame, weights: tuple[float, ...], cap: float) -> DataFrame:
    """(source, source_size) -> number, weight and target: shares of the total by
    weight, at most ``cap`` times the source, the excess reshared by weight until none
    is above.  With the sources ordered by the weight at which they reach the cap this
    is one pass of running sums; the window holds one row per source."""
    numbered = sources.withColumn(
        "number", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    limit = cap * F.col("source_size")
    order = Window.orderBy(F.col("limit") / F.col("weight"), "number")
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))))
    filled = numbered.withColumns({"weight": weight, "limit": limit.cast("double")}).withColumn("level", level).withColumn(
        "capped", F.col("limit") <= F.col("level") * F.col("weight"))
    rest = F.min(F.when(~F.col("capped"), F.struct(F.col("limit") / F.col("weight"), "number", "level"))).over(whole)
    return filled.withColumn("rest", rest["level"]).select(
        "source", "source_size", "number", "weight",
        F.when(F.col("capped"), F.col("limit")).otherwise(F.col("rest") * F.col("weight")).alias("target"))


def _quotas(target: np.ndarray, size: np.ndarray, blocks: np.ndarray, cap: float) -> np.ndarray:
    """Whole slots per source: its target in blocks of its mean length, by largest remainder."""
    wish = np.divide(target * blocks, size, out=np.zeros(len(size)), where=size > 0)
    most = np.floor(cap * blocks + 1e-9).astype(np.int64)
    quota = np.minimum(np.floor(wish + 1e-9).astype(np.int64), most)
    missing = int(round(wish.sum())) - int(quota.sum())
    for i in np.argsort(-(wish - quota), kind="stable")[:max(0, missing)]:
        quota[i] += quota[i] < most[i]
    return quota


def _draws(quota: np.ndarray, shard_slots: int, seed: int):
    """Shard number -> slots of every source in that shard."""
    total = int(quota.sum())
    share = quota / max(1, total)
    share = share / max(share.sum(), 1e-300)

    def run(frames):
        for frame in frames:
            out = []
            for shard in frame["id"]:
                n = min(shard_slots, total - int(shard) * shard_slots)
                counts = np.random.default_rng([seed, int(shard)]).multinomial(n, share)
                number = np.flatnonzero(counts)
                out.append(pd.DataFrame({"shard": shard, "number": number, "count": counts[number]}))
            yield pd.concat(out)
    return run


def _pass_key(*numbers: int) -> int:
    """A key for some numbers, the same on every machine."""
    x = 0
    for n in numbers:
        x = ((x ^ n) * 0x9E3779B97F4A7C15 + 0x165667B19E3779F9) & ((1 << 64) - 1)
        x ^= x >> 29
    return x >> 4


def permuted(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1 (four Feistel rounds, walked until inside)."""
    half = np.uint64(max(1, (max(1, n - 1).bit_length() + 1) // 2))
    mask, out = (np.uint64(1) << half) - np.uint64(1), index.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        x = out[todo]
        for r in range(4):
            left, right = x >> half, x & mask
            f = (right + np.uint64((key * 4 + r) % (1 << 63))) * np.uint64(0x9E3779B97F4A7C15)
            f = (f ^ (f >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (right << half) | ((left ^ (f >> np.uint64(31))) & mask)
        out[todo] = x
        todo[todo] = x >= np.uint64(n)
    return out.astype(np.int64)


def _slots(quota: np.ndarray, drawn: np.ndarray, blocks: np.ndarray, seed: int):
    """(shard, number, offset, count) -> one row per slot with its block."""
    surplus, short = np.maximum(drawn - quota, 0), np.maximum(quota - drawn, 0)
    surplus_at, short_at = np.cumsum(surplus) - surplus, np.cumsum(short)

    def run(batches):
        for batch in batches:
            t = batch.to_pandas()
            number = np.repeat(t["number"].to_numpy(), t["count"])
            ends = np.cumsum(t["count"].to_numpy())
            own = np.arange(len(number)) - np.repeat(ends - t["count"].to_numpy(), t["count"]) + np.repeat(
                t["offset"].to_numpy(), t["count"])
            over = own >= quota[number]
            if over.any():                  # the k-th slot too many is the k-th that is missing elsewhere
                k = surplus_at[number[over]] + own[over] - quota[number[over]]
                to = np.searchsorted(short_at, k, side="right")
                number[over], own[over] = to, drawn[to] + k - (short_at - short)[to]
            block, epoch = np.empty(len(number), np.int64), own // blocks[number]
            pairs, which = np.unique(np.stack([number, epoch]), axis=1, return_inverse=True)
            for j, (i, e) in enumerate(pairs.T.tolist()):
                at = which.reshape(-1) == j
                block[at] = permuted(own[at] % blocks[i], int(blocks[i]), _pass_key(seed, i, e))
            yield pa.RecordBatch.from_pydict({
                "shard": pa.array(np.repeat(t["shard"].to_numpy(), t["count"])), "number": pa.array(number),
                "block": pa.array(block), "epoch": pa.array(epoch)})
    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: tuple[float, ...] = (1, 2, 3), cap: float = 3, block_words: int = BLOCK_WORDS,
                shard_slots: int = SHARD_SLOTS, seed: int = 42, uid: str | None = None) -> Mix:
    """Plan a mix of all documents.  Sizes are words; sources by code point, null last,
    weigh ``weights``, repeating.

    Null text has no words; documents without words are in no block.  A null source
    is a source, a null id is kept.  Repeated rows count each.  An empty table, or one
    without words, gives empty pieces and slots.  Only the named columns are read.
    The order within a source is by a hash of the id, then id and size, so reruns agree.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(uid).alias("uid") if uid else F.monotonically_increasing_id().alias("uid"),
        F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"),
        F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"))
    rows = stored(rows, "mixing-sizes")
    sources = stored(source_targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, cap),
                     "mixing-sources")
    if sources.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources")
    sized = rows.join(F.broadcast(sources.withColumnRenamed("source", "own")),
                      F.col("source").eqNullSafe(F.col("own"))).drop("own", "weight")

    order = F.xxhash64("doc_id", F.lit(seed))
    lane = F.pmod(F.shiftright(order, 7), F.ceil(F.col("source_size") / F.lit(float(LANE_WORDS))).cast("long"))
    laned = sized.where("size > 0").withColumns({"order": order, "lane": lane})
    run = Window.partitionBy("number", "lane").orderBy("order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    placed = stored(laned.withColumn("start", F.coalesce(F.sum("size").over(run), F.lit(0))).select(
        "uid", "number", "lane", "start", "size"), "mixing-placed")
    lanes = placed.groupBy("number", "lane").agg(
        F.ceil(F.max(F.col("start") + F.col("size")) / F.lit(block_words)).alias("blocks")).withColumn(
        "base", F.coalesce(F.sum("blocks").over(Window.partitionBy("number").orderBy("lane").rowsBetween(
            Window.unboundedPreceding, -1)), F.lit(0)))
    lanes = stored(lanes, "mixing-lanes")
    end, first = F.col("start") + F.col("size"), F.col("part") * block_words
    pieces = placed.join(lanes, ["number", "lane"]).withColumn("part", F.explode(F.sequence(
        F.floor(F.col("start") / block_words), F.floor((end - 1) / block_words)))).select(
        "uid", "number", (F.col("base") + F.col("part")).alias("block"),
        (F.greatest(first, F.col("start")) - F.col("start")).alias("first_word"),
        (F.least(first + block_words, end) - F.greatest(first, F.col("start"))).alias("words"))

    known = sources.join(lanes.groupBy("number").agg(F.sum("blocks").alias("blocks")), "number", "left").orderBy(
        "number").select("target", "source_size", F.coalesce("blocks", F.lit(0)).alias("blocks")).collect()
    target, size, blocks = (np.array(x) for x in zip(*known)) if known else (np.zeros(0), np.zeros(0), np.zeros(0, int))
    blocks = np.maximum(blocks.astype(np.int64), 0)
    quota = _quotas(target, size, blocks, cap) if known else np.zeros(0, np.int64)
    shards = -(-int(quota.sum()) // shard_slots)
    drawn = stored(spark.range(shards).mapInPandas(_draws(quota, shard_slots, seed), "shard long, number long, count long"),
                   "mixing-draws")
    totals = np.zeros(len(quota), np.int64)
    for r in drawn.groupBy("number").agg(F.sum("count")).collect():
        totals[r[0]] = r[1]
    offset = F.coalesce(F.sum("count").over(Window.partitionBy("number").orderBy("shard").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    # a drawn row becomes as many slots as it counts: dealt by number, not by bytes before that
    tasks = max(1, -(-int(quota.sum()) // TASK_SLOTS))
    slots = drawn.withColumn("offset", offset).select("shard", "number", "offset", "count").repartition(tasks, "shard").mapInArrow(
        _slots(quota, totals, np.maximum(blocks, 1), seed), "shard long, number long, block long, epoch long")
    # written, so that the planner knows its size and does not broadcast it
    return Mix(sized, pieces, stored(slots, "mixing-slots"))


def taken_words(mix: Mix) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken (words of
    it that the mix takes, repeats counted)."""
    uses = mix.slots.groupBy("number", "block").agg(F.count(F.lit(1)).alias("uses"))
    taken = mix.pieces.join(uses, ["number", "block"]).groupBy("uid").agg(
        F.sum(F.col("words") * F.col("uses")).alias("taken"))
    return mix.sized.join(taken, "uid", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mixed_documents(docs: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The mix as documents: for every pass over its source, a document with the words
    that the pass takes of it (whole documents keep their exact text), all other
    columns unchanged.  Documents of which nothing is taken are absent."""
    keyed = stored(docs.withColumn("__uid", F.monotonically_increasing_id()), "mixing-documents")
    mix = mix_sources(keyed, text_col=text_col, uid="__uid", **options)
    taken = mix.pieces.join(mix.slots.select("number", "block", "epoch"), ["number", "block"]).groupBy(
        "uid", "epoch").agg(F.sort_array(F.collect_list(F.struct("first_word", "words"))).alias("__parts"))
    rows = keyed.join(taken.withColumnRenamed("uid", "__uid"), "__uid").drop("__uid", "epoch")
    place = docs.columns.index(text_col)

    def cut(batches):
        import re

        word = re.compile(WORD)
        # a slice at a time bounds the Python strings that a task holds beside its batch
        for batch in (b.slice(at, CUT_ROWS) for b in batches for at in range(0, b.num_rows, CUT_ROWS)):
            texts = []
            for text, parts in zip(batch.column(place).to_pylist(), batch.column("__parts").to_pylist()):
                at = [m.span() for m in word.finditer(text)]
                if sum(p["words"] for p in parts) < len(at):
                    cuts = []
                    for p in parts:
                        a, b = p["first_word"], p["first_word"] + p["words"]
                        if cuts and cuts[-1][1] == a:
                            cuts[-1][1] = b
                        else:
                            cuts.append([a, b])
                    text = "\n".join(text[at[a][0]:at[b - 1][1]] for a, b in cuts)
                texts.append(text)
            columns = batch.columns[:len(docs_names)]
            columns[place] = pa.array(texts, batch.schema.field(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=docs_names)

    docs_names = list(docs.columns)
    return rows.select(*docs_names, "__parts").mapInArrow(cut, docs.schema)
