"""Exact duplicate texts by deterministic block naming (Karp, Miller, Rosenberg).

A normalised text is cut into fixed-size blocks of UTF-8 bytes.  Equal blocks get
equal integer names: the distinct blocks of a hash bucket are sorted, and a
block's name is its bucket number and its rank.  Then adjacent names are paired
and the pairs named the same way, so a text of n blocks has one name after
ceil(log2 n) levels.  Names compare whole contents, not hashes, so the identity
(byte length, name) is free of collisions.

Naming runs as ask and answer (see ``common``): a block that occurs in a third of
all documents leaves each chunk once, so its bucket gets one copy of it per chunk.  Every level is a written table, so a lost
executor costs one task and the plan never grows.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import (CHUNK_BYTES, SPACE, buckets_for, chunked, pack, spans, stored,
                                 text_of, unpack)

#: Bytes of a block.
BLOCK_BYTES = 8192
#: Bytes of blocks (or pairs, 16 each) that a bucket names in one task.
BUCKET_BYTES = 16 << 20
#: A name is bucket << RANK_BITS | rank.
RANK_BITS = 36

STATE = "chunk long, doc_ids array<long>, sha array<string>, carried array<binary>, sizes binary, counts binary, names binary"
ASK = "bucket long, chunk long, places binary, lengths binary, items binary"
ANSWER = "chunk long, places binary, names binary"
PAIR = ">qq"


def _first_blocks(block_bytes: int, carry: tuple[str, ...]):
    """Text rows -> per chunk: the documents, and their blocks as chunk-local codes."""

    def run(batches):
        for chunk, t in chunked(batches, CHUNK_BYTES):
            codes, blocks, counts, sizes, index = [], [], [], [], {}
            for text in t.column("text").to_pylist():
                data = text.encode()
                sizes.append(len(data))
                counts.append(max(1, -(-len(data) // block_bytes)))
                for at in range(0, counts[-1] * block_bytes, block_bytes):
                    block = data[at:at + block_bytes]
                    code = index.setdefault(block, len(blocks))
                    if code == len(blocks):
                        blocks.append(block)
                    codes.append(code)
            yield pa.RecordBatch.from_pydict({
                "chunk": [chunk], "doc_ids": [t.column("doc_id").to_pylist()],
                "sha": [t.column("sha").to_pylist()],
                "carried": [[pack(t.column(c).to_numpy()) for c in carry]], "sizes": [pack(np.array(sizes, np.int64))],
                "counts": [pack(np.array(counts, np.int64))],
                "names": [pack(np.array(codes, np.int64))],
                "items": [zstandard.compress(b"".join(blocks), 1)],
                "lengths": [pack(np.array([len(b) for b in blocks], np.int64))],
                "item_bytes": [sum(map(len, blocks))]}, schema=_arrow(STATE, items="binary", lengths="binary", item_bytes="long"))
    return run


def _arrow(ddl: str, **more: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string()), "array<binary>": pa.list_(pa.binary())}
    fields = [f.strip().split(" ", 1) for f in ddl.split(", ")] + [*more.items()]
    return pa.schema([(name, kinds[kind]) for name, kind in fields])


def _pairs(counts: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Adjacent pairs of each document's names (a lone last one pairs with -1):
    the distinct pairs, the code of each document's pairs, and their new counts."""
    starts, halves = spans(counts)[:-1], (counts + 1) // 2
    where = np.repeat(starts - 2 * spans(halves)[:-1], halves) + 2 * np.arange(halves.sum())
    ends = np.repeat(starts + counts, halves)
    second = np.where(where + 1 < ends, names[np.minimum(where + 1, len(names) - 1)], -1)
    pairs = np.stack([names[where], second], axis=1)
    distinct, codes = np.unique(pairs, axis=0, return_inverse=True)
    return distinct, codes.reshape(-1), halves


def _ask_blocks(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, cuts = zstandard.decompress(row["items"]), spans(unpack(row["lengths"], np.int64))
                yield from _ask(row["chunk"], [data[a:b] for a, b in zip(cuts, cuts[1:])], buckets)
    return run


def _ask_pairs(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                distinct, _, _ = _pairs(unpack(row["counts"], np.int64), unpack(row["names"], np.int64))
                yield from _ask(row["chunk"], [struct.pack(PAIR, *p) for p in distinct.tolist()], buckets)
    return run


def _ask(chunk: int, items: list[bytes], buckets: int):
    """One request row for each bucket that holds some of the chunk's distinct items."""
    where = np.array([zlib.crc32(x) for x in items], np.int64) & (buckets - 1)
    order = np.argsort(where, kind="stable")
    cuts = np.flatnonzero(np.diff(where[order], prepend=-1))
    rows = []
    for places in np.split(order, cuts[1:]):
        own = [items[i] for i in places]
        rows.append({"bucket": int(where[places[0]]), "chunk": chunk, "places": pack(places),
                     "lengths": pack(np.array([len(x) for x in own], np.int64)),
                     "items": zstandard.compress(b"".join(own), 1)})
    yield pa.RecordBatch.from_pylist(rows, schema=_arrow(ASK))


def _name(asked: pa.Table) -> pa.Table:
    """Sort a bucket's distinct items; a name is the bucket and the rank in it."""
    rows, lists = asked.to_pylist(), []
    for row in rows:
        data, cuts = zstandard.decompress(row["items"]), spans(unpack(row["lengths"], np.int64))
        lists.append([data[a:b] for a, b in zip(cuts, cuts[1:])])
    base = rows[0]["bucket"] << RANK_BITS
    name = {item: base + rank for rank, item in enumerate(sorted(set().union(*lists)))}
    return pa.Table.from_pylist(
        [{"chunk": row["chunk"], "places": row["places"],
          "names": pack(np.array([name[x] for x in own], np.int64))} for row, own in zip(rows, lists)],
        schema=_arrow(ANSWER))


def _named(paired: bool):
    """Put the answered names in the place of a chunk's codes."""

    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        schema = _arrow(STATE)
        if not state.num_rows:
            return schema.empty_table()
        row = state.to_pylist()[0]
        counts, codes = unpack(row["counts"], np.int64), unpack(row["names"], np.int64)
        if paired:
            _, codes, counts = _pairs(counts, codes)
        names = np.zeros(int(codes.max()) + 1, np.int64)
        for places, got in zip(answers.column("places").to_pylist(), answers.column("names").to_pylist()):
            names[unpack(places, np.int64)] = unpack(got, np.int64)
        new = row | {"counts": pack(counts), "names": pack(names[codes])}
        return pa.Table.from_pylist([{k: new[k] for k in schema.names}], schema=schema)
    return run


def _flat(carry: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                n = len(row["doc_ids"])
                yield pa.RecordBatch.from_pydict({
                    "chunk": np.full(n, row["chunk"]), "place": np.arange(n),
                    "doc_id": pa.array(row["doc_ids"], pa.int64()), "text_sha256": pa.array(row["sha"], pa.string()),
                    "size": unpack(row["sizes"], np.int64), "name": unpack(row["names"], np.int64),
                    **{c: unpack(x, np.int64) for c, x in zip(carry, row["carried"])}})
    return run


def _level(state: DataFrame, asked: DataFrame, paired: bool) -> DataFrame:
    answers = asked.groupBy("bucket").applyInArrow(_name, ANSWER)
    joined = state.groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return stored(joined.applyInArrow(_named(paired), STATE), "exact_dedup-state")


def text_identities(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    block_bytes: int = BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """chunk, place (together a row's key), doc_id, text_sha256, size, name and the long
    columns ``carry``: two rows have equal (size, name) exactly when their normalised texts are equal."""
    plain = F.regexp_replace(text_of(text_col), SPACE, " ")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), plain.alias("text"), *carry).withColumn(
        "sha", F.sha2("text", 256))
    first = stored(rows.mapInArrow(_first_blocks(block_bytes, carry),
                                   STATE + ", items binary, lengths binary, item_bytes long"), "exact_dedup-blocks")
    total = first.agg(F.sum("item_bytes")).first()[0] or 0
    asked = first.select("chunk", "items", "lengths").mapInArrow(
        _ask_blocks(buckets_for(total, BUCKET_BYTES)), ASK)
    state = _level(first.drop("items", "lengths", "item_bytes"), asked, paired=False)
    while True:
        most, total = state.select("counts").mapInArrow(_extent, "most long, total long").agg(
            F.max("most"), F.sum("total")).first()
        if (most or 1) == 1:
            return state.mapInArrow(
                _flat(carry), "chunk long, place long, doc_id long, text_sha256 string, size long, name long"
                + "".join(f", {c} long" for c in carry))
        asked = state.select("chunk", "counts", "names").mapInArrow(
            _ask_pairs(buckets_for(16 * total, BUCKET_BYTES)), ASK)
        state = _level(state, asked, paired=True)


def _extent(batches):
    for batch in batches:
        for data in batch.column("counts").to_pylist():
            counts = unpack(data, np.int64)
            yield pa.RecordBatch.from_pydict({"most": [int(counts.max())], "total": [int(counts.sum())]})


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                block_bytes: int = BLOCK_BYTES, carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, and the columns
    ``carry`` of docs (long, without nulls) as they are.

    Texts are equal when identical after replacing each run of white space by one
    space; of equal texts the smallest doc_id stays.  Null text counts as empty,
    and all empty texts are equal.  A null doc_id counts as larger than any other.
    Rows repeated with the same id and text: one of them stays (``kept``), all
    share ``keep_id``.  An empty table gives an empty result.  Other columns are
    not read.
    """
    flat = text_identities(docs, id_col, text_col, block_bytes, carry)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "chunk", "place")
    groups = flat.groupBy("size", "name").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size"))
    # written, so that the join has exchanges of its own and splits a hot group
    groups = stored(groups.where("group_size > 1"), "exact_dedup-groups")
    alone = F.col("first").isNull()
    kept = (F.col("chunk") == F.col("first.chunk")) & (F.col("place") == F.col("first.place"))
    return flat.join(groups, ["size", "name"], "left").select(
        "doc_id", F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | kept).alias("kept"), "text_sha256", *carry)
