"""Best-fit packing of token sequences by sums of squares.

Documents become token ids and an end id; longer ones than a sequence are cut into
full pieces with the remainder first.  Full pieces fill a sequence alone.  The others
are dealt by hash into groups of bounded size, and each group is packed in one
task: longest piece first, each piece goes where the sum over all residual gaps of
the squared number of open sequences with that gap becomes smallest.  For the first
half of a group a new sequence competes on equal terms; for the second half, whose
pieces are the short ones, one is opened only when no open sequence has room, so the
variety of gaps that the rule keeps is used up.  On the test tables this wastes less
than 0.1 % over the sum of lengths; a larger group wastes less.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm import tokenizing
from reelstat.llm.common import stored, text_of

#: Pieces of one group, packed in one task.
GROUP_PIECES = 8192

PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, uid long"
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Sequence number and offset of every length (1 to ``capacity``), placed in the given order."""
    open_with = np.zeros(capacity + 1, np.int64)                # number of open sequences per gap
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    sequence, offset, opened = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64), 0
    for i, n in enumerate(map(int, lengths)):
        best, gap = None, capacity
        if n < capacity:
            # closing a gap g and opening g - n changes the sum by this much
            growth = 2 * open_with[:capacity - n] + 1
            growth[0] = 0                                       # a full sequence is no longer open
            change = np.where(open_with[n:capacity] > 0, growth - 2 * open_with[n:capacity] + 1, np.iinfo(np.int64).max)
            k = int(np.argmin(change))
            if open_with[n + k]:
                best = change[k]
        if best is not None and (2 * i >= len(lengths) or best <= 2 * open_with[capacity - n] + 1):
            gap = n + k
            own = stacks[gap].pop()
            open_with[gap] -= 1
        else:
            own, opened = opened, opened + 1
        sequence[i], offset[i] = own, capacity - gap
        if gap > n:
            stacks[gap - n].append(own)
            open_with[gap - n] += 1
    return sequence, offset


def _pieces(tokenizer: str, ranks: str | None, end_id: int, capacity: int):
    def run(batches):
        uid = TaskContext.get().partitionId() << 40
        end = np.array([end_id], "<u4")
        for batch in batches:
            rows = []
            texts = batch.column("text")
            for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                ids = np.concatenate([tokenizing.ids(texts[i].as_py(), tokenizer, ranks), end])
                first = (len(ids) - 1) % capacity + 1
                cuts = [0, *range(first, len(ids) + 1, capacity)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc_id, piece, a, b - a, zlib.crc32(ids[a:b].tobytes()), uid))
                    uid += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 6, kinds)],
                ["doc_id", "piece", "start", "length", "ids_crc32", "uid"])
    return run


def _pack_group(capacity: int):
    def run(group: pa.Table) -> pa.Table:
        first = group.column("deal")[0].as_py() << 32
        order = np.lexsort((group.column("uid").to_numpy(), group.column("ids_crc32").to_numpy(),
                            -group.column("length").to_numpy()))
        group = group.take(pa.array(order))
        sequence, offset = sum_of_squares(group.column("length").to_numpy(), capacity)
        names = ["doc_id", "piece", "start", "length", "ids_crc32"]
        return pa.table([*(group.column(n) for n in names), pa.array(first + sequence),
                         pa.array(offset)], names=[*names, "sequence_id", "offset"])
    return run


def pack_documents(docs: DataFrame, tokenizer: str, ranks: str | None = None, end_id: int = 2, capacity: int = 1024,
                   id_col: str = "doc_id", text_col: str = "text", group_pieces: int = GROUP_PIECES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    ``tokenizer`` is a file of the tokenizers library, ``ranks`` optionally a rank
    file of the same vocabulary (see ``tokenizing``).  Null text counts as empty:
    one piece that holds the end id alone.  A null doc_id stays null.  Repeated rows
    are packed each.  An empty table gives an empty result.  Other columns are not
    read.  Sequence numbers of full pieces are negative.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    pieces = stored(rows.mapInArrow(_pieces(tokenizer, ranks, end_id, capacity), PIECE), "packing-pieces")
    full = pieces.where(F.col("length") == capacity).withColumns(
        {"sequence_id": -1 - F.col("uid"), "offset": F.lit(0).cast("long")}).drop("uid")
    short = pieces.where(F.col("length") < capacity)
    groups = max(1, -(-short.count() // group_pieces))
    packed = short.withColumn("deal", F.pmod(F.xxhash64("doc_id", "uid"), F.lit(groups))).groupBy("deal").applyInArrow(
        _pack_group(capacity), PLACED)
    return packed.unionByName(full)
