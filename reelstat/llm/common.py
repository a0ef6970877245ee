"""Helpers shared by the operators of this subpackage.

Several operators use one pattern, here called *ask and answer*: a task packs
its documents into a bounded **chunk**, sends the chunk's *distinct* items
(words, n-grams, blocks) to hash buckets, a bucket merges the requests of all
chunks and sends one packed answer back to each chunk.  An item that fills a
third of all rows leaves a chunk once, so its bucket gets one copy per chunk, and a
bucket's mean size is fixed by choosing the number of buckets from the number of items.
"""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.session import shared_dir

#: Word separators of all contracts: space and the five ASCII controls 09-0D.
SPACE = r"[\x20\x09-\x0D]+"
#: Bytes of text that one chunk gathers before it is packed.
CHUNK_BYTES = 8 << 20
#: A bitmap of hashed ids has 16 bits for each id, up to so many bits (32 MB).
MARK_BITS = 1 << 28
#: Masks of 4096 rows each (about 600 bytes) that are broadcast; more are joined by a shuffle.
MASK_BLOCKS = 1 << 16
#: Rows of an Arrow batch while a pipeline stage runs.
ARROW_ROWS = 2000
#: A row's place in a table read from Parquet: a hash of its file's path, and its number there.
PLACE = ("__file", "__row")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


_SCRATCH: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("scratch", default=None)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder of the shared checkpoint directory and read
    it back: later steps neither recompute it nor depend on an executor."""
    path = shared_dir(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._stored_at = path
    if _SCRATCH.get() is not None:
        _SCRATCH.get().append(path)
    return out


def _delete(spark: SparkSession, paths) -> None:
    for p in paths:
        path = spark._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    # Spark drops the shuffle files of plans that nothing refers to any more when the driver
    # collects garbage, else every 30 minutes
    gc.collect()
    spark._jvm.java.lang.System.gc()


def discard(*tables: DataFrame) -> None:
    """Delete tables from ``stored`` that no later step reads."""
    _delete(tables[0].sparkSession, [t._stored_at for t in tables])


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Delete the tables that are ``stored`` inside, on exit, but those given to the yielded
    function.  Nothing lazy that reads the others may leave the block.  Inside, Arrow batches
    have at most ARROW_ROWS rows: with whole texts the default of 10,000 is tens of MB a task."""
    paths: list[str] = []
    keep = set()
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(ARROW_ROWS))

    def kept(table: DataFrame) -> DataFrame:
        keep.add(table._stored_at)
        return table

    token = _SCRATCH.set(paths)
    try:
        yield kept
    finally:
        _SCRATCH.reset(token)
        spark.conf.set(setting, before)
        _delete(spark, [p for p in paths if p not in keep])


# ---- verdicts on rows without moving their texts ------------------------------------------------

def placed(docs: DataFrame) -> DataFrame:
    """docs with the columns PLACE, the same in every scan; what is no plain scan of
    Parquet files is written first."""
    def of(table):
        return table.select(*table.columns, F.xxhash64("_metadata.file_path").alias(PLACE[0]),
                            F.col("_metadata.row_index").alias(PLACE[1]))
    try:
        return of(docs)
    except AnalysisException:
        return of(stored(docs, "placed"))


def masks(rows: DataFrame) -> DataFrame:
    """PLACE of some rows -> (__file, __block, words): 64 words of 64 bits for 4096 rows of a file."""
    row = F.col(PLACE[1])
    words = rows.groupBy(PLACE[0], F.shiftright(row, 6).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, CAST({PLACE[1]} & 63 AS INT))")).alias("bits"))
    entries = F.map_from_entries(F.collect_list(F.struct(F.expr("CAST(word & 63 AS INT)"), "bits")))
    return words.groupBy(PLACE[0], F.shiftright("word", 6).alias("__block")).agg(entries.alias("words")).select(
        PLACE[0], "__block", F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.coalesce(
            F.try_element_at("words", i), F.lit(0).cast("long"))).alias("__words"))


def without(rows: DataFrame, marked: DataFrame) -> DataFrame:
    """The ``placed`` rows that the stored masks do not mark, without their places.  Masks are an
    eighth of a byte a row; up to MASK_BLOCKS of them are broadcast and no text moves."""
    few = marked.limit(MASK_BLOCKS + 1).count() <= MASK_BLOCKS
    word = F.element_at("__words", F.expr(f"CAST(shiftright({PLACE[1]}, 6) & 63 AS INT) + 1"))
    bit = F.expr(f"CAST({PLACE[1]} & 63 AS INT)")
    joined = rows.withColumn("__block", F.shiftright(PLACE[1], 12)).join(
        F.broadcast(marked) if few else marked, [PLACE[0], "__block"], "left").withColumn("__bit", bit).withColumn("__word", word)
    return joined.where(F.coalesce(F.expr("shiftright(__word, __bit) & 1L"), F.lit(0)) == 0).select(
        *(c for c in rows.columns if c not in PLACE))


def id_bit(column: str, bits: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(bits))


def id_marks(ids: DataFrame, column: str, bit_of=id_bit):
    """(broadcast bitmap of hashed ids, its bits), to leave most rows of other ids where they are.
    16 bits an id up to MARK_BITS; beyond that more of the others pass."""
    bits = min(MARK_BITS, max(1 << 16, 1 << (16 * ids.count()).bit_length()))
    bit = bit_of(column, bits) + 1
    rows = ids.groupBy(F.bitmap_bucket_number(bit).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect()
    out = bytearray(bits // 8)
    for r in rows:                                  # 4096 bytes each
        out[(r["part"] - 1) * 4096:r["part"] * 4096] = r["bits"]
    return ids.sparkSession.sparkContext.broadcast(bytes(out)), bits


def is_marked(marked, bit: pa.Array) -> pa.Array:
    """Whether the bits are set in the broadcast bitmap."""
    bits, bit = np.frombuffer(marked.value, np.uint8), bit.to_numpy()
    return pa.array((bits[bit >> 3] >> (bit & 7)) & 1 == 1)


def text_of(column: str) -> Column:
    """The text column; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def id_crc32(column: str) -> Column:
    """crc32 of an id as decimal text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def give_back() -> None:
    """Return freed memory to the system: workers share the executor's, and idle ones keep theirs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):          # not on every C library
        ctypes.CDLL(None).malloc_trim(0)


def chunked(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[tuple[int, pa.Table]]:
    """Tables with about ``limit`` bytes of ``column`` (one row at least) and an id unique
    in the job: the task's partition number and a running number, the same when a task
    is run again."""
    first, held, size, n = TaskContext.get().partitionId() << 24, [], 0, 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        ends, at = np.cumsum(sizes.to_numpy(zero_copy_only=False)), 0
        while at < batch.num_rows:
            done = ends[at - 1] if at else 0
            to = min(batch.num_rows, int(np.searchsorted(ends, done + limit - size)) + 1)
            held.append(batch.slice(at, to - at))
            size, at = size + int(ends[to - 1] - done), to
            if size >= limit:
                yield first + n, pa.Table.from_batches(held).combine_chunks()
                held, size, n = [], 0, n + 1
                give_back()
    if held:
        yield first + n, pa.Table.from_batches(held).combine_chunks()
    held = batch = None
    give_back()


def pack(values: np.ndarray) -> bytes:
    """An integer array as compressed byte planes."""
    values = np.ascontiguousarray(values)
    planes = values.view(np.uint8).reshape(len(values), values.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(data: bytes, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(planes.reshape(size, -1).T).view(dtype).reshape(-1)


def buckets_for(items: int, per_bucket: int, least: int = 64) -> int:
    """The power of two (``least`` at least) that leaves ``per_bucket`` items a bucket."""
    return max(least, 1 << max(0, int(np.ceil(np.log2(max(1, items) / per_bucket)))))


def spans(lengths: np.ndarray) -> np.ndarray:
    """Start offsets of consecutive runs, and the end of the last one."""
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out
