"""Source divergence by run-length columns.

Per language the counts of every source are a column over the vocabulary.  The vocabulary
is reordered so that terms of equal counts stand together (sorted by their counts, source by
source), cut into blocks, and every column of a block is run-length encoded.  For a pair
of sources the run boundaries are intersected: between two boundaries both counts are constant,
so the divergence term is computed once and multiplied by the run's length.

Terms are counted in chunks first, then by (language, source, term) with a combine in the map
tasks, so a term or a source that fills a third of all rows arrives as a few rows.  A task of
the pair step holds two tiles of at most TILE columns of one block, whatever the number of
sources; partial sums per block are added up.  All arithmetic is on integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import CHUNK_BYTES, chunked, pack, stored, text_of, unpack

#: A block of the vocabulary holds at most so many terms, and counts over zero.
BLOCK_TERMS, BLOCK_CELLS = 1 << 16, 1 << 21
#: Columns of one side of a tile.
TILE = 64
#: Shares are counted in units of one in SCALE.
SCALE = 10 ** 9
#: What a term keeps of each byte: ASCII letters in lower case, all bytes of other characters, else 0.
_LETTERS = np.array([b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8)


# ---- counts ----------------------------------------------------------------------------------

def _terms(texts: pa.BinaryArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of some UTF-8 texts in order, and the text of each."""
    starts = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[starts[0]:starts[-1]]
    starts = starts - starts[0]
    lowered = _LETTERS[data]
    letter = lowered != 0
    first = letter.copy()                               # a letter after another character or a text's begin
    first[1:] &= ~letter[:-1]
    begins = starts[:-1][starts[:-1] < len(data)]
    first[begins] = letter[begins]
    at = np.flatnonzero(first)
    offsets = np.append(np.cumsum(letter, dtype=np.int32)[at] - 1, np.int32(letter.sum())).astype(np.int32)
    held = np.ascontiguousarray(lowered[letter])
    terms = pa.Array.from_buffers(pa.binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(held)])
    return terms.dictionary_encode(), np.searchsorted(starts, at, side="right") - 1


def _counted(batches):
    """(lang, source, text) -> (lang, source, term, n, docs) of each chunk, and an empty term
    for every group, so that groups without terms are known."""
    for _, t in chunked(batches, CHUNK_BYTES):
        names: dict[tuple[str, str], int] = {}
        group = np.array([names.setdefault(g, len(names)) for g in zip(
            t.column("lang").to_pylist(), t.column("source").to_pylist())], np.int64)
        terms, text = _terms(t.column("text").combine_chunks().cast(pa.binary()))
        size, code = max(1, len(terms.dictionary)), terms.indices.to_numpy().astype(np.int64)
        own, n = np.unique(text * size + code, return_counts=True)              # a text's terms once
        held, at = np.unique(group[own // size] * size + own % size, return_inverse=True)
        total = np.bincount(at.reshape(-1), weights=n, minlength=len(held)).astype(np.int64)
        docs = np.bincount(at.reshape(-1), minlength=len(held))
        word = pa.concat_arrays([terms.dictionary.take(pa.array(held % size)), pa.array([b""] * len(names), pa.binary())])
        which, more = pa.array(np.append(held // size, np.arange(len(names)))), np.zeros(len(names), np.int64)
        yield pa.RecordBatch.from_pydict({
            "lang": pa.array([g[0] for g in names], pa.string()).take(which),
            "source": pa.array([g[1] for g in names], pa.string()).take(which), "term": word.cast(pa.string()),
            "n": np.append(total, more), "docs": np.append(docs, more)})


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, term, n, docs: occurrences and documents of every term in every group, and
    a row with an empty term for every group that occurs.  Nulls count as empty."""
    rows = docs.select(*(text_of(c).alias(a) for c, a in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    return rows.mapInArrow(_counted, "lang string, source string, term string, n long, docs long").groupBy(
        "lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


# ---- run-length columns ----------------------------------------------------------------------

_COLUMN = "lang string, block long, terms long, source string, ends binary, counts binary"


def _encode(lang: str, block: int, entries: pa.ListArray) -> pa.RecordBatch:
    """A block's header (null source), and the run-length column of each source in it."""
    size, cells = len(entries), entries.flatten()
    place = np.repeat(np.arange(size), pc.list_value_length(entries).to_numpy())
    names = pc.struct_field(cells, "source").dictionary_encode()
    counts, code = pc.struct_field(cells, "n").to_numpy(), names.indices.to_numpy()
    order = np.argsort(code, kind="stable")
    ends, values = [None], [None]
    for own in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
        dense = np.zeros(size, np.int64)
        dense[place[own]] = counts[own]
        stop = np.append(np.flatnonzero(np.diff(dense)) + 1, size)
        ends.append(pack(stop.astype(np.int32)))
        values.append(pack(dense[stop - 1]))
    n = len(ends)
    return pa.RecordBatch.from_pydict({
        "lang": pa.array([lang] * n, pa.string()), "block": pa.array([block] * n, pa.int64()),
        "terms": pa.array([size] * n, pa.int64()), "source": pa.array([None, *names.dictionary.to_pylist()], pa.string()),
        "ends": pa.array(ends, pa.binary()), "counts": pa.array(values, pa.binary())})


def _columns(block_terms: int, block_cells: int):
    """Rows (lang, entries) in vocabulary order -> run-length columns of blocks of terms.  A
    source without a row in a block has no occurrence there."""

    def run(batches):
        lang, held, terms, cells, n = None, [], 0, 0, TaskContext.get().partitionId() << 32
        for batch in batches:
            langs, at = batch.column("lang").to_pylist(), 0
            ends = np.cumsum(pc.list_value_length(batch.column("entries")).to_numpy())
            while at < len(langs):
                if held and (langs[at] != lang or terms >= block_terms or cells >= block_cells):
                    yield _encode(lang, n, pa.concat_arrays(held))
                    held, terms, cells, n = [], 0, 0, n + 1
                lang, before = langs[at], int(ends[at - 1]) if at else 0
                to = min(len(langs), at + block_terms - terms, int(np.searchsorted(ends, before + block_cells - cells)) + 1)
                if langs[to - 1] != lang:           # sorted by language
                    to = at + next(k for k, x in enumerate(langs[at:to]) if x != lang)
                held.append(batch.column("entries").slice(at, to - at))
                terms, cells, at = terms + to - at, cells + int(ends[to - 1]) - before, to
        if held:
            yield _encode(lang, n, pa.concat_arrays(held))
    return run


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total) of each count, exact for any size."""
    distinct, where = np.unique(counts, return_inverse=True)
    return np.array([1 + SCALE * (c + 1) // total for c in distinct.tolist()], np.int64)[where.reshape(-1)]


def _tile(t: pa.Table) -> pa.Table:
    """The pairs of one tile pair of a block: sums over the intersected runs, both ways."""
    columns = []
    for source, side, terms, total, ends, counts in zip(*(t.column(c).to_pylist() for c in (
            "source", "side", "terms", "total", "ends", "counts"))):
        stop = np.array([terms], np.int32) if ends is None else unpack(ends, np.int32)
        value = np.zeros(1, np.int64) if ends is None else unpack(counts, np.int64)
        columns.append((source, side, stop, shares(value, total) if terms else value))
    out = []
    for x, (a, a_side, a_ends, p) in enumerate(columns):
        for b, b_side, b_ends, q in columns[x + 1:]:
            if a_side == b_side != 2:
                continue
            ends = np.union1d(a_ends, b_ends)
            lengths = np.diff(ends, prepend=0).astype(np.int64)
            pa_, qa = p[np.searchsorted(a_ends, ends)], q[np.searchsorted(b_ends, ends)]
            square = (pa_ - qa) ** 2
            out.append((a, b, int((square // qa * lengths).sum()) if lengths.any() else 0))
            out.append((b, a, int((square // pa_ * lengths).sum()) if lengths.any() else 0))
    sources, items, values = zip(*out) if out else ((), (), ())
    return pa.table({"lang": pa.array([t.column("lang")[0].as_py()] * len(out), pa.string()),
                     "source": pa.array(sources, pa.string()), "item": pa.array(items, pa.string()),
                     "value": pa.array(values, pa.int64())})


def source_divergence(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                      min_docs: int = 3, top: int = 200, block_terms: int = BLOCK_TERMS,
                      block_cells: int = BLOCK_CELLS, tile: int = TILE) -> DataFrame:
    """lang, source, part, item, value, rank: how far each (language, source) group departs
    from the other sources of its language and from the language itself.

    Terms are runs of ASCII letters (A-Z lower-cased) and characters from U+0080; a language keeps
    those in at least ``min_docs`` of its rows.  p = 1 + floor(SCALE * (count + 1) / (N + V)) with
    N the counts' sum over the V kept terms; f = floor((p - q)**2 / q), p the group's.
    Part ``pair``: item is another source, q its shares, value the sum of f over all kept
    terms (0 if there are none).  Part ``term``: item is a kept term that occurs in the group
    with p above the language's q, value its f, the first ``top`` ranks.  Ranks run from 1 by
    falling value, ties by item in UTF-8 order.

    Null text, language and source count as empty; a group without terms has rows as well.
    Repeated rows count as rows of their own, an empty table gives an empty result, other
    columns are not read."""
    counts = stored(term_counts(docs, text_col, lang_col, source_col), "divergence-counts")
    cell = F.struct("source", "n")
    kept = stored(counts.where("term <> ''").groupBy("lang", "term").agg(
        F.sum("docs").alias("docs"), F.sum("n").alias("total"), F.array_sort(F.collect_list(cell)).alias("entries"))
        .where(F.col("docs") >= min_docs).drop("docs"), "divergence-kept")
    cells = kept.select("lang", "term", "total", F.explode("entries").alias("e")).select(
        "lang", "term", "total", "e.source", "e.n")
    # every group that occurs, numbered within its language, with the sums its shares need
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("v"), F.sum("total").alias("lang_n"))
    sums = cells.groupBy("lang", "source").agg(F.sum("n").alias("group_n"))
    v, group_n, lang_n = (F.coalesce(c, F.lit(0)).cast("long") for c in ("v", "group_n", "lang_n"))
    groups = stored(
        counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        .select("lang", "source", (group_n + v).alias("total"), (lang_n + v).alias("lang_total"),
                (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).alias("number")), "divergence-groups")

    # the vocabulary in the order of its counts; ranges are cut by a short key, of which Spark
    # samples at most a million rows, and the term's hash splits long rows of equal counts
    def cell_of(i):
        return F.try_element_at("entries", F.lit(i))

    ordered = kept.repartitionByRange(
        "lang", F.size("entries"), cell_of(1), cell_of(2), F.xxhash64("term")).sortWithinPartitions("lang", F.size("entries"), "entries")
    columns = stored(ordered.select("lang", "entries").mapInArrow(_columns(block_terms, block_cells), _COLUMN),
                     "divergence-columns")
    empty = groups.select("lang").distinct().select("lang", F.lit(-1).cast("long").alias("block"),
                                                    F.lit(0).cast("long").alias("terms"))
    blocks = columns.where("source IS NULL").select("lang", "block", "terms").unionByName(empty)
    last = groups.groupBy("lang").agg(F.max("number").alias("last"))
    mine, other = F.floor(F.col("number") / tile), F.col("other")
    # a column goes once to each pair of tiles that its tile is in
    dealt = blocks.join(groups.join(last, "lang"), "lang").join(
        columns.where("source IS NOT NULL").drop("terms"), ["lang", "block", "source"], "left").withColumn(
        "other", F.explode(F.sequence(F.lit(0).cast("long"), F.floor(F.col("last") / tile)))).select(
        "lang", "block", "source", "terms", "total", "ends", "counts", F.least(mine, other).alias("x"),
        F.greatest(mine, other).alias("y"), F.when(mine == other, 2).when(mine < other, 0).otherwise(1).alias("side"))
    pairs = dealt.groupBy("lang", "block", "x", "y").applyInArrow(
        _tile, "lang string, source string, item string, value long").groupBy("lang", "source", "item").agg(
        F.sum("value").alias("value"))

    def share(count: str, total: str) -> str:
        return f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({count} + 1 AS DECIMAL(19, 0)) div {total}"

    terms = cells.join(groups.select("lang", "source", F.col("total").alias("group_total"), "lang_total"), ["lang", "source"])
    terms = terms.selectExpr("lang", "source", "term AS item", f"{share('n', 'group_total')} AS p",
                             f"{share('total', 'lang_total')} AS q").where("p > q")
    terms = terms.selectExpr("lang", "source", "item", "(p - q) * (p - q) div q AS value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = ["lang", "source", "part", "item", "value", "rank"]
    return pairs.withColumn("part", F.lit("pair")).withColumn("rank", rank).select(out).unionByName(
        terms.withColumn("part", F.lit("term")).withColumn("rank", rank).where(F.col("rank") <= top).select(out))
