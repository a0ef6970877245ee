"""Token counts of whole texts without materialising ids.

A pre-token always becomes the same pieces, so its pieces are counted once in the
whole corpus.  A chunk of documents is turned into sparse frequencies (document,
pre-token code, how often) and its distinct pre-tokens; these go to hash buckets,
a bucket counts the pieces of its distinct pre-tokens once and answers every chunk;
a chunk's frequencies times the answered counts, summed, give its documents' counts
(ask and answer, see ``common``).
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelstat.llm import tokenizing
from reelstat.llm.common import CHUNK_BYTES, buckets_for, chunked, pack, spans, stored, text_of, unpack

#: Pre-token requests that a bucket merges in one task.
BUCKET_WORDS = 500_000
#: (document, pre-token) entries that are gathered before they are packed as codes.
BATCH_ENTRIES = 400_000

CODED = ("chunk long, doc_ids array<long>, bytes binary, specials binary, sizes binary, codes binary, "
         "times binary, words binary, lengths binary, n_words long")
ASK = "bucket long, chunk long, places binary, words binary, lengths binary"
ANSWER = "chunk long, places binary, pieces binary"
COUNTED = "doc_id long, n_bytes long, n_tokens long"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ", 1) for f in ddl.split(", "))])


def _frequencies(tokenizer: str):
    """Text rows -> per chunk: its distinct pre-tokens and every document's frequencies."""

    def run(batches):
        for chunk, t in chunked(batches, CHUNK_BYTES):
            sizes, times, specials, lengths, words, parts = [], [], [], [], [], []

            def flush():
                parts.append(pa.array(words, pa.large_string()).dictionary_encode())
                words.clear()

            for i in range(t.num_rows):
                text = t.column("text")[i].as_py()
                found, special = tokenizing.pretokens(text, tokenizer)
                counts = Counter(found)
                words.extend(counts.keys())
                times.append(np.fromiter(counts.values(), np.uint32, len(counts)))
                sizes.append(len(counts))
                specials.append(special)
                lengths.append(len(text) if text.isascii() else len(text.encode()))
                if len(words) >= BATCH_ENTRIES:
                    flush()
            flush()
            merged = pa.chunked_array(parts).unify_dictionaries()
            vocab = merged.chunk(0).dictionary
            codes = np.concatenate([c.indices.to_numpy() for c in merged.chunks]).astype(np.int64)
            # frequent pre-tokens get small codes; a document's codes ascend, as differences
            rank = np.empty(len(vocab), np.int64)
            by = np.argsort(-np.bincount(codes, minlength=len(vocab)), kind="stable")
            rank[by] = np.arange(len(vocab))
            owner = np.repeat(np.arange(len(sizes)), sizes)
            order = np.lexsort((codes := rank[codes], owner))
            codes, times = codes[order], np.concatenate(times)[order]
            steps = np.diff(codes, prepend=0)
            first = spans(np.array(sizes))[:-1][np.array(sizes) > 0]
            steps[first] = codes[first]
            encoded = [w.encode() for w in vocab.take(pa.array(by)).to_pylist()]
            yield pa.RecordBatch.from_pydict({
                "chunk": [chunk], "doc_ids": [t.column("doc_id").to_pylist()], "bytes": [pack(np.array(lengths, np.int64))],
                "specials": [pack(np.array(specials, np.int64))], "sizes": [pack(np.array(sizes, np.int64))],
                "codes": [pack(steps.astype(np.uint32))], "times": [pack(times)],
                "words": [zstandard.compress(b"".join(encoded), 1)],
                "lengths": [pack(np.array([len(w) for w in encoded], np.uint32))], "n_words": [len(encoded)]},
                schema=_schema(CODED))
    return run


def _ask(buckets: int):
    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                data, cuts = zstandard.decompress(row["words"]), spans(unpack(row["lengths"], np.uint32))
                words = [data[a:b] for a, b in zip(cuts, cuts[1:])]
                where = np.fromiter((xxhash.xxh3_64_intdigest(w) & (buckets - 1) for w in words), np.int64, len(words))
                order = np.argsort(where, kind="stable")
                out = []
                for places in np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if len(words) else []:
                    own = [words[i] for i in places]
                    out.append({"bucket": int(where[places[0]]), "chunk": row["chunk"],
                                "places": pack(np.diff(places, prepend=0).astype(np.uint32)),
                                "words": zstandard.compress(b"".join(own), 1),
                                "lengths": pack(np.array([len(w) for w in own], np.uint32))})
                yield pa.RecordBatch.from_pylist(out, schema=_schema(ASK))
    return run


def _count_once(tokenizer: str):
    """The pieces of a bucket's distinct pre-tokens, each counted once."""

    def run(asked: pa.Table) -> pa.Table:
        index: dict[bytes, int] = {}
        rows = []
        for r in asked.to_pylist():
            data, cuts = zstandard.decompress(r["words"]), spans(unpack(r["lengths"], np.uint32))
            rows.append((r["chunk"], r["places"], np.fromiter(
                (index.setdefault(data[a:b], len(index)) for a, b in zip(cuts, cuts[1:])), np.int64, len(cuts) - 1)))
        words, pieces = list(index), []
        for at in range(0, len(words), 50_000):
            pieces.append(tokenizing.piece_counts([w.decode() for w in words[at:at + 50_000]], tokenizer))
        pieces = np.concatenate(pieces) if pieces else np.zeros(0, np.int64)
        return pa.Table.from_pylist([{"chunk": c, "places": p, "pieces": pack(pieces[own])} for c, p, own in rows],
                                    schema=_schema(ANSWER))
    return run


def _sums(coded: pa.Table, answers: pa.Table) -> pa.Table:
    if not coded.num_rows:
        return _schema(COUNTED).empty_table()
    row = coded.to_pylist()[0]
    pieces = np.zeros(row["n_words"], np.int64)
    for places, got in zip(answers.column("places").to_pylist(), answers.column("pieces").to_pylist()):
        pieces[np.cumsum(unpack(places, np.uint32), dtype=np.int64)] = unpack(got, np.int64)
    sizes, steps = unpack(row["sizes"], np.int64), unpack(row["codes"], np.uint32).astype(np.int64)
    total = np.cumsum(steps)
    starts = spans(sizes)[:-1]
    before = np.repeat(np.where(starts > 0, total[np.maximum(starts, 1) - 1], 0) if len(total) else starts, sizes)
    values = spans(pieces[total - before] * unpack(row["times"], np.uint32))
    counts = values[starts + sizes] - values[starts] + unpack(row["specials"], np.int64)
    return pa.table({"doc_id": pa.array(row["doc_ids"], pa.int64()), "n_bytes": unpack(row["bytes"], np.int64),
                     "n_tokens": counts})


def token_counts(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > ``limit``) of every whole text.

    ``tokenizer`` names a byte-level BPE file of the tokenizers library.  No begin,
    end or added special tokens; special strings inside a text count as the
    library's default has it.  Null text counts as empty (no tokens), a null doc_id
    stays null, repeated rows give repeated results, an empty table gives an empty
    result, other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    coded = stored(rows.mapInArrow(_frequencies(tokenizer), CODED), "token_counts")
    asked = coded.agg(F.sum("n_words")).first()[0] or 0
    answers = coded.select("chunk", "words", "lengths").mapInArrow(
        _ask(buckets_for(asked, BUCKET_WORDS)), ASK).groupBy("bucket").applyInArrow(_count_once(tokenizer), ANSWER)
    counted = coded.drop("words", "lengths").groupBy("chunk").cogroup(answers.groupBy("chunk"))
    return counted.applyInArrow(_sums, COUNTED).withColumn("over_limit", F.col("n_tokens") > limit)
