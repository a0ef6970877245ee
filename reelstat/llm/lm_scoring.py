"""Language-model scores by deleted interpolation (Jelinek and Mercer).

The model mixes maximum-likelihood n-gram estimates of all orders and a uniform
floor.  The mixture weights depend on how often the token's context was seen
(buckets of powers of two) and are learned by expectation-maximisation on
held-out counts: the training documents of one *deleted* fold, whose n-grams are
looked up in the counts of all other folds.  Final scores use the counts of all
training documents with the learned weights.

Counting is ask and answer (see ``common``).  A task packs its documents into
chunks of token codes; each chunk sends its distinct n-grams (62-bit keys, with
how often its own training documents hold them) to hash buckets; a bucket adds
the requests up and answers every chunk with the corpus counts in request order.
Keys and counts travel as packed arrays: about one request for each distinct n-gram
of a chunk, however hot it is.  Two different n-grams share a key with probability
n**2 / 2**63 for n distinct n-grams: nil at 1e8, and a handful at 1e10.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import (CHUNK_BYTES, buckets_for, chunked, pack, spans, stored, text_of,
                                 unpack)

#: Requested n-gram keys that a bucket merges in one task.
BUCKET_KEYS = 2_000_000
#: Width of a cell of the held-out histogram, in nats; both likelihood ratios of an
#: event are rounded to it, which bounds the histogram by
#: (context buckets) x (ratio cells) ** order whatever the corpus holds.
CELL = 0.1
ROUNDS = 200

ENCODED = ("chunk long, part string, doc_ids array<long>, trains array<boolean>, sizes binary, "
           "codes binary, vocab binary")
ASK = "bucket long, chunk long, part string, keys binary, train binary"
ANSWER = "chunk long, bucket long, part string, train binary, tuned binary, words long, kept_words long"
SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "boolean": pa.bool_(),
             "double": pa.float64(), "array<long>": pa.list_(pa.int64()), "array<boolean>": pa.list_(pa.bool_())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split(" ", 1) for f in ddl.split(", "))])


def _encode(batches):
    """Text rows -> per chunk: token codes of its documents, each ended by the end token."""
    for chunk, t in chunked(batches, CHUNK_BYTES):
        for part in ("tune", "rest"):
            own = t.filter(pc.equal(t.column("part"), part)).combine_chunks()
            if not own.num_rows:
                continue
            lowered = pc.ascii_lower(own.column("text").combine_chunks().cast(pa.large_string()))
            lists = pc.ascii_split_whitespace(lowered)
            words = lists.flatten()
            owner = np.repeat(np.arange(own.num_rows), pc.list_value_length(lists).to_numpy())
            full = pc.not_equal(pc.binary_length(words), 0)          # ends of a text may give empty ones
            owner, words = owner[full.to_numpy(zero_copy_only=False)], words.filter(full)
            coded = words.dictionary_encode()
            vocab = np.array([xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
            counts = np.bincount(owner, minlength=own.num_rows)
            ends = np.cumsum(counts)
            codes = np.insert(coded.indices.to_numpy().astype(np.int32) + 1, ends, 0)   # code 0: the end
            yield pa.RecordBatch.from_pydict({
                "chunk": [chunk * 2 + (part == "tune")], "part": [part],
                "doc_ids": [own.column("doc_id").to_pylist()], "trains": [own.column("train").to_pylist()],
                "sizes": [pack((counts + 1).astype(np.int64))], "codes": [pack(codes)],
                "vocab": [pack(np.concatenate([[np.uint64(0)], vocab]).astype(np.uint64))]},
                schema=_schema(ENCODED))


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """64-bit hash of two 64-bit values (the finaliser of splitmix64)."""
    x = a * np.uint64(0x9E3779B97F4A7C15) + b
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _keys(row: dict, order: int) -> list[np.ndarray]:
    """For every token: the key of its word, then of its 2-gram and of that one's
    context, and so on; the lowest bit tells words from all others.  Positions
    before a document count as end tokens."""
    codes, sizes = unpack(row["codes"], np.int32), unpack(row["sizes"], np.int64)
    word = _mixed(unpack(row["vocab"], np.uint64), np.uint64(1))[codes]
    place = np.arange(len(codes)) - np.repeat(spans(sizes)[:-1], sizes)
    end = _mixed(np.array([0], np.uint64), np.uint64(1))
    keys, context = [word & ~np.uint64(1)], np.zeros(len(codes), np.uint64)
    for n in range(1, order):
        before = np.where(place >= n, np.concatenate([np.repeat(end, min(n, len(word))), word[:-n]]), end)
        context = _mixed(context, before)
        for salt, key in ((2, _mixed(context, word)), (3, context)):
            keys.append(_mixed(key, np.uint64(salt + 2 * n)) | np.uint64(1))
    return keys


def _ask(order: int, buckets: int):
    shift = np.uint64(64 - (buckets.bit_length() - 1))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                keys = _keys(row, order)[::-1]
                trains = np.repeat(np.array(row["trains"], bool), unpack(row["sizes"], np.int64))
                sets, counts = [], []
                while keys:
                    distinct, inverse = np.unique(keys.pop(), return_inverse=True)
                    sets.append(distinct)
                    counts.append(np.bincount(inverse, weights=trains, minlength=len(distinct)).astype(np.uint32))
                distinct, counts = np.concatenate(sets), np.concatenate(counts)
                by = np.argsort(distinct, kind="stable")
                distinct, counts = distinct[by], counts[by]
                cuts = np.searchsorted(distinct >> shift, np.arange(buckets + 1, dtype=np.uint64))
                rows = [{"bucket": b, "chunk": row["chunk"], "part": row["part"],
                         "keys": pack(np.diff(distinct[x:y], prepend=np.uint64(0))), "train": pack(counts[x:y])}
                        for b, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
                yield pa.RecordBatch.from_pylist(rows, schema=_schema(ASK))
    return run


def _merge(asked: pa.Table) -> pa.Table:
    """Add up a bucket's requests; answer each chunk in the order of its keys."""
    rows = asked.to_pylist()
    keys = [np.cumsum(unpack(r["keys"], np.uint64), dtype=np.uint64) for r in rows]
    train = [unpack(r["train"], np.uint32) for r in rows]
    distinct, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    tune = np.repeat([r["part"] == "tune" for r in rows], [len(k) for k in keys])
    flat = np.concatenate(train)
    all_count = np.bincount(inverse, weights=flat, minlength=len(distinct)).astype(np.uint64)
    tuned = np.bincount(inverse, weights=flat * tune, minlength=len(distinct)).astype(np.uint64)
    word = distinct & np.uint64(1) == 0
    out, at = [{"chunk": -1, "bucket": rows[0]["bucket"], "words": int((word & (all_count > 0)).sum()),
                "kept_words": int((word & (all_count > tuned)).sum())}], 0
    for r, k in zip(rows, keys):
        own, at = inverse[at:at + len(k)], at + len(k)
        out.append({"chunk": r["chunk"], "bucket": r["bucket"], "part": r["part"], "train": pack(all_count[own]),
                    "tuned": pack(tuned[own]) if r["part"] == "tune" else None})
    return pa.Table.from_pylist(out, schema=_schema(ANSWER))


def _looked_up(row: dict, answers: pa.Table, order: int, retained: bool) -> list[tuple[np.ndarray, np.ndarray]]:
    """Corpus counts (of all training documents, or without the deleted fold) of the
    distinct entries of every ``_keys`` array, and each token's place among them."""
    by = sorted(answers.to_pylist(), key=lambda r: r["bucket"])
    counts = np.concatenate([unpack(r["train"], np.uint64) for r in by])
    if retained:
        counts = counts - np.concatenate([unpack(r["tuned"], np.uint64) for r in by])
    keys, sets = _keys(row, order)[::-1], []
    while keys:
        distinct, inverse = np.unique(keys.pop(), return_inverse=True)
        sets.append((distinct, inverse.astype(np.int32)))
    rank = np.empty(len(counts), np.int64)
    rank[np.argsort(np.concatenate([s for s, _ in sets]), kind="stable")] = np.arange(len(counts))
    out, at = [], 0
    for distinct, inverse in sets:
        out.append((counts[rank[at:at + len(distinct)]].astype(np.float64), inverse))
        at += len(distinct)
    return out


def _slices(looked_up: list[tuple[np.ndarray, np.ndarray]], size: int = 1 << 19):
    """(start, end, counts of every array) for runs of tokens, so that the arrays of
    estimates stay small."""
    total = len(looked_up[0][1])
    for a in range(0, total, size):
        yield a, min(total, a + size), [values[inverse[a:a + size]] for values, inverse in looked_up]


def _estimates(counts: list[np.ndarray], tokens: float) -> tuple[np.ndarray, np.ndarray]:
    """Maximum-likelihood estimates of all orders (an unseen context gives 0), and the
    context bucket: the longest seen context's order and the power of two of its count."""
    p = [counts[0] / max(tokens, 1.0)]
    bucket = np.zeros(len(p[0]), np.int64)
    for n, (gram, context) in enumerate(zip(counts[1::2], counts[2::2]), start=1):
        p.append(np.divide(gram, context, out=np.zeros_like(gram), where=context > 0))
        bucket = np.where(context > 0, 64 * n + np.log2(np.maximum(context, 1)).astype(np.int64), bucket)
    return np.stack(p), bucket


def _histogram(order: int, tokens: float, floor: float):
    """Held-out events of the deleted fold, counted by context bucket and by the
    rounded logarithms of every order's likelihood over the uniform floor."""

    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        names = ["bucket", *(f"r{n}" for n in range(order)), "events"]
        if not state.num_rows or not answers.num_rows:
            return pa.schema([(x, pa.int64()) for x in names]).empty_table()
        parts = []
        for _, _, counts in _slices(_looked_up(state.to_pylist()[0], answers, order, True)):
            p, bucket = _estimates(counts, tokens)
            with np.errstate(divide="ignore"):
                cells = np.where(p > 0, np.round(np.log(p / floor) / CELL), -1_000_000).astype(np.int64)
            parts.append(np.column_stack(np.unique(np.concatenate([bucket[None], cells]).T, axis=0, return_counts=True)))
        return pa.table([*map(pa.array, np.concatenate(parts).T)], names=names)
    return run


def _weights(cells: np.ndarray, order: int) -> dict[int, np.ndarray]:
    """Expectation-maximisation of one weight vector (floor, order 1, 2, ...) per
    context bucket, from the histogram's rows."""
    start, out = np.full(order + 1, 1.0 / (order + 1)), {}
    for bucket in np.unique(cells[:, 0]):
        own = cells[cells[:, 0] == bucket]
        ratio = np.where(own[:, 1:-1] <= -1_000_000, 0.0, np.exp(np.maximum(own[:, 1:-1], -10_000) * CELL))
        like, n, w = np.column_stack([np.ones(len(own)), ratio]), own[:, -1].astype(float), start
        for _ in range(ROUNDS):
            share = like * w
            new = (n[:, None] * share / share.sum(axis=1, keepdims=True)).sum(axis=0) / n.sum()
            if np.abs(new - w).max() < 1e-9:
                break
            w = new
        # some floor always remains, so that no text has probability zero
        out[int(bucket)] = (w + 1e-6 * start) / (1 + 1e-6)
    return out


def _score(order: int, tokens: int, words: int, weights: dict[int, np.ndarray]):
    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        if not state.num_rows:
            return _schema(SCORED).empty_table()
        # buckets that the held-out fold never met take the weights of the nearest one it met
        table = np.tile(np.full(order + 1, 1.0 / (order + 1)), (64 * order + 64, 1))
        for b in range(len(table)):
            near = min(weights, key=lambda k: (k // 64 != b // 64, abs(k - b)), default=None)
            if near is not None:
                table[b] = weights[near]
        row = state.to_pylist()[0]
        sizes = unpack(row["sizes"], np.int64)
        base, score, known = np.empty(sizes.sum()), np.empty(sizes.sum()), np.empty(sizes.sum(), bool)
        for a, b, counts in _slices(_looked_up(row, answers, order, False)):
            p, bucket = _estimates(counts, float(tokens))
            mix = table[bucket].T
            like = mix[0] / (words + 1) + (mix[1:] * p).sum(axis=0)
            # where the longest context is unseen, what its order would get goes to the rest
            seen = np.stack([np.ones(b - a, bool), np.full(b - a, tokens > 0), *(c > 0 for c in counts[2::2])])
            score[a:b] = np.log10(like / (mix * seen).sum(axis=0))
            base[a:b] = np.log10((counts[0] + 1) / (tokens + words + 1))
            known[a:b] = counts[0] > 0
        add = lambda x: np.add.reduceat(x, spans(sizes)[:-1])
        return pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array([not x for x in row["trains"]]),
            "n_tokens": pa.array(sizes), "n_known": pa.array(add(known.astype(np.int64))),
            "base_score": pa.array(add(base)), "score": pa.array(add(score))})
    return run


def lm_scores(docs: DataFrame, train: Column, fold: Column, id_col: str = "doc_id", text_col: str = "text",
              order: int = 2) -> DataFrame:
    """Score every document under a model learned from the rows where ``train`` holds.

    ``fold`` marks those training rows whose counts are held out to learn the
    mixture weights (they count like all others in the final model).  Returns
    doc_id, held_out, n_tokens, n_known, base_score (add-one unigram), score (both
    log10 probabilities of the whole text and its end), train_tokens and
    train_words (the distinct ones).

    Null or empty text is one end token.  A null in ``train`` or ``fold`` counts as
    false.  Without training rows every token is unknown and both scores are those
    of the uniform floor; without a held-out fold all orders weigh the same.
    Repeated rows are scored (and counted) each.  An empty table gives an empty
    result.  Other columns are not read.
    """
    spark = docs.sparkSession
    trains = F.coalesce(train, F.lit(False))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"),
                       trains.alias("train"),
                       F.when(trains & F.coalesce(fold, F.lit(False)), "tune").otherwise("rest").alias("part"))
    encoded = stored(rows.mapInArrow(_encode, ENCODED), "lm-encoded")
    sums = {r["part"]: r for r in encoded.select("part", "trains", "sizes", "vocab").mapInArrow(
        _totals, "part string, tokens long, train_tokens long").groupBy("part").agg(
        F.sum("tokens").alias("tokens"), F.sum("train_tokens").alias("train")).collect()}
    tokens = sum(r["train"] for r in sums.values())
    kept_tokens = sums["rest"]["train"] if "rest" in sums else 0
    buckets = buckets_for(order * sum(r["tokens"] for r in sums.values()), BUCKET_KEYS)
    answers = stored(encoded.mapInArrow(_ask(order, buckets), ASK).groupBy("bucket").applyInArrow(_merge, ANSWER),
                     "lm-answers")
    words, kept_words = answers.where("chunk = -1").agg(
        F.coalesce(F.sum("words"), F.lit(0)), F.coalesce(F.sum("kept_words"), F.lit(0))).first()

    def with_answers(part: Column) -> DataFrame:
        return encoded.where(part).groupBy("chunk").cogroup(answers.where(part & (F.col("chunk") >= 0)).groupBy("chunk"))

    cells = ", ".join(["bucket long", *(f"r{n} long" for n in range(order)), "events long"])
    keys = cells.replace(" long", "").split(", ")[:-1]
    histogram = with_answers(F.col("part") == "tune").applyInArrow(
        _histogram(order, float(kept_tokens), 1.0 / (kept_words + 1)), cells).groupBy(*keys).agg(
        F.sum("events").alias("events")).collect()          # bounded by CELL, see there
    weights = _weights(np.array([tuple(r) for r in histogram], np.int64), order) if histogram else {}
    return with_answers(F.lit(True)).applyInArrow(_score(order, tokens, words, weights), SCORED).select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"),
        F.lit(words).cast("long").alias("train_words"), "base_score", "score")


def _totals(batches):
    for batch in batches:
        for row in batch.to_pylist():
            sizes = unpack(row["sizes"], np.int64)
            yield pa.RecordBatch.from_pydict({"part": [row["part"]], "tokens": [int(sizes.sum())],
                                              "train_tokens": [int(sizes[np.array(row["trains"], bool)].sum())]})
