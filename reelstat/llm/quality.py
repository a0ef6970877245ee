"""Quality rules and a hashed n-gram log-likelihood ratio, in DataFrame functions only.

Base rules count words, symbols, repeated lines and words in repeated windows.  The
method's verdict compares two multinomials over hashed n-grams: one of the trusted
documents, one of the whole corpus (all documents, whole texts).  A document's score is
the mean log ratio of its n-grams, and it is kept from a fixed threshold on.  The n-grams
are words, pairs of neighbouring words, and the last three characters of words, so
junk of unseen words still counts.

The multinomials have BUCKETS cells whatever the corpus holds: they are counted with
map-side aggregation and come back as one literal array, so scoring needs no shuffle.
Both count every row of theirs.  The trusted ids come to the texts as masks of 64
neighbouring ids, so texts stay where they are; ids so many or so scattered that there are more than
MASKS masks are joined without a broadcast instead, with the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reelstat.llm.common import SPACE, stored, text_of

#: Cells of the hashed multinomials, and the count added to each.
BUCKETS, SMOOTHING = 1 << 15, 1.0
#: Masks of trusted ids (16 bytes each) that are broadcast at most.
MASKS = 1 << 20
#: Least mean log ratio of a kept document.
THRESHOLD = -0.75
#: Words of the windows whose repetition is counted (two halves of two pairs of words).
WINDOW = 8


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE), lambda w: w != "")


def _cell(number: Column) -> Column:
    return F.pmod(number, F.lit(BUCKETS)).cast("int")


def _with_hashes(docs: DataFrame) -> DataFrame:
    """Adds hashes of each word, of each pair of words and of each word's ending."""
    docs = docs.withColumns({"h1": F.transform("words", lambda w: F.xxhash64(w)),
                             "endings": F.transform("words", lambda w: F.xxhash64(F.substring(w, -3, 3), F.lit(3)))})
    pairs = F.transform("h1", lambda h, i: F.xxhash64(h, F.get("h1", i + 1)))
    return docs.withColumn("h2", F.slice(pairs, 1, F.greatest(F.size("h1") - 1, F.lit(0))))


def with_ngrams(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds the cells of all n-grams."""
    hashed = _with_hashes(docs.withColumn("words", _words(text_of(text_col))))
    cells = F.concat(*[F.transform(c, _cell) for c in ("h1", "h2", "endings")])
    return hashed.withColumn("ngrams", cells).drop("words", "h1", "h2", "endings")


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> list[float]:
    """Log of trusted over corpus probability, one value per cell.

    ``trusted`` holds the ids of the trusted documents.  Without any (or without
    documents) all values are 0.  Rows with a null id are never trusted."""
    word, bit = F.shiftright("id", 6), F.expr("int(id & 63)")
    marks = stored(trusted.select(F.col(id_col).cast("long").alias("id")).where("id IS NOT NULL").groupBy(
        word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("mask")), "quality-trusted")
    few = marks.count() <= MASKS
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).withColumn("word", word).join(
        F.broadcast(marks) if few else marks.hint("merge"), "word", "left").withColumn(
        "trusted", F.when(F.call_function("shiftright", F.col("mask"), bit).bitwiseAND(F.lit(1)) == 1, 1))
    # outer: an inner explode would infer a filter that computes the n-grams once more
    hashed = _with_hashes(rows.withColumn("words", _words(text_of("text"))))
    cells = hashed.select("trusted", F.explode_outer(F.concat("h1", "h2", "endings")).alias("hash")).groupBy(
        _cell(F.col("hash")).alias("cell")).agg(
        F.count(F.lit(1)).alias("raw"), F.count("trusted").alias("good")).where("cell IS NOT NULL").collect()
    raw, good = np.zeros(BUCKETS), np.zeros(BUCKETS)        # at most BUCKETS rows came
    for r in cells:
        raw[r["cell"]], good[r["cell"]] = r["raw"], r["good"]
    if not good.sum():
        return [0.0] * BUCKETS
    share = lambda c: np.log((c + SMOOTHING) / (c.sum() + SMOOTHING * BUCKETS))
    return (share(good) - share(raw)).tolist()


def _repeat_words(docs: DataFrame) -> DataFrame:
    """Adds n_repeat_words: words in windows that occur twice or more, first ones
    included.  A window's 64-bit hash is made of those of its halves, and only where a
    half repeats is the whole looked at."""
    n = F.size("h1")
    wider = lambda c, step: F.transform(c, lambda h, i: F.xxhash64(h, F.get(c, i + step)))
    docs = docs.withColumn("h4", F.when(n >= WINDOW, F.slice(wider("h2", 2), 1, F.greatest(n - 3, F.lit(0)))))
    again = lambda c: F.size(F.array_distinct(c)) < F.size(c)
    docs = docs.withColumn("hashes", F.when(again("h4"), F.slice(wider("h4", 4), 1, F.greatest(n - (WINDOW - 1), F.lit(0)))))
    docs = docs.withColumn("ordered", F.when(again("hashes"), F.array_sort(F.transform(
        "hashes", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    same = lambda at, s: F.coalesce(F.get("ordered", at)["h"] == s["h"], F.lit(False))
    docs = docs.withColumn("places", F.array_sort(F.transform(F.filter(
        "ordered", lambda s, k: same(k - 1, s) | same(k + 1, s)), lambda s: s["i"])))
    covered = F.aggregate(
        "places", F.struct(F.lit(0).alias("total"), F.lit(-WINDOW).alias("last")),
        lambda a, p: F.struct((a["total"] + F.least(F.lit(WINDOW), p - a["last"])).alias("total"), p.alias("last")),
        lambda a: a["total"])
    return docs.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop(
        "h4", "hashes", "ordered", "places")


def quality_rules(docs: DataFrame, ratios: list[float], id_col: str = "doc_id", text_col: str = "text",
                  threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    mean_ratio and kept for every whole text.

    Null or empty text has no words, fails the base rules and has a mean ratio of 0.
    A null id stays null; repeated rows give repeated results; an empty table gives an
    empty result; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = _with_hashes(rows.withColumn("words", _words(F.col("text"))))
    lines = F.filter(F.split("text", "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    rows = _repeat_words(rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.char_length(F.regexp_replace("text", SPACE, "")).cast("long"),
        "n_symbols": F.char_length(F.regexp_replace("text", r"[^#*$%&|<>]+", "")).cast("long"),
        "lines": lines}))
    # one foldable literal: the table of cells is bounded by BUCKETS
    table = F.split(F.lit(",".join(f"{x:.6f}" for x in ratios)), ",").cast("array<double>")
    total = sum(F.aggregate(c, F.lit(0.0), lambda a, h: a + F.get(table, _cell(h))) for c in ("h1", "h2", "endings"))
    rows = rows.withColumns({
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "mean_ratio": F.when(F.col("n_words") > 0, total / (3 * F.col("n_words") - 1)).otherwise(0.0),
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))})
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                       "mean_ratio", (~F.col("base_failed") & (F.col("mean_ratio") >= threshold)).alias("kept"))
