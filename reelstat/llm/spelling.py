"""Spelling variants by permuterm rotations.

Every word is marked with a terminator and rotated to every place; the rotation ``b$a``
belongs to the word ``ab``.  The words one edit away from ``a?b`` begin, as rotations, with
``b$a``: the word ``ab`` itself (the edited character is missing) and all words ``axb``, whose
rotation ``b$ax`` goes on with the edited character alone.  So all rotations are sorted by the
prefix that skips the edited character, and a run of equal prefixes is the range of one edit:
its words of one character more replace each other, and each of them is an insertion into the
word that ends at the prefix.

A run is scanned once and tells every member how many neighbours it has there and which is
the most frequent; pairs are never listed.  A run holds at most one word for each character
and one more, so no run is hot, however frequent its words are: words enter as counts.

Where one of several equal characters in a row is deleted, the same pair stands in several
runs; only the first of such a row counts.  All steps are built-in functions, one sort by
prefix and one sum by word, both of the vocabulary's size; the counts before are combined in
the map tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import stored, text_of

#: Ends a word in its rotations.
TERMINATOR = "\x00"
#: Letters of a word: ASCII and U+00C0 to U+00FF.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def without_character(word: Column, place: Column) -> Column:
    """The word less its code point at ``place`` (from 0)."""
    return F.concat(F.substring(word, F.lit(1), place), F.substring(word, place + 2, F.length(word)))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", drop_one_in: int = 199,
                min_length: int = 6, min_count: int = 5) -> DataFrame:
    """word, n: the lower-cased (A-Z) runs of letters with at least ``min_length`` code points
    and ``min_count`` occurrences over all texts.

    Of runs whose crc32 of ``<id>:<run>`` is a multiple of ``drop_one_in`` the code point at
    crc32 modulo length is deleted first (0: none are).  Null text has no words, a null id
    counts as empty, repeated rows count again, an empty table has no words."""
    key = F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.lit(":"), F.col("__run"))
    runs = docs.select(id_col, F.explode(F.regexp_extract_all(text_of(text_col), F.lit(RUN), F.lit(0))).alias("__run"))
    runs = runs.where(F.length("__run") >= min_length).withColumn("__run", F.translate("__run", UPPER, LOWER))
    if drop_one_in:
        hashed = runs.select("__run", F.crc32(key.cast("binary")).alias("__h"))
        place = (F.col("__h") % F.length("__run")).cast("int")
        runs = hashed.select(F.when(F.col("__h") % drop_one_in == 0, without_character(F.col("__run"), place))
                             .otherwise(F.col("__run")).alias("__run")).where(F.length("__run") >= min_length)
    return runs.groupBy(F.col("__run").alias("word")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_count)


def rotations(words: DataFrame) -> DataFrame:
    """prefix, skipped, first, word, n: each rotation of the marked word as a prefix that
    ends a word (skipped false) and, less its last character, as a prefix that skips an edited
    one.  ``first``: the skipped character differs from the one before it."""
    w, at = F.col("word"), F.col("at")

    def rotated(start: Column) -> Column:
        return F.concat(F.substring(w, start, F.length(w)), F.lit(TERMINATOR), F.substring(w, F.lit(1), at))

    whole = words.withColumn("at", F.explode(F.sequence(F.lit(0), F.length(w)))).select(
        rotated(at + 1).alias("prefix"), F.lit(False).alias("skipped"), F.lit(False).alias("first"), "word", "n")
    letters = words.where(F.length(w) > 0).withColumn("at", F.explode(F.sequence(F.lit(0), F.length(w) - 1)))
    new = (at == 0) | (F.substring(w, at, F.lit(1)) != F.substring(w, at + 1, F.lit(1)))
    return whole.unionByName(letters.select(
        rotated(at + 2).alias("prefix"), F.lit(True).alias("skipped"), new.alias("first"), "word", "n"))


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near, near, near_n for the words with a neighbour: how many words differ by one
    inserted, deleted or replaced code point, and the most frequent of them (ties: smallest)."""
    run = Window.partitionBy("prefix").orderBy(F.desc("n"), "word").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    me = F.struct((-F.col("n")).alias("m"), F.col("word").alias("w"))
    skipped, first = F.when(F.col("skipped"), me), F.when(F.col("first"), me)
    scanned = rotations(words).select(
        "word", "skipped", "first",
        F.count(skipped).over(run).alias("others"), F.count(first).over(run).alias("firsts"),
        F.first(skipped, ignorenulls=True).over(run).alias("best"),
        F.nth_value(skipped, 2, ignoreNulls=True).over(run).alias("second"),
        F.first(first, ignorenulls=True).over(run).alias("longer"),
        F.first(F.when(~F.col("skipped"), me), ignorenulls=True).over(run).alias("shorter"))
    replaced = F.when(F.col("best.w") == F.col("word"), F.col("second")).otherwise(F.col("best"))
    shorter = F.when(F.col("first"), F.col("shorter"))
    told = scanned.select(
        "word",
        F.when(F.col("skipped"), F.col("others") - 1 + shorter.isNotNull().cast("long")).otherwise(F.col("firsts")).alias("near"),
        # the smaller of (-n, word); null only where there is none
        F.when(F.col("skipped"), F.least(replaced, shorter)).otherwise(F.col("longer")).alias("with"))
    return told.where("near > 0").groupBy("word").agg(F.sum("near").alias("n_near"), F.min("with").alias("with")).select(
        "word", "n_near", F.col("with.w").alias("near"), (-F.col("with.m")).alias("near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): every round doubles the steps taken."""
    links = stored(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        up = links.select(F.col("word").alias("root"), F.col("root").alias("above"))
        new = stored(links.join(up, "root", "left").select(
            "word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "spelling-roots")
        links = new.select("word", "root")
        if not new.where("moved").limit(1).count():
            return links


def spelling_variants(words: DataFrame, ratio: int = 5) -> DataFrame:
    """word, form, root, n, n_near, form_n, one row for each distinct word of (word, n).

    n_near counts the words one edit away.  A word's form is its most frequent such word
    (ties: smallest in code-point order) if that occurs at least ``ratio`` (over 1) times as often,
    else null; root follows the forms to the last (the word itself if it has none).
    Counts of repeated words are added up.  A null word and a word that holds U+0000 have
    no neighbours; a null count is 0.  An empty table gives an empty result; other columns
    are not read."""
    if ratio <= 1:
        raise ValueError("ratio must be over 1, else forms may run in circles")
    words = stored(words.groupBy("word").agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n")), "spelling-words")
    searched = words.where(F.col("word").isNotNull() & ~F.col("word").contains(TERMINATOR))
    found = words.join(near_words(searched), "word", "left")
    formed = F.col("near_n") >= ratio * F.col("n")
    found = stored(found.select(
        "word", F.when(formed, F.col("near")).alias("form"), "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(formed, F.col("near_n")).alias("form_n")), "spelling-found")
    roots = _roots(found.where("form IS NOT NULL"))
    return found.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
