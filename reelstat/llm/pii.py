"""Personal data by patterns and information-theoretic sanitisation, in DataFrame functions only.

Patterns find the protected entities (email, ip, card, phone).  Then corpus statistics
tell which terms reveal them: for a term t and an entity e, the pointwise mutual
information PMI(t, e) = log(p(t, e) / p(t) p(e)) is at most the entity's information
content IC(e) = -log p(e); their quotient is the share of e that t discloses.
Probabilities are frequencies of whole documents over the corpus, addresses left out.

What stands near an entity is evidence only: a term is tried if it stands within REACH
code points of the entity (on its line any term; on the lines around it terms that do not
begin with a small letter, as names do), and shares several different contexts with it.
Of a term that discloses at least THRESHOLD of an entity every occurrence is a span, in
every document that holds the entity; entities are generalised to their kind, such terms
removed.  Documents without an entity have no spans.

Java's matcher gives matches, and ``split`` by the same pattern the gaps between them, so
a match's place is a running sum of code points: the gaps and matches become rows and a
window adds them up, linear in the text however many matches a document has.  The
patterns are written so that a long run of one character class is scanned once: a match
starts at the end of the last one (``\\G``) or not inside a run, and repetitions are possessive.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reelstat.llm.common import stored, text_of

#: Kinds in their order among spans that start together; pattern and quick test.
KINDS = {
    "email": (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": (r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]"),
    # a maximal run of digits with single separators, of 14 to 19 digits
    "card": (r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])", r"[0-9](?:[\x20-]?[0-9]){13}"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
}
#: Code points before and after an entity that are its context.
REACH = 80
#: Different contexts that a term shares with an entity, and the share of the entity's
#: information that it must disclose.
SUPPORT, THRESHOLD = 3, 0.9
TERM = r"\p{L}{3,}+"


def _luhn(digits: Column) -> Column:
    back = F.reverse(digits)
    return F.aggregate(F.sequence(F.lit(1), F.char_length(digits)), F.lit(0), lambda total, i: total + _doubled(
        F.substring(back, i, F.lit(1)).cast("int"), i)) % 10 == 0


def _doubled(digit: Column, place: Column) -> Column:
    twice = digit * 2
    return F.when(place % 2 == 1, digit).when(twice > 9, twice - 9).otherwise(twice)


def _valid(kind: Column, match: Column) -> Column:
    digits = F.regexp_replace(match, "[^0-9]+", "")

    def byte(part: Column) -> Column:
        plain = F.regexp_replace(part, "^0+", "")
        return F.when(F.char_length(plain) > 3, False).otherwise(F.coalesce(plain.try_cast("int"), F.lit(0)) <= 255)

    return (F.when(kind == "email", True)
            .when(kind == "ip", F.forall(F.split(match, r"\."), byte))
            .when(kind == "card", _luhn(digits))
            .otherwise(F.char_length(digits).between(10, 15)))


def _before(gap: Column) -> Column:
    """The last REACH code points of a gap, from a whole word on."""
    near = F.right(gap, F.lit(REACH))
    return F.when(F.char_length(near) < REACH, near).otherwise(F.regexp_replace(near, r"^\p{L}+", ""))


def _after(gap: Column) -> Column:
    near = F.left(gap, F.lit(REACH))
    return F.when(F.char_length(near) < REACH, near).otherwise(F.regexp_replace(near, r"\p{L}+$", ""))


def _likely(kind: str) -> Column:
    test = KINDS[kind][1]
    return F.contains("text", F.lit(test)) if len(test) == 1 else F.col("text").rlike(test)


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """uid, doc_id and, where a match of any kind is likely, the text (else null): to be written,
    so that a uid means one document in all steps."""
    rows = docs.select(F.monotonically_increasing_id().alias("uid"), F.col(id_col).cast("long").alias("doc_id"),
                       text_of(text_col).alias("text"))
    return rows.withColumn("text", F.when(functools.reduce(Column.__or__, map(_likely, KINDS)), F.col("text")))


def matches(rows: DataFrame) -> DataFrame:
    """Rows of ``keyed`` -> a row for every match of every pattern (uid, doc_id, kind, n, lead:
    code points of the gap before it, match, left and right context), and one row without a
    kind for a document without any."""
    for kind, (pattern, _) in KINDS.items():
        rows = rows.withColumns({f"{kind}_likely": _likely(kind)})
        rows = rows.withColumns({
            f"{kind}_found": F.when(F.col(f"{kind}_likely"), F.regexp_extract_all("text", F.lit(pattern), F.lit(0))),
            f"{kind}_gaps": F.when(F.col(f"{kind}_likely"), F.split("text", pattern, -1))})

    def of(kind: str) -> Column:
        gaps = f"{kind}_gaps"
        return F.coalesce(F.transform(f"{kind}_found", lambda m, i: F.struct(
            F.lit(kind).alias("kind"), i.alias("n"), F.char_length(F.get(gaps, i)).cast("long").alias("lead"),
            m.alias("match"), _before(F.get(gaps, i)).alias("left"), _after(F.get(gaps, i + 1)).alias("right"))),
            F.array().cast("array<struct<kind:string,n:int,lead:long,match:string,left:string,right:string>>"))

    return rows.select("uid", "doc_id", F.explode_outer(F.concat(*map(of, KINDS))).alias("m")).select("uid", "doc_id", "m.*")


def base_spans(found: DataFrame) -> DataFrame:
    """Valid matches of ``matches`` with their places (code points, end exclusive)."""
    run = Window.partitionBy("uid", "kind").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.char_length("match").cast("long")
    return found.where("kind IS NOT NULL").withColumn("end", F.sum(F.col("lead") + size).over(run)).withColumn(
        "start", F.col("end") - size).where(_valid(F.col("kind"), F.col("match")))


def _found(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def _lowered(terms: Column) -> Column:
    return F.array_distinct(F.transform(terms, lambda t: F.lower(t)))


def _terms(text: Column) -> Column:
    """Distinct terms of a whole text; of the kinds only addresses have letters, and theirs are left out."""
    return _lowered(_found(F.when(F.contains(text, F.lit("@")), F.regexp_replace(text, KINDS["email"][0], " ")).otherwise(text)))


def _near() -> Column:
    """Terms of an entity's line within its context, and of the lines around it those
    that do not begin with a small letter."""
    line = F.concat(_found(F.substring_index("left", "\n", -1)), _found(F.substring_index("right", "\n", 1)))
    around = F.concat(_found(F.col("left")), _found(F.col("right")))
    return _lowered(F.concat(line, F.filter(around, lambda t: ~t.rlike(r"^\p{Ll}"))))


def places(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """wanted: (uid, term) -> uid, doc_id, term, start, end of every occurrence."""
    some = rows.join(wanted.groupBy("uid").agg(F.collect_set("term").alias("wanted")), "uid")
    zipped = F.arrays_zip(F.split("text", TERM, -1).alias("gap"), _found(F.col("text")).alias("match"))
    words = some.select("uid", "doc_id", F.posexplode(F.transform(zipped, lambda z: F.struct(
        F.char_length(z["gap"]).cast("long").alias("lead"), F.char_length(z["match"]).cast("long").alias("size"),
        F.when(F.array_contains("wanted", F.lower(z["match"])), F.lower(z["match"])).alias("term")))).alias("n", "w"))
    run = Window.partitionBy("uid").orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return words.withColumn("end", F.sum(F.col("w.lead") + F.col("w.size")).over(run)).where("w.term IS NOT NULL").select(
        "uid", "doc_id", "w.term", (F.col("end") - F.col("w.size")).alias("start"), "end")


def revealing_terms(docs: DataFrame, rows: DataFrame, spans: DataFrame, text_col: str = "text", support: int = SUPPORT,
                    threshold: float = THRESHOLD) -> DataFrame:
    """Spans of terms that disclose an entity of their document: uid, doc_id, start, end,
    entity, term, disclosure.  ``rows`` are those of ``keyed``, written.

    An entity is a kind and its text without letter case or separators; one in fewer than
    ``support`` documents has no such terms.  Copies of a context count once for the
    support: a term needs so many different contexts that it stands in, or so many
    documents with it anywhere that hold the entity in different contexts."""
    entity = F.concat_ws(":", "kind", F.lower(F.when(F.col("kind").isin("card", "phone"), F.regexp_replace(
        "match", "[^0-9]+", "")).otherwise(F.col("match"))))
    named = spans.withColumn("entity", entity)
    known = stored(named.groupBy("entity", "uid").agg(F.lit(1)).groupBy("entity").agg(
        F.count(F.lit(1)).alias("with_entity")).where(F.col("with_entity") >= support), "pii-entities")
    held = stored(named.join(known, "entity").select(
        "uid", "entity", "with_entity", F.xxhash64("left", "right").alias("context"), _near().alias("near")), "pii-near")
    holders = stored(held.groupBy("uid", "entity").agg(
        F.xxhash64(F.sort_array(F.collect_set("context"))).alias("contexts")), "pii-holders")

    total = rows.count()
    content = F.log(F.lit(float(total)) / F.col("with_entity"))

    def disclosure(together: str) -> Column:
        missing = F.log(F.greatest(F.col("with_term") / F.col(together), F.lit(1.0)))
        return F.when(content > 0, 1 - missing / content).otherwise(0.0)

    frequency = docs.select(F.explode_outer(_terms(text_of(text_col))).alias("term")).groupBy("term").agg(
        F.count(F.lit(1)).alias("with_term"))
    # a term in more documents than this cannot disclose enough, though all that hold the entity hold it
    tried = stored(held.select("entity", "with_entity", "context", F.explode("near").alias("term")).groupBy("entity", "term").agg(
        F.max("with_entity").alias("with_entity"), F.count_distinct("context").alias("near_contexts")).join(
        frequency, "term").where(disclosure("with_entity") >= threshold), "pii-tried")
    present = rows.join(holders.select("uid").distinct(), "uid").select("uid", F.explode(_terms(F.col("text"))).alias("term"))
    both = stored(present.join(tried.select("entity", "term"), "term").join(holders, ["uid", "entity"]), "pii-together")
    shown = stored(both.groupBy("entity", "term").agg(
        F.count(F.lit(1)).alias("with_both"), F.count_distinct("contexts").alias("contexts")).join(
        tried, ["entity", "term"]).where(F.greatest("contexts", "near_contexts") >= support).withColumn(
        "disclosure", disclosure("with_both")).where(F.col("disclosure") >= threshold).select(
        "entity", "term", "disclosure"), "pii-terms")
    marked = stored(both.select("uid", "entity", "term").join(shown, ["entity", "term"]), "pii-marked")
    return places(rows, marked).join(marked, ["uid", "term"]).select(
        "uid", "doc_id", "start", "end", "entity", "term", "disclosure")


def find_private(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
                 threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, base and spans, both sorted arrays of (start, rank,
    kind, end); spans holds the base ones and terms that touch none of them (kind ``term``).

    Null or empty text has no spans.  A null id stays null; repeated rows get a row
    each; an empty table gives an empty result; other columns are not read."""
    rows = stored(keyed(docs, id_col, text_col), "pii-rows")
    found = stored(matches(rows), "pii-matches")
    spans = stored(base_spans(found), "pii-spans")
    rank = F.element_at(F.create_map(*[F.lit(x) for p in zip(KINDS, range(len(KINDS))) for x in p]), F.col("kind"))
    base = spans.select("uid", "doc_id", F.struct("start", rank.alias("rank"), "kind", "end").alias("s"))
    terms = revealing_terms(docs, rows, spans, text_col, support, threshold).select(
        "uid", "doc_id", F.struct("start", F.lit(len(KINDS)).alias("rank"), F.lit("term").alias("kind"), "end").alias("s"))
    nothing = found.groupBy("uid", "doc_id").agg(F.lit(None).cast(base.schema["s"].dataType).alias("s"))
    all_spans = nothing.unionByName(base).unionByName(terms).groupBy("uid", "doc_id").agg(
        F.sort_array(F.collect_set("s")).alias("all"))
    both = all_spans.withColumn("base", F.filter("all", lambda s: s["kind"] != "term"))
    free = F.filter("all", lambda s: (s["kind"] != "term") | ~F.exists(
        "base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    return both.select("uid", "doc_id", "base", free.alias("spans"))


def sanitised(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options) -> DataFrame:
    """The documents with entities generalised to their kind (``[EMAIL]``) and revealing
    terms removed; all columns of the documents are kept."""
    numbered = stored(docs.withColumn("__row", F.monotonically_increasing_id()), "pii-documents")
    private = find_private(numbered, id_col="__row", text_col=text_col, **options).where(F.size("spans") > 0)
    text = text_of(text_col)
    joined = numbered.join(private.select(F.col("doc_id").alias("__row"), F.col("spans").alias("__spans")), "__row", "left")
    ends = F.concat(F.array(F.lit(0).cast("long")), F.transform("__spans", lambda s: s["end"]))
    pieces = F.transform("__spans", lambda s, i: F.concat(
        F.substring(text, (F.get(ends, i) + 1).cast("int"), F.greatest(s["start"] - F.get(ends, i), F.lit(0)).cast("int")),
        F.when(s["kind"] == "term", F.lit("")).otherwise(F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")))))
    rest = F.substring(text, (F.element_at(ends, -1) + 1).cast("int"), F.char_length(text))
    clean = F.when(F.col("__spans").isNull(), F.col(text_col)).otherwise(F.concat(F.array_join(pieces, ""), rest))
    return joined.withColumn(text_col, clean).select(docs.columns)


def joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
