"""The registered ``opN_<name>`` queries and their DuckDB oracles where SQL can tell the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from reelstat.llm.common import id_crc32, table
from reelstat.llm.divergence import source_divergence
from reelstat.llm.exact_dedup import exact_dedup
from reelstat.llm.lm_scoring import lm_scores
from reelstat.llm.metric_join import jaccard_components
from reelstat.llm.minhash import near_duplicates
from reelstat.llm.mixing import mix_sources, taken_words
from reelstat.llm.packing import pack_documents
from reelstat.llm.pii import KINDS, find_private, joined
from reelstat.llm.quality import log_ratios, quality_rules
from reelstat.llm.spelling import spelling_variants, word_counts
from reelstat.llm.token_counts import token_counts
from reelstat.llm.toxicity import toxicity_scores, train
from reelstat.llm.warc_zip import archived_pages

#: Public vocabulary of the contracts, and the same vocabulary as ranks.
TOKENIZER, RANKS = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken"


def op1_lm_scoring(spark, sf_dir):
    """Bigrams; one training document in ten belongs to the deleted fold."""
    code = id_crc32("doc_id")
    return lm_scores(table(spark, sf_dir, "documents"), train=code % 7 != 2, fold=F.floor(code / 7) % 10 == 0)


def op2_warc(spark, sf_dir):
    return archived_pages(spark, table(spark, sf_dir, "pages")).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_packing(spark, sf_dir):
    return pack_documents(table(spark, sf_dir, "documents"), TOKENIZER, RANKS, end_id=2, capacity=1024)


def op4_token_counts(spark, sf_dir):
    return token_counts(table(spark, sf_dir, "documents"), TOKENIZER, limit=1024)


def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = id_crc32("doc_id") % 3 == 1
    model = train(docs, table(spark, sf_dir, "labels"), usable=~held_out)
    marked = docs.select("doc_id", held_out.alias("held_out"), "text")
    return toxicity_scores(marked, model, ["doc_id", "held_out"], threshold=0.7)


def op7_pii(spark, sf_dir):
    found = find_private(table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"))


def op8_quality_rules(spark, sf_dir):
    """Trusted are the documents labelled as good."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules(docs, log_ratios(docs, labels.where("quality = 1")))


def op9_minhash(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "documents"), words=5, percent=85)


def op10_mixing(spark, sf_dir):
    """Weights 1, 2, 3; targets stop at 3 times a source's words."""
    return taken_words(mix_sources(table(spark, sf_dir, "documents"), weights=(1, 2, 3), cap=3))


def op11_spelling(spark, sf_dir):
    """The form is a near word that is at least 5 times as frequent."""
    return spelling_variants(word_counts(table(spark, sf_dir, "documents")), ratio=5)


def op12_metric_join(spark, sf_dir):
    return jaccard_components(table(spark, sf_dir, "documents"), words=3, percent=90)


def op13_divergence(spark, sf_dir):
    return source_divergence(table(spark, sf_dir, "documents"), min_docs=3, top=200)


QUERIES = {f.__name__: f for f in (
    op1_lm_scoring, op2_warc, op3_packing, op4_token_counts, op5_exact_dedup, op6_toxicity, op7_pii, op8_quality_rules,
    op9_minhash, op10_mixing, op11_spelling, op12_metric_join, op13_divergence,
)}
#: Words of the lower-cased (A-Z) text as a list.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"



def _linked(words: int, percent: int) -> str:
    """CTEs n (doc_id, n: size of its set of shingles) and m (doc_id, component_id)."""
    return rf"""
        WITH RECURSIVE w AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) <= {words} THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + {words - 1}], ' ') END AS s
              FROM w, unnest(range(1, greatest(len(w) - {words - 1}, 1) + 1)) AS r(i) WHERE len(w) > 0),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= {percent} * (x.n + y.n - c)),
        r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
        m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)"""


ORACLE_SQL = {
    "op2_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
             t AS (SELECT page_id, octet_length(encode(h)) AS n, sha1(h) AS d,
                          CASE WHEN octet_length(encode(h)) >= 1000 THEN max(page_id) OVER (PARTITION BY h) ELSE page_id END AS r
                   FROM p)
        SELECT page_id, n AS payload_bytes, d AS payload_digest,
               CASE WHEN r = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN r <> page_id THEN r END AS refers_to
        FROM t""",
    "op5_exact_dedup": r"""
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS s FROM documents)
        SELECT doc_id, min(doc_id) OVER (PARTITION BY s) AS keep_id, count(*) OVER (PARTITION BY s) AS group_size,
               doc_id = min(doc_id) OVER (PARTITION BY s) AS kept, sha256(s) AS text_sha256
        FROM t""",
    "op9_minhash": _linked(5, 85) + """
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
        FROM m LEFT JOIN n USING (doc_id)""",
    # crc32 byte by byte from its table; near words share a word with a gap or less a letter
    "op11_spelling": r"""
        WITH RECURSIVE t AS (
            SELECT i, i::BIGINT AS c, 0 AS k FROM range(256) AS r(i)
            UNION ALL SELECT i, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END, k + 1 FROM t WHERE k < 8),
        crc AS (SELECT list(c ORDER BY i) AS t FROM t WHERE k = 8),
        o AS (SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')),
                                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w FROM documents),
        g AS (SELECT w, hex(encode(doc_id || ':' || w)) AS x, count(*) AS k FROM o WHERE length(w) >= 6 GROUP BY ALL),
        b AS (SELECT w, k, list_transform(range(0, len(x) // 2), lambda i: ('0x' || x[2 * i + 1 : 2 * i + 2])::BIGINT) AS b FROM g),
        h AS (SELECT w, k, xor(4294967295::BIGINT, list_reduce(b, lambda c, v: xor(c >> 8, t[(xor(c, v) & 255) + 1]), 4294967295::BIGINT)) AS h
              FROM b, crc),
        f AS (SELECT CASE WHEN h % 199 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, k FROM h),
        v AS (SELECT word, sum(k)::BIGINT AS n FROM f WHERE length(word) >= 6 GROUP BY word HAVING sum(k) >= 5),
        d AS (SELECT word, i, substr(word, 1, i - 1) AS l, substr(word, i + 1) AS r FROM v, unnest(range(1, length(word) + 1)) AS u(i)),
        e AS (SELECT x.word AS a, y.word AS b FROM d x JOIN d y ON x.l = y.l AND x.r = y.r AND x.word <> y.word
              UNION SELECT d.word, v.word FROM d JOIN v ON d.l || d.r = v.word
              UNION SELECT v.word, d.word FROM d JOIN v ON d.l || d.r = v.word),
        m AS (SELECT a AS word, count(*) AS n_near, max(n) AS near_n FROM e JOIN v ON e.b = v.word GROUP BY a),
        c AS (SELECT e.a AS word, min(e.b) AS form, any_value(m.near_n) AS form_n FROM e JOIN v ON e.b = v.word
              JOIN m ON m.word = e.a AND m.near_n = v.n JOIN v o ON o.word = e.a WHERE m.near_n >= 5 * o.n GROUP BY e.a),
        s AS (SELECT word, word AS root, 0 AS k FROM v UNION ALL SELECT s.word, c.form, k + 1 FROM s JOIN c ON s.root = c.word),
        z AS (SELECT word, arg_max(root, k) AS root FROM s GROUP BY word)
        SELECT v.word, c.form, z.root, v.n, coalesce(m.n_near, 0) AS n_near, c.form_n
        FROM v JOIN z USING (word) LEFT JOIN m USING (word) LEFT JOIN c USING (word)""",
    "op12_metric_join": _linked(3, 90) + """
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id FROM m LEFT JOIN n USING (doc_id)""",
    "op13_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
                   FROM documents),
        t AS (SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d),
        k AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY lang, term HAVING count(DISTINCT doc) >= 3),
        g AS (SELECT DISTINCT lang, source FROM d),
        c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t GROUP BY ALL),
        a AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n
              FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
        p AS (SELECT lang, source, term, n, 1 + 1000000000 * (n + 1) // (sum(n) OVER s + count(*) OVER s) AS p,
                     1 + 1000000000 * (lang_n + 1) // (sum(lang_n) OVER s + count(*) OVER s) AS q
              FROM a WINDOW s AS (PARTITION BY lang, source)),
        f AS (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
              FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
        r AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(f.value, 0) AS value
              FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
              LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
              UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r)
        WHERE part = 'pair' OR rank <= 200""",
}
