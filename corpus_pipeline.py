"""A training-data pipeline over ``documents``: every stage is one operator of ``reelstat.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's documents.  All stages but the last return the columns of documents.

The two dedup stages decide on rows and send back masks of their places (file and row number),
one bit a row, so texts are filtered where they are read; the tables such a stage wrote
on its way are deleted before it returns.

Nulls and odd rows: a null text counts as empty everywhere.  Repeated rows (same id,
same text) leave exact dedup once.  Where a doc_id repeats with different texts, near
dedup keeps all rows of an id of which one is kept; rows without an id have no near
copies.  Empty tables pass through as empty tables.  Extra columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelstat.llm.common import PLACE, id_crc32, masks, placed, scratch, stored, table, without
from reelstat.llm.exact_dedup import exact_dedup
from reelstat.llm.minhash import near_duplicates
from reelstat.llm.mixing import mixed_documents
from reelstat.llm.packing import pack_documents
from reelstat.llm.queries import RANKS, TOKENIZER
from reelstat.llm.toxicity import score_of, train, with_margin

#: SQL cannot express the classifier's stage; tests compare with a brute-force version.
ORACLE_SQL = None

#: Documents with at least this score are rejected.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score below TOXIC stay (the classifier of op6, same held-out labels)."""
    model = train(docs, table(spark, sf_dir, "labels"), usable=id_crc32("doc_id") % 3 != 1)
    return with_margin(docs, model).where(score_of(model) < TOXIC).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal normalised texts the row with the smallest doc_id stays."""
    rows = placed(docs)
    with scratch(spark) as keep:
        gone = exact_dedup(rows, carry=PLACE).where(~F.col("kept")).select(*PLACE)
        marked = keep(stored(masks(gone), "pipeline-exact"))
    return without(rows, marked)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every component of documents with a shingle similarity of 0.8 one stays."""
    rows = placed(docs)
    with scratch(spark) as keep:
        found = near_duplicates(docs, words=5, percent=80).groupBy(F.col("doc_id").alias("__id")).agg(F.max("kept").alias("kept"))
        gone = rows.select("doc_id", *PLACE).join(found.where(~F.col("kept")), F.col("doc_id") == F.col("__id"), "left_semi")
        marked = keep(stored(masks(gone.select(*PLACE)), "pipeline-near"))
    return without(rows, marked)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes, as documents; n_chars follows the text."""
    mixed = mixed_documents(docs, weights=(1, 2, 3), cap=3)
    if "n_chars" in docs.columns:
        mixed = mixed.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return mixed.select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens and their places in sequences."""
    return pack_documents(docs, TOKENIZER, RANKS, end_id=2, capacity=1024)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("minhash near-dedup", drop_near_copies),
    ("mixing sources to target weights", mix),
    ("best-fit packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "_"))
    return docs
