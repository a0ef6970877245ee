"""Reading spoiled files: one pass, two outputs.

Instead of failing on the first bad record (FAILFAST) or dropping bad records without a trace
(DROPMALFORMED), every record is kept: usable rows go to one folder, refused ones to another
with the reason, the record as it stands in the file, and the file it came from.  Both come from
one scan and one write job, partitioned by the verdict, with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from reelstat.sources.files import CSV_OPTIONS, NO_NULL_TEXT

#: Reason of a record that does not fit the schema: a field of another type, too few or too many.
MALFORMED = "malformed"


def split_records(spark: SparkSession, path: str, schema: StructType, out: str,
                  checks: dict[str, Column] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, refused records) of headered CSV files.

    ``checks``: reason -> condition under which a well-formed row is refused; the first that
    holds is the reason (null conditions do not hold).  Written under ``out`` as Parquet; the
    second frame has the columns reason, record, file.  A malformed record has no
    trustworthy fields, so only its text is kept.  Empty input gives two empty frames.
    """
    known = StructType([*schema.fields]).add("__record", StringType())
    rows = spark.read.schema(known).options(**CSV_OPTIONS).options(
        nullValue=NO_NULL_TEXT, mode="PERMISSIVE", columnNameOfCorruptRecord="__record").csv(path)
    reason = F.when(F.col("__record").isNotNull(), MALFORMED)
    for name, refused in (checks or {}).items():
        reason = reason.when(refused, name)
    as_text = F.to_csv(F.struct(*schema.names), {"escape": '"', "quote": '"'})
    judged = rows.select(*schema.names, reason.alias("reason"), F.coalesce("__record", as_text).alias("record"),
                         F.col("_metadata.file_path").alias("file"))
    good = F.col("reason").isNull()
    # what one side does not need is null in it and takes no room in its files
    sides = judged.select(
        good.alias("clean"), *(F.when(good, F.col(c)).alias(c) for c in schema.names), "reason",
        *(F.when(~good, F.col(c)).alias(c) for c in ("record", "file")))
    sides.write.mode("overwrite").partitionBy("clean").parquet(out)
    back = spark.read.schema(sides.schema).parquet(out)
    return back.where("clean").select(*schema.names), back.where("NOT clean").select("reason", "record", "file")


def reasons(clean: DataFrame, refused: DataFrame) -> DataFrame:
    """reason, n - refused records by reason, and the clean rows under 'clean'."""
    good = clean.agg(F.count(F.lit(1)).alias("n")).select(F.lit("clean").alias("reason"), "n")
    return refused.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).unionByName(good)


def rating_checks() -> dict[str, Column]:
    """What makes a well-formed raw rating unusable."""
    rating = F.col("rating")
    return {"no user": F.col("userId").isNull(), "no movie": F.col("movieId").isNull(),
            "rating out of range": rating.isNull() | F.isnan(rating) | ~rating.between(0.5, 5.0)}
