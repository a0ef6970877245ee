"""Stored aggregates: versions, incremental refresh, bucketed tables, distinct counts."""

import os
import threading

import pytest
from pyspark.sql.types import StructType

from reelstat.operators import incremental, recommend, stats
from reelstat.plans import registry
from reelstat.sources import (
    overwrite_partitions, partition_values, quarantine, register_partitioned, schemas, testdata, versions,
)

SF = "/root/testdata/sf0.001"


def test_log_names_one_complete_version(spark, tmp_dir):
    base = f"{tmp_dir}/table"
    assert versions.current(spark, base) is None
    first = versions.write_version(spark, base, lambda path: spark.range(3).write.parquet(path))
    reader = spark.read.parquet(versions.current(spark, base))
    second = versions.write_version(spark, base, lambda path: spark.range(7).write.parquet(path))
    assert versions.current(spark, base) == second != first
    assert reader.count() == 3 and spark.read.parquet(versions.current(spark, base)).count() == 7     # the old one is still whole
    with pytest.raises(RuntimeError):
        versions.write_version(spark, base, lambda path: (spark.range(9).write.parquet(path), fail())[0])
    assert versions.current(spark, base) == second
    assert versions.prune(spark, base) == 2 and spark.read.parquet(versions.current(spark, base)).count() == 7


def fail():
    raise RuntimeError("writer died")


def test_of_two_writers_the_second_is_refused(spark, tmp_dir):
    r, base = testdata.ratings(spark, SF), f"{tmp_dir}/stats"
    incremental.refresh(r, base)
    start = versions.latest(spark, base)
    versions.publish(spark, base, "v-other", after=start)
    with pytest.raises(versions.VersionConflict):
        versions.publish(spark, base, "v-mine", after=start)
    assert versions.current(spark, base).endswith("v-other") and versions.latest(spark, base) == start + 1


def test_readers_always_find_a_version(spark, tmp_dir):
    base, seen, stop = f"{tmp_dir}/table", [], threading.Event()
    versions.publish(spark, base, "v-0")

    def read():
        while not stop.is_set():
            seen.append(versions.current(spark, base))

    reader = threading.Thread(target=read)
    reader.start()
    for i in range(1, 40):
        versions.publish(spark, base, f"v-{i}")
    stop.set()
    reader.join()
    assert seen and all(s and s.rsplit("/", 1)[-1].startswith("v-") for s in seen)


def test_two_batches_equal_one_build(spark, tmp_dir):
    r, m = testdata.ratings(spark, SF), testdata.movies(spark, SF)
    base = f"{tmp_dir}/stats"
    first, second = recommend.split_ratings(r)
    incremental.refresh(first, base)
    before = incremental.read_partials(spark, base)
    partials = incremental.refresh(second, base)
    assert sorted(incremental.movie_stats(partials, m).collect()) == sorted(stats.movie_stats(r, m).collect())
    assert sorted(incremental.movie_stats(before, m).collect()) == sorted(stats.movie_stats(first, m).collect())
    empty = incremental.refresh(r.limit(0), base)
    assert sorted(empty.collect()) == sorted(partials.collect())


def test_bucketed_statistics_need_no_exchange_by_movie(spark):
    r, m = registry._bucketed(spark, SF)
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = stats.movie_stats(r, m)._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)


def test_distinct_ids(spark):
    ids = [1, 1, 5, 32768, 32769, -4, 2 ** 31 - 1, -(2 ** 31), None, 0]
    df = spark.createDataFrame([(i,) for i in ids * 3], "u int").repartition(4)
    assert incremental.distinct_ids(df, "u").first()["n"] == len({i for i in ids if i is not None})
    assert incremental.distinct_ids(df.limit(0), "u").first()["n"] == 0
    plan = incremental.distinct_ids(df, "u")._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(u" not in plan                 # ids are not shuffled


def test_sketches_merge(spark):
    df = spark.range(60_000).selectExpr("id % 20011 AS u", "id % 7 AS day")
    stored = incremental.sketches(df, "day", ["u"])
    assert stored.count() == 7
    n = incremental.sketched_counts(stored, ["u"]).first()["u"]
    assert abs(n - 20011) < 0.03 * 20011


def test_saved_factors(spark, tmp_dir):
    one = spark.createDataFrame([(1, [1.0])], "id long, features array<double>")
    two = spark.createDataFrame([(2, [2.0])], "id long, features array<double>")
    with pytest.raises(ValueError, match="no model"):
        recommend.load_factors(spark, f"{tmp_dir}/model")
    recommend.save_factors(one, one, f"{tmp_dir}/model")
    recommend.save_factors(one, two, f"{tmp_dir}/model")
    users, items = recommend.load_factors(spark, f"{tmp_dir}/model")
    assert users.collect() == one.collect() and items.collect() == two.collect()



def test_partitioned_table_reads_only_its_years(spark, tmp_dir):
    rows = [(u, 1, 3.0, "2020-01-01", y) for y in ("1999", "2000", "2001", None) for u in range(4)]
    df = spark.createDataFrame(rows, StructType([*schemas.RATINGS_CLEAN.fields]).add("year", "string"))
    overwrite_partitions(df, f"{tmp_dir}/r", ["year"])
    t = register_partitioned(spark, "by_year_test", f"{tmp_dir}/r", df.schema, ["year"])
    assert t.count() == 16 and partition_values(spark, "by_year_test", "year") == ["1999", "2000", "2001"]
    # rows of one year replace that year alone; a new year becomes a partition
    new = spark.createDataFrame([(9, 1, 5.0, "2020-01-01", "2000"), (9, 1, 1.0, "2020-01-01", "2002")], df.schema)
    overwrite_partitions(new, f"{tmp_dir}/r", ["year"])
    t = register_partitioned(spark, "by_year_test", f"{tmp_dir}/r", df.schema, ["year"])
    assert {r["year"]: r["count"] for r in t.groupBy("year").count().collect()} == {
        "1999": 4, "2000": 1, "2001": 4, "2002": 1, None: 4}
    trend = stats.year_trend_of_table(spark, "by_year_test", n=2)
    assert [tuple(r) for r in trend.collect()] == [("2002", 1, 1.0), ("2001", 4, 3.0)]
    plan = trend._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [year" in plan and "2001" in plan
    spark.sql("DROP TABLE spark_catalog.default.by_year_test")


def test_quarantine_keeps_every_record(spark, tmp_dir):
    lines = ["userId,movieId,rating,timestamp", '1,10,4.5,964982703', '1,"11","five ""5""",1', '2,12', '3,13,3.0,5,extra',
             ',14,3.0,7', '4,15,9.5,7', '5,16,NaN,7', '6,,2.0,7', '7,17,0.5,']
    os.makedirs(f"{tmp_dir}/csv")
    with open(f"{tmp_dir}/csv/a.csv", "w") as f:
        f.write("\n".join(lines))
    clean, refused = quarantine.split_records(spark, f"{tmp_dir}/csv", schemas.RATINGS_RAW, f"{tmp_dir}/out", quarantine.rating_checks())
    assert sorted(map(tuple, clean.collect())) == [(1, 10, 4.5, 964982703), (7, 17, 0.5, None)]
    got = {(r["reason"], r["record"]) for r in refused.collect()}
    assert got == {("malformed", lines[2]), ("malformed", lines[3]), ("malformed", lines[4]), ("no user", ",14,3.0,7"),
                   ("rating out of range", "4,15,9.5,7"), ("rating out of range", "5,16,NaN,7"), ("no movie", "6,,2.0,7")}
    assert all(r["file"].endswith("a.csv") for r in refused.collect())
    assert {r["reason"]: r["n"] for r in quarantine.reasons(clean, refused).collect()} == {
        "clean": 2, "malformed": 3, "no user": 1, "no movie": 1, "rating out of range": 2}
